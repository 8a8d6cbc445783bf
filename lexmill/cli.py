"""Command line: structure the documents of a folder and print the corpus summary."""

import argparse
import logging
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import from_mapping
from .operators.document import summary
from .plans.pipeline import REGISTRY
from .sources.document_files import read_documents, save_documents
from .sources.page_files import page_files

LOG = logging.getLogger("lexmill")


def load_config(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def configure_logging(tree: dict, verbose: bool) -> None:
    log = tree.get("logging") or {}
    level = logging.DEBUG if verbose else getattr(logging, str(log.get("level", "INFO")).upper(), logging.INFO)
    logging.basicConfig(level=level if isinstance(level, int) else logging.INFO, format=log.get("format"))


def resolve(source_dir: str, names: list[str] | None) -> str | list[str]:
    """The folder, or the named documents in it; a missing one is an error."""
    if not os.path.isdir(source_dir):
        raise FileNotFoundError(source_dir)
    paths = [n if os.path.isabs(n) else f"{source_dir}/{n}" for n in names or []]
    for p in paths:
        if not os.path.exists(p):
            raise FileNotFoundError(p)
    return paths or source_dir


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lexmill")
    ap.add_argument("--config", default="config.yaml")
    ap.add_argument("--pipeline", default="product_technical", choices=sorted(REGISTRY))
    ap.add_argument("--stage", default="symbolic", choices=["symbolic"])
    ap.add_argument("--document", action="append")
    ap.add_argument("--verbose", action="store_true")
    args = ap.parse_args(argv)
    if not os.path.exists(args.config):
        print(f"no configuration at {args.config}", file=sys.stderr)
        return 1
    try:
        tree = load_config(args.config)
        configure_logging(tree, args.verbose)
        cfg = from_mapping(tree, args.pipeline)
        source, out = cfg.require_dirs()
        spark = SparkSession.builder.getOrCreate()
        raw = page_files(spark, resolve(source, args.document), cfg.document_glob).persist()
        files = raw.select("doc_id", F.col("doc_id").alias("path"), "filename", "stem", "checksum_sha256").distinct()
        plan = REGISTRY[args.pipeline][args.stage].guarded(raw, cfg, files)
        for r in plan.errors.toLocalIterator():
            LOG.error("%s: %s: %s", r.doc_id or "all documents", r.step, r.error)
        save_documents(plan.accepted, out, indent=cfg.json_indent, ascii_=cfg.json_ascii)
        got = read_documents(spark, out, plan.documents.drop("doc_id").schema)
        for r in got.warnings.toLocalIterator():
            LOG.warning("%s: %s", r.path, r.problem)
        s = summary(got.documents).first()
        plan.release()
        raw.unpersist()
        if s is None:
            LOG.warning("no output")
            return 0
        for name in ("documents", "pages", "sections", "figures", "tables", "warnings"):
            print(f"{name}: {s[name]}")
        print(f"avg text coverage: {100 * s.avg_text_coverage:.2f}%")
        return 0
    except Exception:
        LOG.exception("the run failed")
        return 2


if __name__ == "__main__":
    sys.exit(main())
