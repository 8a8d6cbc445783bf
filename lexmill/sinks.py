"""Writers of nested documents."""

import os

from pyspark.sql import DataFrame, SparkSession

from .config import RuleConfig
from .sources.document_files import SUFFIX, save_documents
from .sources.page_files import listed


def write_parquet(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").parquet(path)


def write_json(docs: DataFrame, path: str) -> None:
    """JSON lines with nulls kept."""
    docs.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_json(docs: DataFrame, folder: str, cfg: RuleConfig) -> list[str]:
    """A pretty ``{title}.parsed.json`` for each document in a folder that every worker mounts; returns the folder's paths."""
    save_documents(docs, folder, indent=cfg.json_indent, ascii_=cfg.json_ascii)
    return sorted(f.path for f in listed(folder, f"*{SUFFIX}"))


def read_json(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Documents that ``write_json`` or ``export_json`` wrote; unreadable ones are skipped."""
    one = os.path.isdir(path) and any(n.endswith(".parsed.json") for n in os.listdir(path))
    return spark.read.schema(like.schema).option("mode", "DROPMALFORMED").option("multiLine", str(one).lower()).json(path)
