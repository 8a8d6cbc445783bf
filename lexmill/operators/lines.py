"""Pages to lines with offsets, discards and heading levels."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RuleConfig
from ..functions import text as X


def prune_pages(pages: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Drop a document's first and last pages."""
    first, last = max(0, cfg.skip_start_pages), max(0, cfg.skip_end_pages)
    n = F.count("*").over(Window.partitionBy("doc_id"))
    kept = pages.withColumn("n_pages", n).filter((F.col("page_no") > first) & (F.col("page_no") <= F.greatest(F.col("n_pages") - last, F.lit(first))))
    return kept.withColumn("text", X.without(F.coalesce("text", F.lit("")), "\r"))


def discard_reason(raw: Column, clean: Column, cfg: RuleConfig) -> Column:
    out = None
    for name, pattern in cfg.skip.items():
        hit = (raw if name == "decoration" else clean).rlike(X.rule(pattern, start=True, nocase=True))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out if out is not None else F.lit(None).cast("string")


def heading_level(clean: Column, cfg: RuleConfig) -> Column:
    out = F.lit(None).cast("int")
    for level in (1, 2, 3):  # the last test made here is the first to count
        if pattern := cfg.section_patterns.get(f"level{level}"):
            out = F.when(clean.rlike(X.rule(pattern, start=True)), level).otherwise(out)
    return out


def split_lines(pages: DataFrame, cfg: RuleConfig) -> DataFrame:
    """``doc_id, line_no, page_no, text, clean, start, end, reason, level`` of the pages that are processed.

    One exchange on doc_id serves this and every window on a document after it.
    """
    pruned = prune_pages(pages, cfg)
    split = pruned.select("doc_id", "page_no", F.posexplode(F.split("text", "\n", -1)).alias("i", "text"))
    return _placed(split, lambda raw, clean: discard_reason(raw, clean, cfg), lambda clean: heading_level(clean, cfg))


def _placed(split: DataFrame, reason: Callable[[Column, Column], Column], level: Callable[[Column], Column], *more: str) -> DataFrame:
    """Number, place and judge the lines ``doc_id, page_no, i, text`` of documents."""
    w = Window.partitionBy("doc_id").orderBy("page_no", "i")
    start = F.coalesce(F.sum(F.length("text") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = split.withColumns({"line_no": F.row_number().over(w), "start": start, "clean": X.strip(F.col("text"))})
    df = df.withColumns({"end": F.col("start") + F.length("text"), "reason": reason(F.col("text"), F.col("clean"))})
    df = df.withColumn("level", F.when(F.col("reason").isNull(), level(F.col("clean"))))
    return df.select("doc_id", "line_no", "page_no", "text", "clean", "start", "end", "reason", "level", *more)


def chosen(rules: dict[str, RuleConfig], of: Callable[[RuleConfig], Column]) -> Column:
    """What ``of`` makes of the rule set that a row's ``vertical`` names."""
    out = F.when(F.lit(False), of(next(iter(rules.values()))))
    for vertical, cfg in rules.items():
        out = out.when(F.col("vertical") == vertical, of(cfg))
    return out


def split_lines_by(pages: DataFrame, rules: dict[str, RuleConfig]) -> DataFrame:
    """As ``split_lines``, with the rules of each page's ``vertical``, which is a column of the result too."""
    first, last = chosen(rules, lambda c: F.lit(max(0, c.skip_start_pages))), chosen(rules, lambda c: F.lit(max(0, c.skip_end_pages)))
    n = F.count("*").over(Window.partitionBy("doc_id"))
    kept = pages.filter(F.col("vertical").isin(*rules)).withColumns({"n_pages": n, "first_": first, "last_": last})
    kept = kept.filter((F.col("page_no") > F.col("first_")) & (F.col("page_no") <= F.greatest(F.col("n_pages") - F.col("last_"), F.col("first_"))))
    text = X.without(F.coalesce("text", F.lit("")), "\r")
    split = kept.select("doc_id", "vertical", "page_no", F.posexplode(F.split(text, "\n", -1)).alias("i", "text"))
    return _placed(split, lambda raw, clean: chosen(rules, lambda c: discard_reason(raw, clean, c)), lambda clean: chosen(rules, lambda c: heading_level(clean, c)), "vertical")


def discarded(lines: DataFrame) -> DataFrame:
    return lines.filter("reason is not null").select("doc_id", "line_no", "reason", F.col("clean").alias("text"), "page_no", (F.length("text") + 1).alias("chars"))
