"""Isolation of errors: a bad rule, page or section sets its own documents aside and leaves all others as they are.

Errors are values.  Casts are tried, encodings are tested, rules are compiled by an expression that gives null instead of failing, and
what each step makes is held against the step's own promises.  Whatever goes wrong is a row ``doc_id, step, error``.
"""

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import RuleConfig
from ..functions import text as X

ERRORS = "doc_id string, step string, error string"
LARGEST_PAGE = 2**31 - 1

#: What a row of each step's table must not be; the key names the error.
PROMISES = {
    "lines": {"a line without text": "text is null", "a line that ends before it starts": "end < start"},
    "drafts": {"a section that ends before it starts": "char_end < char_start", "a section without an id": "section_id is null", "a level outside 1 to 3": "level not between 1 and 3"},
    "content": {"a table without cells": "exists(tables, t -> t.n_rows < 1 or t.n_cols < 1)", "a figure without an id": "exists(figures, f -> f.figure_id is null)"},
    "sections": {"a section without text": "text is null", "a section that ends before it starts": "char_end < char_start", "tags out of order": "tags <> array_sort(array_distinct(tags))"},
}


def _rules(cfg: RuleConfig) -> list[tuple[str, str, str]]:
    """Every pattern of a rule set as (place, key, pattern as it is run)."""
    out = [("skip", k, X.rule(p, start=True, nocase=True)) for k, p in cfg.skip.items()]
    out += [("section_patterns", k, X.rule(p, start=True)) for k, p in cfg.section_patterns.items()]
    out += [("implicit", str(i), X.rule(p, start=True)) for i, p in enumerate(cfg.implicit.heading_patterns)]
    out += [("warnings", str(i), X.rule(p, nocase=True, multiline=True)) for i, p in enumerate(cfg.warnings.patterns)]
    return out + ([("component_list_pattern", "", X.rule(cfg.component_list_pattern, multiline=True))] if cfg.component_list_pattern else [])


def sound_rules(spark: SparkSession, cfg: RuleConfig) -> tuple[RuleConfig, DataFrame]:
    """The rule set without the patterns that do not compile, and a row (with a null document) for each of those."""
    rules = _rules(cfg)
    if not rules:
        return cfg, spark.createDataFrame([], ERRORS)
    df = spark.createDataFrame(rules, "place string, key string, pattern string")
    compiles = F.expr("try_reflect('java.util.regex.Pattern', 'compile', pattern)").isNotNull()
    bad = {(r.place, r.key) for r in df.filter(~compiles).select("place", "key").collect()}  # as many rows as the rule set has patterns at most
    keep = lambda place, values: tuple(p for i, p in enumerate(values) if (place, str(i)) not in bad)
    cfg = replace(
        cfg, skip={k: p for k, p in cfg.skip.items() if ("skip", k) not in bad}, section_patterns={k: p for k, p in cfg.section_patterns.items() if ("section_patterns", k) not in bad},
        implicit=replace(cfg.implicit, heading_patterns=keep("implicit", cfg.implicit.heading_patterns)), warnings=replace(cfg.warnings, patterns=keep("warnings", cfg.warnings.patterns)),
        component_list_pattern="" if ("component_list_pattern", "") in bad else cfg.component_list_pattern,
    )
    if not cfg.implicit.heading_patterns:
        cfg = replace(cfg, implicit=replace(cfg.implicit, enabled=False))
    rows = [(None, "rules", f"{place}{'.' * bool(key)}{key} does not compile") for place, key in sorted(bad)]
    return cfg, spark.createDataFrame(rows, ERRORS)


@dataclass(frozen=True)
class Parted:
    """Pages of sound documents, and the errors of all others."""

    pages: DataFrame  # doc_id, page_no long, text string
    errors: DataFrame  # doc_id string, step, error


def part_pages(raw: DataFrame) -> Parted:
    """Part raw pages by document: one bad page sets its whole document aside, as a document with a hole is not the document.

    ``raw``: ``doc_id``, ``page_no`` (a number or text), ``text`` (text or bytes, taken as UTF-8), and ``error`` where the reader
    has one; other columns are dropped.  Errors: ``no document``, ``page number`` (null, no whole number, below 1 or above 2**31 - 1),
    ``repeated page``, ``missing page`` (numbers are not 1, 2, ... n), ``encoding``, and the reader's own.  A null text is an empty page.
    """
    text, number = F.col("text"), F.col("page_no")
    if dict(raw.dtypes)["text"] == "binary":
        text = text.cast("string")
    number = F.try_to_number(F.trim(number), F.lit("9999999999")).cast("long") if dict(raw.dtypes)["page_no"] == "string" else number.try_cast("long")
    df = raw.select("doc_id", number.alias("page_no"), text.alias("text"), (F.col("error") if "error" in raw.columns else F.lit(None).cast("string")).alias("own"))
    same = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "page_no")) > 1
    whole = Window.partitionBy("doc_id")
    sound = F.coalesce(F.col("page_no").between(1, LARGEST_PAGE), F.lit(False))
    gap = F.max(F.when(sound, F.col("page_no"))).over(whole) > F.count(F.lit(1)).over(whole)
    error = F.when(F.col("own").isNotNull(), F.col("own")).when(F.col("doc_id").isNull(), "no document").when(~sound, "page number").when(~F.coalesce(F.is_valid_utf8("text"), F.lit(True)), "encoding").when(same, "repeated page").when(gap, "missing page")
    df = df.withColumn("error", error)
    errors = df.filter("error is not null").select(F.col("doc_id").cast("string").alias("doc_id"), F.when(F.col("own").isNotNull(), "read").otherwise("pages").alias("step"), "error").distinct()
    bad = F.max(F.col("error").isNotNull()).over(whole)  # the same exchange serves the next step's windows
    return Parted(df.withColumn("bad", bad).filter(~F.col("bad")).select("doc_id", "page_no", "text"), errors)


def broken_promises(step: str, df: DataFrame, promises: dict[str, str] | None = None) -> DataFrame:
    """Errors of a step's table."""
    tests: list[Column] = [F.when(F.expr(test), F.lit(name)) for name, test in (PROMISES[step] if promises is None else promises).items()]
    found = df.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(F.array_compact(F.array(*tests))).alias("error"))
    return found.select("doc_id", F.lit(step).alias("step"), "error").distinct()
