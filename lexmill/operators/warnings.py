"""Warning mentions with their sentences."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RuleConfig
from ..functions import text as X

KIND = "array<struct<type:string,text:string,keyword:string>>"


def _mentions(text: Column, pattern: str, window: int) -> Column:
    p = X.rule(pattern, nocase=True, multiline=True)
    whole, gaps = F.regexp_extract_all(text, F.lit(p), F.lit(0)), F.split(text, p, -1)
    keys = whole
    if re.compile(pattern).groups:  # the first group names the mention, or the whole where it takes no part
        keys = F.zip_with(F.regexp_extract_all(text, F.lit(p), F.lit(1)), whole, lambda k, w: F.when(k == "", w).otherwise(k))

    # Each step names what the next one needs, so that no expression is written out twice.
    n = F.length(text)
    before = X.running_sums(F.transform(whole, lambda m, i: F.length(F.get(gaps, i)) + F.length(m)))  # what lies before a match and its gap
    spots = F.zip_with(before, F.transform(whole, lambda m, i: F.struct(F.length(m).alias("n"), F.length(F.get(gaps, i)).alias("gap"), F.get(keys, i).alias("key"))), lambda at, m: F.struct((at + m["gap"]).alias("at"), m["n"].alias("n"), m["key"].alias("key")))
    spots = F.transform(spots, lambda s: F.struct(s["key"].alias("key"), F.greatest(F.lit(0), s["at"] - window).alias("start"), s["at"].alias("at"), (s["at"] + s["n"]).alias("end")))
    views = F.transform(spots, lambda s: F.struct(s["key"].alias("key"), F.substring(text, s["start"] + 1, F.least(n, s["end"] + window) - s["start"]).alias("view"), (s["at"] - s["start"]).alias("a"), (s["end"] - s["start"]).alias("b")))
    cuts = F.transform(views, lambda v: F.struct(v["key"].alias("key"), v["view"].alias("view"), v["a"].alias("a"), F.instr(F.reverse(F.substring(v["view"], F.lit(1), v["a"])), " .").alias("back"), _locate(v["view"], v["b"] + 1).alias("right")))
    cuts = F.transform(cuts, lambda c: F.struct(c["key"].alias("key"), c["right"].alias("right"), F.when(c["back"] > 0, F.substring(c["view"], c["a"] - c["back"] + 2, F.length(c["view"]))).otherwise(c["view"]).alias("view")))
    severe = lambda k: F.when(k.rlike("(?i)warning|caution|danger|not compatible"), "warning").otherwise("note")
    return F.transform(cuts, lambda c: F.struct(severe(c["key"]).alias("type"), X.strip(F.when(c["right"] >= 0, F.substring(c["view"], F.lit(1), c["right"] + 1)).otherwise(c["view"])).alias("text"), c["key"].alias("keyword")))


def _locate(view: Column, first: Column) -> Column:
    """0-based place of the first ``". "`` at or after the 1-based ``first``; -1 if none."""
    rest = F.substring(view, first, F.length(view))
    at = F.instr(rest, ". ")
    return F.when(at > 0, first + at - 2).otherwise(-1)


def mentions(text: Column, cfg: RuleConfig) -> Column:
    """``array<struct<type, text, keyword>>``, each sentence once, by pattern and place."""
    if not cfg.warnings.enabled or not cfg.warnings.patterns:
        return F.array().cast(KIND)
    none = F.array().cast(KIND)
    # A text without a match, as most are, is read once for each pattern and not taken apart.
    found = lambda p: F.when(text.rlike(X.rule(p, nocase=True, multiline=True)), _mentions(text, p, cfg.warnings.snippet_window).cast(KIND)).otherwise(none)
    every = F.concat(*[found(p) for p in cfg.warnings.patterns])
    return F.when(text != "", every).otherwise(F.array().cast(KIND))


def annotate(sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Add ``warnings`` (null if none), the tag, and promote short sections to the role ``warning``."""
    df = sections.withColumn("found", mentions(F.col("text"), cfg))
    df = df.withColumn("texts", F.transform("found", lambda m: m["text"]))
    first = F.filter("found", lambda m, i: (m["text"] != "") & (F.array_position("texts", m["text"]) == i + 1))
    df = df.withColumn("warnings", F.when(F.size(first) > 0, first))
    some = F.col("warnings").isNotNull()
    short = F.col("role").isin("main", "table") & (F.length("text") < cfg.warnings.promote_role_max_chars)
    df = df.withColumns({"tags": F.when(some, X.sorted_set(F.concat("tags", F.array(F.lit("warning"))))).otherwise(F.col("tags")), "role": F.when(some & short, "warning").otherwise(F.col("role"))})
    return df.drop("found", "texts")
