"""Lines to sections: the stack of open sections as windows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

EVER = Window.unboundedPreceding


def number_lines(lines: DataFrame) -> DataFrame:
    """Kept lines with the 1-based number of their section and whether they open it; a preface counts as a section."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    kept = lines.filter("reason is null")
    df = kept.withColumns({"head": F.col("level").isNotNull(), "preface": F.first(F.col("level").isNull()).over(w)})
    seq = F.sum(F.col("head").cast("int")).over(w.rowsBetween(EVER, 0)) + F.col("preface").cast("int")
    return df.withColumn("section_seq", seq.cast("int"))


def section_drafts(lines: DataFrame) -> DataFrame:
    """``doc_id, section_seq, section_id, parent_id, title, title_normalized, level, depth, parent_seq, page_start, page_end, char_start, char_end, text``."""
    n = number_lines(lines)
    body = F.when(~F.col("head"), F.struct("line_no", "text"))
    d = n.groupBy("doc_id", "section_seq").agg(
        F.max(F.when(F.col("head"), F.col("clean"))).alias("heading"), F.max("level").alias("level"), F.min("page_no").alias("page_start"), F.max("page_no").alias("own_page_end"), F.min("start").alias("char_start"), F.max("end").alias("own_end"),
        F.array_join(F.transform(F.sort_array(F.collect_list(body)), lambda x: x["text"]), "\n").alias("raw"),
    )
    d = d.withColumns({"title": F.coalesce("heading", F.lit("Preface")), "level": F.coalesce("level", F.lit(1)), "text": X.strip(F.col("raw"))})
    w = Window.partitionBy("doc_id").orderBy("section_seq")
    low = F.min(F.col("level") - F.col("section_seq")).over(w.rowsBetween(EVER, 0))
    d = d.withColumn("depth", (F.col("section_seq") + F.least(F.lit(0), low)).cast("int"))
    # What follows is read backwards: Spark works out a frame up to the last row anew for each row, which is quadratic in a document's sections.
    before, after = w.rowsBetween(EVER, -1), Window.partitionBy("doc_id").orderBy(F.desc("section_seq")).rowsBetween(EVER, -1)
    parent = closer = None
    for k in (1, 2, 3):
        p = F.last(F.when(F.col("depth") == k - 1, F.col("section_seq")), True).over(before) if k > 1 else F.lit(None).cast("int")
        c = F.last(F.when(F.col("level") <= k, F.struct(F.col("char_start").alias("at"), F.col("page_start").alias("page"))), True).over(after)
        parent = F.when(F.col("depth") == k, p) if parent is None else parent.when(F.col("depth") == k, p)
        closer = F.when(F.col("depth") == k, c) if closer is None else closer.when(F.col("depth") == k, c)
    number = F.regexp_extract(F.replace(F.coalesce("heading", F.lit("0 PREFACE")), F.lit(" "), F.lit("")), "(?U)^(\\d+(?:\\.\\d+)*)", 1)
    d = d.withColumns({"parent_seq": parent, "closer": closer, "title_normalized": X.normalized_title(F.col("title"))})
    d = d.withColumn("base", F.when(number != "", F.replace(number, F.lit("."), F.lit("_"))).otherwise(F.col("title_normalized")))
    nth = F.row_number().over(Window.partitionBy("doc_id", "base").orderBy("section_seq"))
    d = d.withColumn("section_id", F.concat(F.lit("sec_"), F.col("base"), F.when(nth > 1, F.concat(F.lit("_"), nth.cast("string"))).otherwise("")))
    d = d.withColumns({
        "char_end": F.coalesce(F.greatest(F.col("closer.at") - 1, F.col("own_end")), F.col("own_end")), "page_end": F.coalesce("closer.page", "own_page_end"),
    })
    parents = F.last(F.when(F.col("depth") == 1, F.col("section_id")), True).over(before), F.last(F.when(F.col("depth") == 2, F.col("section_id")), True).over(before)
    d = d.withColumn("parent_id", F.when(F.col("depth") == 2, parents[0]).when(F.col("depth") == 3, parents[1]))
    return d.select("doc_id", "section_seq", "section_id", "parent_id", "title", "title_normalized", F.col("level").cast("int").alias("level"), "depth", "parent_seq", "page_start", "page_end", "char_start", "char_end", "text")
