"""Figures, legends, tables, tags and roles of sections."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RuleConfig
from ..functions import text as X

KEY = ("doc_id", "section_seq")
# Fixed value: the pattern of numbered legend items.
LEGEND = "^\\s*(\\d+)\\s*[.)]\\s+(.+?)(?=\\n\\s*\\d+[.)]|\\n\\n|$)"
TABLE = "array<struct<table_id:string,page:int,caption:string,n_rows:int,n_cols:int,csv:string,format:string>>"


def legend_items(text: Column) -> Column:
    """Numbered items as ``array<struct<number, description>>``."""
    p = F.lit(X.rule(LEGEND, multiline=True, dotall=True))
    both = F.arrays_zip(F.regexp_extract_all(text, p, F.lit(1)).alias("n"), F.regexp_extract_all(text, p, F.lit(2)).alias("d"))
    return F.transform(both, lambda x: F.struct(x["n"].try_cast("long").alias("number"), X.collapse(x["d"]).alias("description")))


def is_rating_plate(title: Column, text: Column, cfg: RuleConfig) -> Column:
    if not cfg.rating_plate.enabled:
        return F.lit(False)
    words = [w.lower() for w in cfg.rating_plate.title_keywords] or ["rating plate"]
    plain = lambda c: F.replace(F.lower(c), F.lit(" "), F.lit(" "))
    return X.has_any(plain(title), words) | X.has_any(plain(text), words)


def with_figures(sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    low, title = F.lower("text"), F.lower("title")
    df = sections.withColumn("legend", legend_items(F.col("text")))
    words = [w.lower() for w in cfg.figure_keywords]
    has = X.has_any(low, words) | X.has_any(title, words) | (F.size("legend") > 0)
    kind = F.when(is_rating_plate(F.col("title"), F.col("text"), cfg), "photo").when(low.contains("schematic"), "schematic").when(X.has_any(low, ("photo", "image", "picture")), "photo").otherwise("diagram")
    figure = F.struct(
        F.concat(F.lit("fig_"), X.without(F.col("section_id"), "sec_")).alias("figure_id"), F.col("page_start").cast("int").alias("page"), F.col("title").alias("caption"), kind.alias("type"), F.lit(None).cast("array<double>").alias("bbox"),
        (F.size("legend") > 0).alias("has_legend"), F.size("legend").alias("legend_items_count"), F.col("legend").alias("legend_items"),
    )
    # No lambda around these: what stands below one is not compiled, and the lower-cased texts would be made anew for each word.
    return df.withColumn("figures", F.when(has, F.array(figure)).otherwise(F.array())).drop("legend")


def table_lines(sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Lines of table runs: ``doc_id, section_seq, i, line, kind, run``.

    A line that could continue either run takes the kind of the last line that could not.
    """
    some = F.col("text").rlike("[|]|\\.{%d,}" % cfg.dotted_leader_threshold)  # without a separator there is no run
    fit = sections.filter(some & (F.size("figures") == 0) & ~is_rating_plate(F.col("title"), F.col("text"), cfg))
    rows = fit.select(*KEY, F.posexplode(F.split("text", "\n", -1)).alias("i", "line")).withColumn("bare", X.strip(F.col("line"))).filter("bare <> ''")
    pipe, dots = F.col("line").contains("|"), F.col("line").rlike("\\.{%d,}" % cfg.dotted_leader_threshold)
    mark = F.col("bare").startswith("-") | F.col("bare").startswith("*")
    sure = F.when(pipe & ~dots & ~mark, "pipe").when(dots & ~pipe, "dotted").when(~pipe & ~dots & ~mark, "none")
    w = Window.partitionBy(*KEY).orderBy("i")
    last = F.last("sure", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"sure": sure, "pipe": pipe}).withColumn("kind", F.coalesce("sure", F.when(last == "dotted", "dotted").when(F.col("pipe"), "pipe").otherwise("none")))
    new = (F.col("kind") != "none") & ~F.coalesce(F.lag("kind").over(w) == F.col("kind"), F.lit(False))
    return rows.withColumn("run", F.sum(new.cast("int")).over(w)).filter("kind <> 'none'").select(*KEY, "i", "line", "kind", "run")


def _pipe_rows(lines: Column, least: int) -> Column:
    def cells(line: Column) -> Column:
        c = F.transform(F.split(line, "[|]", -1), X.strip)
        c = F.when(F.get(c, F.lit(0)) == "", F.slice(c, 2, F.size(c))).otherwise(c)
        return F.when((F.size(c) > 0) & (F.element_at(c, -1) == ""), F.slice(c, 1, F.size(c) - 1)).otherwise(c)

    return F.filter(F.transform(lines, cells), lambda c: F.size(F.filter(c, lambda x: x != "")) >= least)


def _dotted_rows(lines: Column) -> Column:
    def row(line: Column) -> Column:
        parts = F.split(line, "[.]{3,}", 2)
        left, right = X.strip_chars(F.get(parts, F.lit(0)), " -\t"), X.strip(F.get(parts, F.lit(1)))
        bare = X.strip(X.strip_chars(line, "- "))
        dashed = F.when(X.strip(line).startswith("-") & (bare != ""), F.array(bare))
        return F.when(F.size(parts) > 1, F.when((left != "") | (right != ""), F.array(left, right))).otherwise(dashed)

    return F.filter(F.transform(lines, row), lambda r: r.isNotNull())


def tables(sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Valid tables of sections, ``doc_id, section_seq, table_no, caption, n_rows, n_cols, csv, format``; the caption is null where it is the section's title."""
    runs = table_lines(sections, cfg).groupBy(*KEY, "run", "kind").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]).alias("ls"))
    filled = lambda line: F.size(F.filter(F.split(line, "[|]", -1), lambda p: X.strip(p) != ""))
    pipe_ok = (F.size("ls") >= 2) & (F.array_max(F.transform("ls", filled)) >= cfg.min_pipe_columns)
    dotted = F.filter("ls", lambda x: x.rlike("\\.{3,}"))
    kinds = F.size(F.array_distinct(F.transform(dotted, lambda x: F.regexp_count(x, F.lit("\\.{3,}")))))
    dashes = F.forall(F.slice("ls", 1, 3), lambda x: X.strip(x).startswith("-"))
    dotted_ok = (F.size(dotted) >= cfg.min_consistent_rows) & (kinds <= cfg.max_separator_variance) & ~dashes
    rows = F.when(F.col("kind") == "pipe", F.when(pipe_ok, _pipe_rows(F.col("ls"), cfg.min_pipe_columns))).otherwise(F.when(dotted_ok, _dotted_rows(F.col("ls"))))
    df = runs.withColumn("rows", rows).filter("size(rows) > 0")
    other = F.filter("ls", lambda x: ~x.rlike("\\.{3,}") & ~X.strip(x).startswith("-"))
    caption = F.when((F.col("kind") == "dotted") & (F.size(other) > 0), X.strip(F.element_at(other, -1)))
    lone = F.size(F.get("rows", F.lit(0))) == 1
    pairs = F.when(lone, F.transform("rows", lambda r: F.array(F.get(r, F.lit(0)), F.lit("")))).otherwise(F.col("rows"))
    body = F.when(F.col("kind") == "pipe", F.col("rows")).otherwise(F.concat(F.array(F.array(F.lit("Item"), F.lit("Value"))), pairs))
    df = df.withColumns({"caption": caption, "body": body}).withColumn("table_no", F.row_number().over(Window.partitionBy(*KEY).orderBy("run")))
    return df.select(
        *KEY, "table_no", "caption", F.size("body").alias("n_rows"),
        F.when(F.col("kind") == "pipe", F.array_max(F.transform("rows", lambda r: F.size(r)))).otherwise(2).alias("n_cols"), X.strip(F.array_join(F.transform("body", X.csv_row), "\r\n")).alias("csv"),
        F.when(F.col("kind") == "pipe", "pipe_delimited").otherwise("dotted_leader").alias("format"),
    )


def with_tables(sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    fields = ("n_rows", "n_cols", "csv", "format")
    t = tables(sections, cfg).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("table_no", "caption", *fields))).alias("found_"))
    stem, page = F.concat(F.lit("tbl_"), X.without(F.col("section_id"), "sec_"), F.lit("_")), F.col("page_start").cast("int")

    def whole(x: Column) -> Column:
        return F.struct(F.concat(stem, x["table_no"].cast("string")).alias("table_id"), page.alias("page"), F.coalesce(x["caption"], F.col("title")).alias("caption"), *[x[f].alias(f) for f in fields])

    found = F.when(F.col("found_").isNotNull(), F.transform("found_", whole).cast(TABLE)).otherwise(F.array().cast(TABLE))
    return sections.join(t, list(KEY), "left").withColumn("tables", found).drop("found_")


def tags(cfg: RuleConfig) -> Column:
    low, title = F.lower("text"), F.lower("title")
    electrical = X.has_any(low, cfg.electrical)
    dims = X.has_any(low, [w.lower() for w in cfg.dimensions])
    listed = F.regexp_count("text", F.lit(X.rule(cfg.component_list_pattern, multiline=True))) >= 2 if cfg.component_list_pattern else F.lit(False)
    found = [
        (listed, "component_list"), (dims, "dimensions"), (dims, "measurements"), (electrical, "electrical_specs"), (electrical & X.has_any(low, ("voltage", "hz")), "voltage"), (X.has_any(low, cfg.model_codes) | X.has_any(title, cfg.model_codes), "model_codes"),
        (X.has_any(low, cfg.brand) | X.has_any(title, cfg.brand), "brand_specific"), (F.size("tables") > 0, "table_present"), (F.size("figures") > 0, "figure_present"),
    ]
    return X.sorted_set(F.array_except(F.array(*[F.when(c, F.lit(t)) for c, t in found]), F.array(F.lit(None).cast("string"))))


def role(cfg: RuleConfig) -> Column:
    content = F.lower(F.concat("title", F.lit("\n"), "text"))
    return F.when(F.size("figures") > 0, "figure").when(F.size("tables") > 0, "table").when(X.has_any(content, [w.lower() for w in cfg.warning_keywords]), "warning").otherwise("main")


def with_content(drafts: DataFrame, cfg: RuleConfig) -> DataFrame:
    df = with_tables(with_figures(drafts, cfg), cfg)
    return df.withColumn("tags", tags(cfg)).withColumn("role", role(cfg))
