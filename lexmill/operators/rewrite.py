"""The passes that rewrite sections, in order: table merge, rating plates, implicit subsections."""

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RuleConfig
from ..functions import text as X
from .content import is_rating_plate

ORDER = ("section_seq", "rating_seq", "implicit_seq")


def merge_tables(sections: DataFrame) -> DataFrame:
    """Adjacent dotted-table sections under one parent become the first of them."""
    w = Window.partitionBy("doc_id").orderBy("section_seq")
    can = F.coalesce((F.col("role") == "table") & (F.get("tables", F.lit(0))["format"] == "dotted_leader"), F.lit(False))
    df = sections.withColumn("can", can)
    joins = F.coalesce(F.col("can") & F.lag("can").over(w) & F.lag("parent_id").over(w).eqNullSafe(F.col("parent_id")), F.lit(False))
    df = df.withColumn("joins", joins).withColumns({"island": F.sum((~F.col("joins")).cast("int")).over(w), "joined": F.col("joins") | F.lead("joins", 1, False).over(w)})
    names = [c for c in sections.columns if c not in ("doc_id",)]
    part = F.when(F.col("joined"), F.struct("section_seq", F.when(F.col("can"), F.get("tables", F.lit(0))["csv"]).alias("csv"), "text"))  # a section by itself, as most are, has no parts
    g = df.groupBy("doc_id", "island").agg(F.min_by(F.struct(*names), "section_seq").alias("f"), F.sort_array(F.collect_list(part)).alias("parts"), F.max("page_end").alias("pe"), F.max("char_end").alias("ce"), F.flatten(F.collect_list(F.when(F.col("joined"), F.col("tags")))).alias("ts"))
    many = F.size("parts") > 1
    lines = F.transform("parts", lambda p, i: F.when(i == 0, X.csv_lines(p["csv"])).otherwise(F.slice(X.csv_lines(p["csv"]), 2, 1 << 30)))
    flat = F.flatten(lines)
    grown = F.size(flat) > F.size(F.get(lines, F.lit(0)))
    table = F.get("f.tables", F.lit(0))
    first = F.when(many & grown, table.withField("csv", F.array_join(flat, "\n")).withField("n_rows", F.size(flat))).otherwise(table)
    merged = F.when(many, F.concat(F.array(first), F.slice("f.tables", 2, 1 << 30))).otherwise(F.col("f.tables"))
    text = F.when(many, X.strip(F.array_join(F.filter(F.transform("parts", lambda p: p["text"]), lambda t: t != ""), "\n"))).otherwise(F.col("f.text"))
    new = {"tables": merged, "text": text, "page_end": F.when(many, F.col("pe")).otherwise(F.col("f.page_end")), "char_end": F.when(many, F.col("ce")).otherwise(F.col("f.char_end")), "tags": F.when(many, X.sorted_set(F.col("ts"))).otherwise(F.col("f.tags"))}
    return g.select("doc_id", *[new.get(c, F.col(f"f.{c}")).alias(c) for c in names])


def _line_starts(lines: Column) -> Column:
    """Offsets of lines in their text."""
    return X.running_sums(F.transform(lines, lambda x: F.length(x) + 1))


def _blocks(heads: Column, starts: Column, text: Column) -> Column:
    """Blocks from each head line to the next, with their stripped text."""
    def block(h: Column, k: Column) -> Column:
        start = F.element_at(starts, h["i"] + 1)
        end = F.when(k + 1 < F.size(heads), F.element_at(starts, F.get(heads, k + 1)["i"] + 1)).otherwise(F.length(text))
        return F.struct(h.alias("head"), start.alias("start"), X.strip(F.substring(text, start + 1, end - start)).alias("text"))

    return F.transform(heads, block)


def split_rating_plates(sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    """A child for each line with a brand; the parent is emptied.  Adds ``rating_seq`` (0 for a section itself)."""
    rp = cfg.rating_plate
    if not rp.enabled or not rp.brands:
        return sections.withColumn("rating_seq", F.lit(0))
    # How a region follows a brand, and what a region is where none are listed.
    quote = lambda words: "|".join(re.escape(w).replace("\\ ", " ") for w in words)
    region = f"(?:[, ]+({quote(rp.region_tokens) if rp.region_tokens else '[A-Za-z/]{2,5}'})[\\s\\u2010\\u00ad-]*version)?"
    p = X.rule(f"({quote(rp.brands)}){region}", nocase=True)
    tags = F.array(*[F.lit(t) for t in rp.default_tags]).cast("array<string>")
    lines = F.split(F.translate("text", "­‐‑", "---"), "\n", -1)
    df = sections.withColumn("ls", F.when(is_rating_plate(F.col("title"), F.col("text"), cfg) & (F.col("text") != ""), lines).otherwise(F.array().cast("array<string>")))
    found = F.transform("ls", lambda x, i: F.struct(i.alias("i"), X.strip(F.regexp_extract(x, p, 1)).alias("brand"), F.regexp_extract(x, p, 2).alias("region")))
    df = df.withColumn("heads", F.filter(found, lambda h: h["brand"] != "")).withColumn("starts", _line_starts(F.col("ls")))
    df = df.withColumn("blocks", F.filter(_blocks(F.col("heads"), F.col("starts"), F.col("text")), lambda b: b["text"] != ""))
    names = [c for c in sections.columns if c != "doc_id"]
    own = F.size("blocks") > 0
    empty = {"text": F.when(own, "").otherwise(F.col("text")), "char_end": F.when(own, F.col("char_start")).otherwise(F.col("char_end")), "tags": F.when(own, X.sorted_set(F.concat("tags", tags))).otherwise(F.col("tags"))}
    empty |= {c: F.when(own, F.array().cast(sections.schema[c].dataType.simpleString())).otherwise(F.col(c)) for c in ("tables", "figures")}
    parent = F.struct(*[empty.get(c, F.col(c)).alias(c) for c in names])

    def child(b: Column) -> Column:
        s, low = X.slug(b["head"]["brand"]), F.lower(b["head"]["region"])
        some = low != ""
        tail = F.concat(s, F.when(some, F.concat(F.lit("_"), low)).otherwise(""))
        new = {
            "section_id": F.concat("section_id", F.lit("_"), tail), "parent_id": F.col("section_id"), "title": F.concat("title", F.lit(" - "), b["head"]["brand"], F.when(some, F.concat(F.lit(", "), b["head"]["region"], F.lit("-version"))).otherwise("")),
            "title_normalized": F.concat("title_normalized", F.lit("_"), tail), "role": F.lit("figure"), "level": F.col("level") + 1, "char_start": F.col("char_start") + b["start"], "char_end": F.col("char_start") + b["start"] + F.length(b["text"]), "text": b["text"],
            "tables": F.array().cast(sections.schema["tables"].dataType.simpleString()), "tags": X.sorted_set(F.concat("tags", tags, F.array(s), F.when(some, F.array(low)).otherwise(F.array().cast("array<string>")))),
        }
        return F.struct(*[new.get(c, F.col(c)).cast(sections.schema[c].dataType.simpleString()).alias(c) for c in names])

    kind = parent_type(sections, names)
    both = F.concat(F.array(parent).cast(kind), F.transform("blocks", child).cast(kind))
    return df.select("doc_id", F.posexplode(both).alias("rating_seq", "s")).select("doc_id", "rating_seq", "s.*")


def parent_type(sections: DataFrame, names: list[str]) -> str:
    return "array<struct<" + ",".join(f"`{c}`:{sections.schema[c].dataType.simpleString()}" for c in names) + ">>"


def split_implicit(sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    """A child for each block under an unnumbered heading line, with an id of its own.  Adds ``implicit_seq`` (0 for a section itself)."""
    out = implicit_children(sections, cfg)
    return _unique_ids(out) if cfg.implicit.enabled else out


def implicit_children(sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    """As ``split_implicit``, but ids may repeat."""
    im = cfg.implicit
    if not im.enabled:
        return sections.withColumn("implicit_seq", F.lit(0))
    names = [c for c in sections.columns if c != "doc_id"]

    def title(bare: Column) -> Column:
        out = None
        for p in im.heading_patterns:
            hit = bare.rlike(X.rule(p, start=True)) & (X.words(bare) <= im.max_heading_words)
            got = X.strip_chars(F.regexp_extract(bare, X.rule(p, start=True), 1), " :")
            out = F.when(hit, got) if out is None else out.when(hit, got)
        return F.when(bare != "", out)

    df = sections.withColumn("ls", F.split("text", "\n", -1))
    bare = F.transform("ls", X.strip)  # once a line; a lambda writes out again what it is given as an expression
    heads = F.filter(F.transform(bare, lambda x, i: F.struct(i.alias("i"), title(x).alias("title"))), lambda h: h["title"].isNotNull())
    df = df.withColumn("heads", heads).withColumn("heads", F.when((F.col("text") != "") & (F.size("heads") >= 2), F.col("heads")).otherwise(F.slice("heads", 1, 0)))
    df = df.withColumn("starts", F.when(F.size("heads") > 0, _line_starts(F.col("ls"))))
    df = df.withColumn("blocks", F.filter(_blocks(F.col("heads"), F.col("starts"), F.col("text")), lambda b: F.length(b["text"]) >= im.min_block_chars))
    own = F.size("blocks") > 0
    prefix = X.strip(F.substring("text", F.lit(1), F.element_at("starts", F.get("heads", F.lit(0))["i"] + 1)))
    empty = {"text": F.when(own, prefix).otherwise(F.col("text")), "char_end": F.when(own, F.col("char_start") + F.length(prefix)).otherwise(F.col("char_end"))}
    parent = F.struct(*[empty.get(c, F.col(c)).alias(c) for c in names])

    def child(b: Column) -> Column:
        tail = X.normalized_title(b["head"]["title"])
        new = {
            "section_id": F.concat("section_id", F.lit("_"), tail), "parent_id": F.col("section_id"), "title": b["head"]["title"], "title_normalized": F.concat("title_normalized", F.lit("_"), tail), "role": F.lit("main"), "level": F.col("level") + 1,
            "char_start": F.col("char_start") + b["start"], "char_end": F.col("char_start") + b["start"] + F.length(b["text"]), "text": b["text"], "tables": F.array(), "figures": F.array(),
        }
        return F.struct(*[new.get(c, F.col(c)).cast(sections.schema[c].dataType.simpleString()).alias(c) for c in names])

    kind = parent_type(sections, names)
    both = F.concat(F.array(parent).cast(kind), F.transform("blocks", child).cast(kind))
    return df.select("doc_id", F.posexplode(both).alias("implicit_seq", "s")).select("doc_id", "implicit_seq", "s.*")


def _unique_ids(sections: DataFrame) -> DataFrame:
    """Implicit children whose id is taken get ``_2``, ``_3`` ... in order.

    Only ids that are equal once numbers at their ends are cut off can collide.  The numbers are found over the keys alone, so that no
    window sorts the texts; what comes back has the ids that change and nothing else.
    """
    keys = sections.select("doc_id", *ORDER, "section_id").withColumn("root_", F.regexp_replace("section_id", "(?:_[0-9]+)+$", ""))
    some = F.max(F.col("implicit_seq") > 0).over(Window.partitionBy("doc_id", "root_"))
    ids = _numbered(keys.withColumn("any_", some).filter("any_"))  # without a child there is nothing to number; all plain sections of a document share the root "sec"
    out = sections.join(ids, ["doc_id", *ORDER], "left").withColumn("section_id", F.coalesce("fresh", "section_id"))
    return out.select(*sections.columns)


def _numbered(keys: DataFrame) -> DataFrame:
    """``doc_id, section_seq, rating_seq, implicit_seq, fresh`` of children whose id changes, from groups with one root in which an id occurs twice.

    Where all of a group are the same id, a child's number is its rank; the others (an id that looks like a numbered one is there) are
    folded, one after the other.
    """
    key = F.struct(*ORDER)
    per = keys.groupBy("doc_id", "root_").agg(
        F.collect_set(F.when(F.col("implicit_seq") == 0, F.col("section_id"))).alias("used"), F.array_sort(F.collect_list(F.when(F.col("implicit_seq") > 0, F.struct(key.alias("key"), "section_id")))).alias("new"), F.max(F.col("section_id") != F.col("root_")).alias("mixed"),
        F.size(F.collect_set("section_id")).alias("d"), F.count("*").alias("n"),
    ).filter("size(new) > 0 and d < n")

    def step(acc: Column, x: Column) -> Column:
        used, cand = acc["used"], x["section_id"]
        like = F.filter(used, lambda u: F.startswith(u, F.concat(cand, F.lit("_"))))  # the names tried are among these or free
        free = F.get(F.array_except(F.transform(F.sequence(F.lit(2), F.size(like) + 2), lambda n: F.concat(cand, F.lit("_"), n.cast("string"))), like), F.lit(0))
        got = F.when(F.array_contains(used, cand), free).otherwise(cand)
        return F.struct(F.array_append(used, got).alias("used"), F.array_append(acc["out"], got).alias("out"))

    zero = F.struct(F.col("used").alias("used"), F.array().cast("array<string>").alias("out"))
    nth = lambda i: i + 1 + F.size("used")
    ranked = F.transform("new", lambda x, i: F.when(nth(i) > 1, F.concat(x["section_id"], F.lit("_"), nth(i).cast("string"))).otherwise(x["section_id"]))
    ids = per.withColumn("out", F.when(F.col("mixed"), F.aggregate("new", zero, step)["out"]).otherwise(ranked))
    ids = ids.select("doc_id", F.explode(F.filter(F.zip_with("new", "out", lambda x, y: F.struct(x["key"].alias("key"), x["section_id"].alias("was"), y.alias("fresh"))), lambda z: z["was"] != z["fresh"])).alias("z"))
    return ids.select("doc_id", *[F.col(f"z.key.{c}").alias(c) for c in ORDER], F.col("z.fresh").alias("fresh"))
