"""Quality, nested documents and the corpus summary."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RuleConfig
from ..functions import text as X
from .lines import discarded
from .rewrite import ORDER


QUALITY = ("doc_id", "page_count", "total_chars", "discarded_chars", "text_chars", "tables_extracted", "figures_detected", "text_coverage_ratio", "notes")


def counted(pages: DataFrame, lines: DataFrame, sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    """The quality of each document with ``n_sections, n_discarded`` and, of sections with warnings, ``n_warnings``."""
    count = pages.groupBy("doc_id").agg(F.count("*").alias("page_count"))
    gone = F.col("reason").isNotNull()
    read = lines.groupBy("doc_id").agg(  # a page's text is its lines with a line end between them
        (F.sum(F.length("text") + 1) - F.count_distinct("page_no")).alias("total_chars"), F.coalesce(F.sum(F.when(gone, F.length("text") + 1)), F.lit(0)).alias("discarded_chars"), F.count(F.when(gone, 1)).alias("n_discarded")
    )
    sums = [F.sum(F.length("text")).alias("text_chars"), F.sum(F.size("tables")).alias("tables_extracted"), F.sum(F.size("figures")).alias("figures_detected"), F.count("*").alias("n_sections")]
    if "warnings" in sections.columns:
        sums.append(F.sum(_warned(F.col("warnings"), F.col("role"))).alias("n_warnings"))
    df = count.join(read, "doc_id", "left").join(sections.groupBy("doc_id").agg(*sums), "doc_id", "left").na.fill(0)
    ratio = F.col("text_chars") / F.greatest(F.col("total_chars") - F.col("discarded_chars"), F.lit(1))
    note = F.format_string(f"Text coverage below threshold (%.2f < {cfg.min_text_coverage:.2f})", ratio)
    return df.withColumns({"text_coverage_ratio": F.round(ratio, 4), "notes": F.when(ratio < cfg.min_text_coverage, note).otherwise("")})


def quality(pages: DataFrame, lines: DataFrame, sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    """``doc_id, page_count, total_chars, discarded_chars, text_chars, tables_extracted, figures_detected, text_coverage_ratio, notes``."""
    return counted(pages, lines, sections, cfg).select(*QUALITY)


def _warned(found, role) -> F.Column:
    """How many warnings a section counts for."""
    return F.when(F.size(found) > 0, F.size(found)).when(F.lower(role) == "warning", 1).otherwise(0)


def section_rows(sections: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Each section as its document has it: ``doc_id``, the columns of its order, and ``s``."""
    fields = ["section_id", "parent_id", "title", "title_normalized", "role", "level", F.lit(cfg.language).alias("language"), F.lit(1.0).alias("language_confidence"), F.col("page_start").cast("int").alias("page_start"), F.col("page_end").cast("int").alias("page_end"), "char_start", "char_end", "text", F.lit(False).alias("is_suspect"), "tables", "figures", "tags", "warnings"]
    return sections.select("doc_id", *ORDER, F.struct(*fields).alias("s"))


def block_rows(lines: DataFrame) -> DataFrame:
    """Each discarded line as its document has it: ``doc_id, line_no, b``."""
    return discarded(lines).select("doc_id", "line_no", F.struct("reason", "text", F.col("page_no").cast("int").alias("page")).alias("b"))


def headed(quality_: DataFrame, cfg: RuleConfig, files: DataFrame | None = None, *more: str) -> DataFrame:
    """What a nested document has besides its sections and discarded blocks, and the columns ``more`` of ``quality_``."""
    none = F.lit(None).cast("string")
    df = quality_
    if files is not None:
        key = "doc_id" if "doc_id" in files.columns else "stem"
        df = df.join(files.select(F.col(key).alias("doc_id"), F.col("stem").alias("stem_"), "path", "filename", "checksum_sha256"), "doc_id", "left")
    else:
        df = df.withColumns({"stem_": none, "path": none, "filename": none, "checksum_sha256": none})
    stem = F.coalesce("stem_", F.col("doc_id").cast("string"))
    texts = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    source = F.struct(F.col("path").alias("uri"), "filename", F.lit("application/pdf").alias("mime_type"), "checksum_sha256", F.col("page_count").cast("int").alias("page_count"))
    meta = F.struct(*[none.alias(c) for c in ("product_hint", "model_hint", "brand_hint", "doc_type", "version")], F.lit(None).cast("int").alias("year"))
    limits = F.struct(texts(cfg.skip.values()).alias("skip_patterns"), F.lit(cfg.max_chars_per_section).cast("int").alias("max_chars_per_section"), texts(cfg.allowed_entities).alias("allowed_entities"), texts(cfg.allowed_relations).alias("allowed_relations"))
    score = F.struct("text_coverage_ratio", F.col("tables_extracted").cast("int").alias("tables_extracted"), F.col("figures_detected").cast("int").alias("figures_detected"), "notes")
    return df.select(
        "doc_id", X.document_code(stem).alias("document_code"), stem.alias("title"), F.lit(cfg.datasource_code).alias("datasource_code"), F.lit(cfg.language).alias("language"), F.expr("uuid()").alias("ingestion_id"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_utc"), source.alias("source"), meta.alias("metadata"), limits.alias("extraction_constraints"), score.alias("quality"), *more,
    )


def nested(quality_: DataFrame, lines: DataFrame, sections: DataFrame, cfg: RuleConfig, files: DataFrame | None = None) -> DataFrame:
    """One nested row for each document.  ``files`` adds source metadata by ``doc_id`` (or ``stem`` where it has none), and the stem names the document; else the id does."""
    s = section_rows(sections, cfg).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(F.struct(*ORDER).alias("k"), "s"))).alias("x")).select("doc_id", F.col("x.s").alias("sections"))
    d = block_rows(lines).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "b"))).alias("x")).select("doc_id", F.col("x.b").alias("discarded_blocks"))
    head = headed(quality_, cfg, files)
    df = head.join(s, "doc_id", "left").join(d, "doc_id", "left")
    empty = lambda c: F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType.simpleString())).alias(c)
    at = head.columns.index("extraction_constraints")
    return df.select(*head.columns[:at], empty("sections"), *head.columns[at:], empty("discarded_blocks"))


def json_parts(quality_: DataFrame, lines: DataFrame, sections: DataFrame, cfg: RuleConfig, files: DataFrame | None = None) -> DataFrame:
    """The JSON texts of nested documents (nulls kept) in parts that give them when put together: ``doc_id, title, part, at array<long>, joint, json``.

    Parts are in order by ``part, at``; between two that are ``joint`` goes a comma.  No row holds a whole document.
    """
    head = headed(quality_, cfg, files)
    names = [c for c in head.columns if c != "doc_id"]
    cut = names.index("extraction_constraints")
    inner = lambda cols: F.regexp_extract(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), r"(?s)\A\{(.*)\}\z", 1)  # noqa: E731  an object's text without its braces
    at = lambda *cols: F.array(*[F.col(c).cast("long") for c in cols]) if cols else F.array().cast("array<long>")
    frame = F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.concat(F.lit("{"), inner(names[:cut]), F.lit(',"sections":[')).alias("json")),
        F.struct(F.lit(2).alias("part"), F.concat(F.lit("],"), inner(names[cut:]), F.lit(',"discarded_blocks":[')).alias("json")),
        F.struct(F.lit(4).alias("part"), F.lit("]}").alias("json")),
    )).alias("f")
    titles = head.select("doc_id", "title")
    frames = head.select("doc_id", "title", frame).select("doc_id", "title", "f.part", at().alias("at"), F.lit(False).alias("joint"), "f.json")
    of = lambda rows, part, order, x: rows.select("doc_id", F.lit(part).alias("part"), at(*order).alias("at"), F.lit(True).alias("joint"), F.to_json(x, {"ignoreNullFields": "false"}).alias("json")).join(F.broadcast(titles), "doc_id")
    return frames.unionByName(of(section_rows(sections, cfg), 1, ORDER, "s")).unionByName(of(block_rows(lines), 3, ("line_no",), "b"))


def headers(counted_: DataFrame, cfg: RuleConfig, files: DataFrame | None = None) -> DataFrame:
    """Nested documents with the numbers of their sections and discarded blocks in place of these."""
    return headed(counted_, cfg, files, "n_sections", "n_discarded")


def counters(counted_: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """What ``summary`` gives of the nested documents, by what was counted for each; no row for an empty corpus."""
    if files is not None:  # a document with several files is nested once for each
        key = "doc_id" if "doc_id" in files.columns else "stem"
        counted_ = counted_.join(files.select(F.col(key).alias("doc_id")), "doc_id", "left")
    total = lambda c: F.sum(c).cast("long")
    df = counted_.agg(
        F.count("*").alias("documents"), F.sum(F.col("page_count").cast("int")).alias("pages"), total("n_sections").alias("sections"), total("figures_detected").alias("figures"), total("tables_extracted").alias("tables"), total("n_warnings").alias("warnings"), F.avg("text_coverage_ratio").alias("avg_text_coverage"),
    )
    return df.filter("documents > 0")


def summary(docs: DataFrame) -> DataFrame:
    """Corpus counters over nested documents; no row for an empty corpus."""
    found = lambda s: _warned(s["warnings"], s["role"])
    total = lambda f: F.sum(F.aggregate("sections", F.lit(0).cast("long"), lambda a, s: a + f(s))).cast("long")
    df = docs.agg(
        F.count("*").alias("documents"), F.sum("source.page_count").alias("pages"), F.sum(F.size("sections")).cast("long").alias("sections"), total(lambda s: F.size(s["figures"])).alias("figures"), total(lambda s: F.size(s["tables"])).alias("tables"), total(found).alias("warnings"), F.avg("quality.text_coverage_ratio").alias("avg_text_coverage"),
    )
    return df.filter("documents > 0")
