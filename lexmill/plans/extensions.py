"""Queries of the modules around the structurer (splitting, quarantine, validation) and the same in DuckDB SQL."""

import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SECTIONS, SKIP, RuleConfig
from ..operators import content as C
from ..operators.document import summary
from ..operators.split import oracle_pieces, soft_split
from ..operators.validate import violations
from ..schemas import GRAPH
from ..scratch import Scratch
from ..sources.document_files import ParsedDocuments, Reread, file_names, read_documents
from ..sources.pages import MANUAL_SQL, manual_pages, odd_pages
from ..streaming.assembly import run_assembly
from .pipeline import RecordedPlan, SymbolicPlan, Verticals
from .queries import FREE, _IMPLICIT, _LINES, _RATIO, _SECTIONS, _WARNINGS, _flat, _longs, _plan

SECTION_BUDGET = 60  # sections of the manual-shaped corpus are short; whole documents are split by the shipped budget
BROKEN_RULES = replace(RuleConfig(), skip={**SKIP, "stamp": "(", "seal": "[a-"})


def _pieces(df: DataFrame, *keys: str) -> DataFrame:
    return _longs(df.select(*keys, "piece_no", "piece_start", "piece_end", F.md5(F.col("text").cast("binary")).alias("piece_md5")))


def split_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole ``documents`` cut at the shipped budget."""
    return _pieces(soft_split(spark.read.parquet(f"{d}/documents.parquet"), ["doc_id"], RuleConfig().max_chars_per_section), "doc_id")


def split_sections(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(soft_split(_plan(spark, d).drafts, ["doc_id", "section_seq"], SECTION_BUDGET), "doc_id", "section_seq")


def faulty_pages(spark: SparkSession, d: str) -> DataFrame:
    """The manual-shaped corpus as a reader may give it, with faults in the pages of some documents."""
    pages, n = manual_pages(spark, d), F.col("doc_id") % 10
    second = F.col("page_no") == 2
    number = F.when(second & (n == 3), "two").when(second & (n == 4), "1").when(second & (n == 6), "0").when(second & (n == 7), "4000000000").otherwise(F.col("page_no").cast("string"))
    text = F.when(second & (n == 5), F.concat(F.unhex(F.lit("ff")), F.col("text").cast("binary"))).otherwise(F.col("text").cast("binary"))
    return pages.filter(~(second & (n == 8))).select("doc_id", number.alias("page_no"), text.alias("text"))


def _guarded(spark: SparkSession, d: str) -> SymbolicPlan:
    return RecordedPlan.guarded(faulty_pages(spark, d), BROKEN_RULES)  # written steps keep the plans of many unions small


def quarantine_errors(spark, d):
    return _guarded(spark, d).errors


def quarantine_quality(spark, d):
    """Quality of the documents that no fault and no bad rule touched."""
    return _longs(_guarded(spark, d).quality.select("doc_id", "page_count", "total_chars", "discarded_chars", "text_chars", "tables_extracted", "figures_detected", "text_coverage_ratio", "notes"))


#: A graph of each manual as JSON text, with faults.
_JSON = """select p_partkey % 50 as doc_id, p_partkey, concat('{{"id": ', case when p_partkey % 31 = 0 then 'null' when p_partkey % 29 = 0 then '7' else concat('"p', cast(p_partkey as varchar(20)), '"') end,
      ', "type": "', case when p_partkey % 19 = 0 then 'Gizmo' else 'Component' end, '", "name": "', p_name, '", "confidence": ', case when p_partkey % 23 = 0 then '"high"' else '0.5' end,
      ', "spans": ', case when p_partkey % 37 = 0 then '{{}}' when p_partkey % 41 = 0 then '[{{"page": 1}}, {{"page": 1.5}}, 3]' else '[]' end, '}}') as entity from part"""
_WHOLE = """select doc_id, case when doc_id % 17 = 3 then concat('{{"entities": [', {list}, ']') when doc_id % 13 = 5 then concat('{{"entities": [', {list}, '], "relations": 1, "quality": {{"json_valid": "yes"}}}}')
    when doc_id = 11 then null when doc_id = 12 then '[]' when doc_id = 13 then '{{}}' else concat('{{"document_code": "M", "entities": [', {list}, '], "relations": []}}') end as json"""
REQUIRED = ("$.entities", "$.entities[].id")


def graph_violations(spark, d):
    """Graphs as JSON text against the universal schema, with faults at known places."""
    part = spark.read.parquet(f"{d}/part.parquet")
    entities = spark.sql(_JSON.replace(" from part", " from {part}"), part=part)  # which makes braces single
    listed = entities.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "entity"))), lambda x: x["entity"]), ",").alias("list"))
    return violations(spark.sql(_WHOLE.replace("{list}", "list") + " from {listed}", listed=listed), GRAPH, required=REQUIRED)


def document_violations(spark, d):
    """Nested documents against their schema: the reasons for discards that the corpus has are not in its list."""
    return RecordedPlan(manual_pages(spark, d), keep=("lines", "drafts", "plates", "sections")).violations


def _outputs(spark: SparkSession, d: str) -> Reread:
    """The nested documents as files, some of them spoilt, read again."""
    plan, n = RecordedPlan(manual_pages(spark, d), keep=("lines", "drafts", "plates", "sections")), F.col("doc_id") % 10
    parts, first = plan.json_parts, F.col("part") == 0
    body = F.col("json").cast("binary")
    spoilt = F.when(n == 3, F.substring(body, 1, 200)).when(n == 4, F.lit(b"")).when((n == 5) & first, F.concat(F.unhex(F.lit("ff")), body)).when(n == 6, F.lit(b'{"title": "x", "sections": 5}')).otherwise(body)
    parts = parts.filter(first | ~n.isin(3, 4, 6))  # a document's first part is longer than 200 bytes
    names = file_names(parts.filter(first).select("doc_id", "title"), F.col("doc_id"), F.col("title")).select("doc_id", "file")
    rows = parts.select("doc_id", "part", "at", "joint", spoilt.alias("doc")).join(F.broadcast(names), "doc_id")
    rows = rows.repartition("file").sortWithinPartitions("file", "part", "at").select("file", "doc", "joint")
    spark.dataSource.register(ParsedDocuments)
    folder = Scratch(spark, "outputs").root
    rows.write.format("parsed_documents").options(raw="true", parts="true").mode("append").save(folder)
    return read_documents(spark, folder, plan.documents.drop("doc_id").schema)


def reread_summary(spark, d):
    """Corpus counters of the output files that can still be read."""
    return summary(_outputs(spark, d).documents).withColumn("avg_text_coverage", F.round("avg_text_coverage", 6))


def unreadable_outputs(spark, d):
    return _outputs(spark, d).warnings.select("filename", "problem")


#: A second vertical for documents with odd ids: no page is skipped, only page numbers go, chapters alone are headings.
PLAIN = replace(RuleConfig(), name="plain", skip_start_pages=0, skip_end_pages=0, skip={"page_number": SKIP["page_number"]}, section_patterns={"level1": SECTIONS["level1"]})


def _verticals(spark: SparkSession, d: str) -> Verticals:
    pages = manual_pages(spark, d).withColumn("vertical", F.when(F.col("doc_id") % 2 == 1, "plain").otherwise("product_technical"))
    return Verticals(pages, {"product_technical": RuleConfig(), "plain": PLAIN})


def vertical_lines(spark, d):
    return _longs(_verticals(spark, d).lines.select("vertical", "doc_id", "line_no", "page_no", F.col("start").alias("start_at"), "reason", "level"))


def vertical_sections(spark, d):
    """Sections of two verticals from one scan."""
    return _longs(_verticals(spark, d).all("drafts").select("vertical", "doc_id", "section_seq", "title", "level", "char_start", "text"))


def run_statistics(spark, d):
    """Rows and characters of the steps of a recorded run."""
    plan = RecordedPlan(manual_pages(spark, d))
    plan.sections  # noqa: B018  runs the steps
    return plan.statistics.select("pipeline", "step", "n_rows", "n_chars")


def assembled_pages(spark, d):
    """The manual-shaped corpus arriving page by page over three days, some pages late and some twice, put together again."""
    page, n = F.col("page_no"), F.col("doc_id") % 10
    pages = manual_pages(spark, d).withColumn("n_pages", F.count(F.lit(1)).over(Window.partitionBy("doc_id")))
    pages = pages.withColumn("hour", F.when((n == 3) & (page == 2), 70).when(n == 9, 20 * (page % 3) + 20).otherwise(page % 3))
    again = pages.filter((n == 4) & (page == 3)).withColumn("hour", F.lit(1))
    pages = Scratch(spark, "arrivals").save(pages.unionByName(again).withColumn("arrived_at", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("hour") * 3600)), "pages")
    to = Scratch(spark, "assembly").root
    for hour in (0, 1, 2, 20, 40, 60, 70):
        pages.filter(F.col("hour") == hour).coalesce(1).write.mode("append").parquet(f"{to}/in")
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(f"{to}/in")
    got = run_assembly(stream, f"{to}/out", f"{to}/checkpoint", wait_s=24 * 3600, keep_s=1000 * 3600)
    return got.select("doc_id", "page_no", "status", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def odd_table_runs(spark, d):
    """Lines of table runs where marks and both kinds of separators leave the kind open."""
    p = SymbolicPlan(odd_pages(spark, d), FREE, keep=())
    return _longs(C.table_lines(C.with_figures(p.drafts, p.cfg), p.cfg).groupBy("doc_id", "section_seq", "run", "kind").agg(F.count("*").alias("n")))


def odd_tables(spark, d):
    df = SymbolicPlan(odd_pages(spark, d), FREE, keep=("drafts",)).content
    return _longs(_flat(df, "tables", "table_id", "page", "caption", "n_rows", "n_cols", "csv", "format"))


def odd_section_ids(spark, d):
    """Implicit headings that repeat, and one that is called what a repeated one becomes."""
    df = SymbolicPlan(odd_pages(spark, d), FREE, keep=("drafts", "plates")).implicit
    return _longs(df.filter("implicit_seq > 0").select("doc_id", "section_seq", "implicit_seq", "section_id", "parent_id", "title"))


NAMES = (odd_table_runs, odd_tables, odd_section_ids, assembled_pages, vertical_lines, vertical_sections, run_statistics, reread_summary, unreadable_outputs, split_documents, split_sections, quarantine_errors, quarantine_quality, graph_violations, document_violations)


def oracle_sql() -> dict[str, str]:
    bad = "doc_id % 10 in (3, 4, 5, 6, 7, 8)"
    faults = """case doc_id % 10 when 5 then 'encoding' else 'page number' end"""
    entity_rules = " union all ".join(
        f"select doc_id, '$.entities[' || i || ']{path}' as path, '{rule}' as rule from placed where {test}"
        for path, rule, test in (
            (".id", "missing", "p_partkey % 31 = 0"), (".id", "not a string", "p_partkey % 31 <> 0 and p_partkey % 29 = 0"), (".type", "not allowed", "p_partkey % 19 = 0"), (".confidence", "not a number", "p_partkey % 23 = 0"),
            (".spans", "not an array", "p_partkey % 37 = 0"), (".spans[1].page", "not an integer", "p_partkey % 37 <> 0 and p_partkey % 41 = 0"), (".spans[2]", "not an object", "p_partkey % 37 <> 0 and p_partkey % 41 = 0"),
        )
    )
    read = "doc_id % 10 not in (3, 4, 5, 6)"
    odd = "with o as (select p_partkey % 50 as doc_id, p_partkey % 8 as t, p_name, row_number() over (partition by p_partkey % 50 order by p_partkey) as k from part)"
    plain = _SECTIONS.replace("where page_no > 1 and page_no <= greatest(n_pages - 1, 1)", "")
    plain = re.sub(r"case when regexp_matches\(clean, '\^\(\?i\)citiz.*?end as reason", r"case when regexp_matches(clean, '^\\s*\\d+\\s*$') then 'page_number' end as reason", plain, flags=re.S)
    plain = re.sub(r"when regexp_matches\(clean, '\^\\d\+\\\.\\d\+\\\.\\d.*?then 2 ", "", plain, flags=re.S)
    cut = lambda sections, vertical, test, what, table: f"select '{vertical}' as vertical, {what} from ({sections} select * from {table}) where doc_id % 2 {test}"
    two = lambda what, table: cut(_SECTIONS, "product_technical", "= 0", what, table) + " union all " + cut(plain, "plain", "= 1", what, table)
    step = lambda name, text, table: f"select 'product_technical' as pipeline, '{name}' as step, count(*) as n_rows, cast(coalesce(sum(length({text})), 0) as bigint) as n_chars from {table}"
    return {
        "odd_table_runs": f"""{odd} select doc_id, k as section_seq, cast(1 as bigint) as run, case when t in (2, 5) then 'pipe' else 'dotted' end as kind, cast(case t when 0 then 5 else 3 end as bigint) as n from o where t < 6""",
        "odd_tables": f"""{odd} select doc_id, k as section_seq, 'tbl_' || k || '_1_1' as table_id, k as page, case t when 0 then '* all sizes' else k || '.1 ' || p_name end as caption, cast(case t when 0 then 5 when 2 then 3 when 3 then 4 else 2 end as bigint) as n_rows,
          cast(case when t in (0, 3) then 2 else 3 end as bigint) as n_cols, replace(replace(case t when 0 then 'Item,Value~^Weight, net^,^5 ^^kg^^^~see note~Width,3 mm~Depth,4 mm' when 2 then 'Name,Type,Size~x,y ... z,4~q,r,s' when 3 then 'Item,Value~A,1~B | C,2~D,3'
          else '^a ^^b^^^,^c, d^,e~h,i,j' end, '~', chr(13) || chr(10)), '^', chr(34)) as csv, case when t in (2, 5) then 'pipe_delimited' else 'dotted_leader' end as format from o where t in (0, 2, 3, 5)""",
        "odd_section_ids": f"""{odd} select doc_id, k as section_seq, i as implicit_seq, 'sec_' || k || '_1_step_one' || case when i = 1 then '' when i = 2 then '_2' when t = 7 then '_3' else '_2_2' end as section_id, 'sec_' || k || '_1' as parent_id,
          'Step One' || case when t = 6 and i = 3 then ' 2' else '' end as title from o, range(1, 4) r(i) where t > 5""",
        "assembled_pages": f"""with p as ({MANUAL_SQL}) select cast(doc_id as varchar) as doc_id, page_no, case when doc_id % 10 <> 3 then 'whole' when page_no = 2 then 'late' else 'incomplete' end as status, md5(text) as text_md5 from p
          union all select cast(doc_id as varchar), page_no, 'repeated', md5(text) from p where doc_id % 10 = 4 and page_no = 3""",
        "vertical_lines": two("doc_id, line_no, page_no, start_at, reason, cast(level as bigint) as level", "levelled"),
        "vertical_sections": two("doc_id, section_seq, title, cast(level as bigint) as level, char_start, text", "drafts"),
        "run_statistics": f"{_WARNINGS} " + " union all ".join((step("lines", "text", "lines"), step("drafts", "text", "drafts"), step("content", "text", "full_"), step("plates", "text", "plates"), step("sections", "text", "finals"))),
        "reread_summary": f"""{_WARNINGS} select (select count(*) from quality where {read}) as documents, (select cast(sum(page_count) as bigint) from quality where {read}) as pages, (select count(*) from finals where {read}) as sections,
          (select cast(sum(case when is_figure then 1 else 0 end) as bigint) from finals where {read}) as figures, (select cast(sum(n_tables) as bigint) from finals where {read}) as tables, (select count(*) from warned where {read}) as warnings,
          (select round(avg(round({_RATIO}, 4)), 6) from quality where {read}) as avg_text_coverage""",
        "unreadable_outputs": """select distinct (p_partkey % 50) || '.parsed.json' as filename, case p_partkey % 50 % 10 when 4 then 'empty' when 5 then 'encoding' else 'unreadable' end as problem from part where p_partkey % 50 % 10 in (3, 4, 5, 6)""",
        "split_documents": oracle_pieces("select doc_id, text from documents", "doc_id", RuleConfig().max_chars_per_section),
        "split_sections": oracle_pieces(f"{_SECTIONS} select doc_id, section_seq, text from drafts", "doc_id, section_seq", SECTION_BUDGET),
        "quarantine_errors": f"""with d as (select distinct doc_id, c from (select p_partkey % 50 as doc_id, count(*) over (partition by p_partkey % 50) as c from part))
          select cast(doc_id as varchar) as doc_id, 'pages' as step, {faults} as error from d where doc_id % 10 in (3, 5, 6, 7) union all
          select cast(doc_id as varchar), 'pages', 'repeated page' from d where doc_id % 10 = 4 union all select cast(doc_id as varchar), 'pages', 'missing page' from d where doc_id % 10 = 8 union all
          select null, 'rules', 'skip.stamp does not compile' union all select null, 'rules', 'skip.seal does not compile'""",
        "quarantine_quality": f"{_IMPLICIT} select *, round({_RATIO}, 4) as text_coverage_ratio, case when {_RATIO} < 0.7 then printf('Text coverage below threshold (%.2f < 0.70)', {_RATIO}) else '' end as notes from quality where not ({bad})",
        "graph_violations": f"""with parts as (select p_partkey % 50 as doc_id, p_partkey from part where p_partkey % 50 not in (11, 12, 13) and (p_partkey % 50) % 17 <> 3),
          placed as (select *, row_number() over (partition by doc_id order by p_partkey) - 1 as i from parts), docs as (select distinct p_partkey % 50 as doc_id from part)
          {entity_rules} union all select doc_id, '$', 'not json' from docs where doc_id % 17 = 3 or (doc_id = 11 and doc_id % 13 <> 5) union all select doc_id, '$.relations', 'not an array' from docs where doc_id % 17 <> 3 and doc_id % 13 = 5
          union all select doc_id, '$.quality.json_valid', 'not a boolean' from docs where doc_id % 17 <> 3 and doc_id % 13 = 5 union all select 12, '$', 'not an object' union all select 13, '$.entities', 'missing'""",
        "document_violations": f"{_LINES} select doc_id, '$.discarded_blocks[' || (row_number() over (partition by doc_id order by line_no) - 1) || '].reason' as path, 'not allowed' as rule from ruled where reason is not null",
    }
