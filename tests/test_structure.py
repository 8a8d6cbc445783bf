"""Golden documents and invariants of the document structurer."""

import csv
import io
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill import cli, sinks
from lexmill.config import RuleConfig, from_mapping
from lexmill.functions import text as X
from lexmill.plans import queries as Q
from lexmill.plans.pipeline import SymbolicPlan

FREE = RuleConfig(skip_start_pages=0, skip_end_pages=0)
DOTS = "A ... 1\nB ... 2\nC ... 3"
GOLD = {
    "G1": "intro line\n1 GENERAL DATA\n1.1 Dimensions\nWidth ..... 120 mm\nHeight .... 277 mm\nDepth ..... 372 mm",
    "G2": "1 ALPHA\n1.1.1 Foo\n1.1.2 Bar\n1.1.3 Baz\n1.2 Qux",
    "G3": "1 AB\n1. Tank\n2) Lid\na | b | c\nd | e | f",
    "G4": "1 AB\nName | Type | Size\nPump | AC | 40",
    "G5": "1 ALPHA\n1 BETA\n1.2 Foo\n1.1 2 cups",
    "G6": f"1 ALPHA\n1.1 A\n{DOTS}\n1.2 B\n{DOTS}",
    "G7": "1.3 Rating plates\nKRUPS, EU-version\n230 V 50 Hz\nMagimix\n120 V",
    "G8": "1 AB\nCleaning Steps\nrinse the tank with clean water every single day.\nStorage\nkeep dry.",
    "G9": "1 AB\nDo not mix oil with water. Keep dry.\n2 CD\nAaa. Never mix b. Ccc ddd eee.",
    "G10": "12\nFoo |\n---|---\n   \n|\ncitiz service manual 12\nsee citiz service manual 12\n",
    "G13": "1 AB\nStep One\nthis block is long enough to be kept as a child.\nStep One\nthis block is long enough to be kept as a child too.",
}


@pytest.fixture(scope="module")
def plan(spark):
    return SymbolicPlan(spark.createDataFrame([(k, 1, v) for k, v in GOLD.items()], "doc_id string, page_no long, text string"), FREE)


@pytest.fixture(scope="module")
def got(plan):
    out = {}
    for r in plan.sections.orderBy("doc_id", "section_seq", "rating_seq", "implicit_seq").collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_end_to_end(got, plan):
    a, b, c = got["G1"]
    assert [(s.section_id, s.parent_id, s.char_start, s.char_end) for s in (a, b, c)] == [("sec_0", None, 0, 10), ("sec_1", None, 11, 25), ("sec_1_1", "sec_1", 26, 97)]
    assert (a.title, a.text, c.role, c.tags) == ("Preface", "intro line", "table", ["dimensions", "measurements", "table_present"])
    t = c.tables[0]
    assert (t.table_id, t.format, t.n_rows, t.n_cols, t.csv) == ("tbl_1_1_1", "dotted_leader", 4, 2, "Item,Value\r\nWidth,120 mm\r\nHeight,277 mm\r\nDepth,372 mm")
    q = plan.quality.filter("doc_id = 'G1'").first()
    assert (q.total_chars, q.text_chars, q.text_coverage_ratio, q.notes, q.tables_extracted) == (97, 66, 0.6804, "Text coverage below threshold (0.68 < 0.70)", 1)


def test_parent_by_depth(got):
    assert [s.parent_id for s in got["G2"]] == [None, "sec_1", "sec_1_1_1", "sec_1_1_1", "sec_1"]
    assert [(s.char_start, s.char_end) for s in got["G2"]] == [(0, 7), (8, 37), (18, 27), (28, 37), (38, 45)]


def test_legend_beats_table(got):
    (s,) = got["G3"]
    assert s.role == "figure" and not s.tables and s.tags == ["figure_present"]
    assert [(x.number, x.description) for x in s.figures[0].legend_items] == [(1, "Tank"), (2, "Lid")]


def test_pipe_table(got):
    t = got["G4"][0].tables[0]
    assert (t.csv, t.n_rows, t.n_cols) == ("Name,Type,Size\r\nPump,AC,40", 2, 3)


def test_ids_may_repeat(got):
    assert [s.section_id for s in got["G5"]] == ["sec_1", "sec_1_2", "sec_1_2", "sec_1_12"]


def test_merge(got):
    s = got["G6"]
    assert [x.section_id for x in s] == ["sec_1", "sec_1_1"]
    assert s[1].tables[0].n_rows == 7 and "\r" not in s[1].tables[0].csv and len(s[1].text.split("\n")) == 6
    assert s[1].char_end == len(GOLD["G6"])


def test_rating_plate(got):
    p, a, b = got["G7"]
    assert p.text == "" and {"rating_plate", "brand_specific"} <= set(p.tags)
    assert (a.section_id, a.title, a.char_start, a.char_end, a.role, a.level) == ("sec_1_3_krups_eu", "1.3 Rating plates - KRUPS, EU-version", 0, 29, "figure", 3)
    assert (b.section_id, b.char_start, b.char_end) == ("sec_1_3_magimix", 30, 43) and {"eu", "krups"} <= set(a.tags)


def test_implicit(got):
    p, a = got["G8"]
    assert p.text == "" and (a.section_id, len(a.text)) == ("sec_1_cleaning_steps", 64)
    assert [s.section_id for s in got["G13"]] == ["sec_1", "sec_1_step_one", "sec_1_step_one_2"]


def test_warnings(got):
    a, b = got["G9"]
    assert [tuple(w) for w in a.warnings] == [("note", "Do not mix oil with water.", "Do not")] and a.role == "warning" and a.tags == ["warning"]
    assert [tuple(w) for w in b.warnings] == [("note", "Never mix b. Ccc", "Never")]


def test_discards(plan):
    rows = plan.lines.filter("doc_id = 'G10'").orderBy("line_no").collect()
    assert [r.reason for r in rows] == ["page_number", "header", "decoration", "decoration", "decoration", "footer", None, None]


def test_page_pruning(spark):
    df = spark.createDataFrame([("a", i, f"p{i}") for i in (1, 2, 3)] + [("b", 1, "x"), ("b", 2, "y")], "doc_id string, page_no long, text string")
    p = SymbolicPlan(df)
    assert [(r.doc_id, r.text, r.start) for r in p.lines.collect()] == [("a", "p2", 0)]
    q = p.quality.filter("doc_id = 'b'").first()
    assert q.text_coverage_ratio == 0 and q.notes.endswith("(0.00 < 0.70)")


def test_nested_and_summary(plan, tmp_path):
    s = plan.summary.first()
    assert s.documents == len(GOLD) and s.pages == len(GOLD) and s.warnings == 2
    paths = sinks.export_json(plan.documents, str(tmp_path), FREE)
    tree = json.load(open(f"{tmp_path}/G9.parsed.json", encoding="utf-8"))
    assert len(paths) == len(GOLD) and tree["sections"][0]["warnings"][0]["keyword"] == "Do not" and tree["metadata"]["year"] is None
    assert sinks.read_json(plan.pages.sparkSession, str(tmp_path), plan.documents).count() == len(GOLD)


def test_stack_against_a_fold(spark):
    rng = random.Random(3)
    head = {1: "1 AA", 2: "1.1 b", 3: "1.1.1 c"}
    docs = [[rng.randint(1, 3) for _ in range(rng.randint(1, 25))] for _ in range(40)]
    df = spark.createDataFrame([(i, 1, "\n".join(head[x] for x in d)) for i, d in enumerate(docs)], "doc_id long, page_no long, text string")
    got = {(r.doc_id, r.section_seq): r.parent_seq for r in SymbolicPlan(df, FREE).drafts.collect()}
    for i, levels in enumerate(docs):
        stack = []
        for n, level in enumerate(levels, 1):
            while len(stack) >= level:
                stack.pop()
            assert got[i, n] == (stack[-1] if stack else None)
            stack.append(n)


def test_csv_rows(spark):
    rows = [["a", 'b"c', "d,e"], [""], ["", ""], [" x ", "y"]]
    got = [r[0] for r in spark.createDataFrame([(r,) for r in rows], "r array<string>").select(X.csv_row(F.col("r"))).collect()]
    for row, line in zip(rows, got, strict=True):
        buf = io.StringIO()
        csv.writer(buf).writerow(row)
        assert buf.getvalue().rstrip("\r\n") == line


def test_empty_corpus(spark):
    p = SymbolicPlan(spark.createDataFrame([], "doc_id long, page_no long, text string"))
    assert p.sections.count() == 0 and p.summary.count() == 0


def test_config_and_cli(tmp_path):
    with pytest.raises(ValueError):
        from_mapping({"pipelines": {"product_technical": {"enabled": False}}})
    cfg = from_mapping({"pipelines": {"product_technical": {"enabled": True, "symbolic": {"tagging_keywords": {"brand": ["acme"]}}}}})
    assert cfg.rating_plate.brands == ("acme",) and cfg.skip_start_pages == 0 and cfg.min_text_coverage == 0
    assert cli.main(["--config", str(tmp_path / "none.yaml")]) == 1


@pytest.mark.parametrize("name", ["section_spans", "merged_tables", "implicit_sections", "document_codes"])
def test_oracle(spark, name):
    import duckdb

    d, c = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("part", "supplier"):
        c.sql(f"create view {t} as select * from read_parquet('{d}/{t}.parquet')")
    rel = c.sql(Q.oracle_sql()[name])
    df = Q.queries()[name](spark, d).select(*rel.columns)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(rel.fetchall(), key=repr)


def _mentions(spark, text, *patterns):
    from dataclasses import replace

    cfg = replace(FREE, warnings=replace(FREE.warnings, patterns=patterns))
    plan = SymbolicPlan(spark.createDataFrame([("d", 1, text)], "doc_id string, page_no long, text string"), cfg)
    out = [(w.type, w.text, w.keyword) for s in plan.sections.collect() for w in s.warnings or []]
    plan.release()
    return out


def test_warning_patterns_of_any_kind(spark):
    text = "1 AB\nA hot surface here. A warm surface there (danger). Mind it."
    assert _mentions(spark, text, "(?:hot|warm) surface") == [("note", "A hot surface here.", "hot surface"), ("note", "A warm surface there (danger). Mind it.", "warm surface")]
    assert _mentions(spark, text, "\\(danger\\)") == [("warning", "A warm surface there (danger). Mind it.", "(danger)")]
    assert _mentions(spark, text, "(hot)? ?surface") == [("note", "A hot surface here.", "hot"), ("note", "A warm surface there (danger). Mind it.", " surface")]


def test_many_warnings_in_a_section(spark):
    text = "1 AB\n" + " ".join(f"Never mix part {i} with water. Keep dry." for i in range(1000))
    got = _mentions(spark, text, "(never mix)")
    assert len(got) == 1000 and all(f"Never mix part {i} with" in t and k == "Never mix" for i, (_, t, k) in enumerate(got))


def test_many_equal_ids(spark):
    block = "Step One\nthis block is long enough to be kept as a child.\n"
    taken = "Step One 2\nthis block is long enough to be kept as a child.\n"
    plan = SymbolicPlan(spark.createDataFrame([("d", 1, "1 AB\n" + block * 3 + taken + block * 40)], "doc_id string, page_no long, text string"), FREE)
    ids = [r.section_id for r in plan.implicit.collect()]
    assert len(ids) == len(set(ids)) == 45


def test_rules_as_users_write_them():
    sym = {"rating_plate": {"title_keywords": ["Rating Plate"], "brands": [" Krups "], "region_tokens": [" EU "]}, "allowed_entities": ["pump"], "allowed_relations": ["part_of"]}
    cfg = from_mapping({"pipelines": {"product_technical": {"enabled": True, "symbolic": sym}}})
    assert (cfg.rating_plate.brands, cfg.rating_plate.region_tokens, cfg.rating_plate.title_keywords) == (("Krups",), ("eu",), ("rating plate",))
    assert (cfg.allowed_entities, cfg.allowed_relations) == (("pump",), ("part_of",))


def test_text_files_and_listing(spark, tmp_path):
    from lexmill.sources import pages as P

    for name, text in (("b.txt", "1 AB\fsecond"), ("a.txt", "x"), ("c.md", "no")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    found = P.files(spark, str(tmp_path), "*.txt")
    assert [r.filename for r in P.listing(found).collect()] == ["a.txt", "b.txt"]
    assert sorted(tuple(r) for r in P.text_file_pages(found).collect()) == [("a", 1, "x"), ("b", 1, "1 AB"), ("b", 2, "second")]


def test_stream(spark, tmp_path):
    from lexmill.streaming.files import structure_stream

    schema = "doc_id string, page_no long, text string"
    spark.createDataFrame([("G1", 1, GOLD["G1"])], schema).write.parquet(str(tmp_path / "in" / "a"))
    q = structure_stream(spark, str(tmp_path / "in" / "*"), schema, str(tmp_path / "out"), str(tmp_path / "check"), FREE)
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_ten_thousand_equal_ids(spark):
    block = "Step One\nthis block is long enough to be kept as a child.\n"
    plan = SymbolicPlan(spark.createDataFrame([("d", 1, "1 AB\n" + block * 10_000)], "doc_id string, page_no long, text string"), FREE)
    rows = plan.implicit.orderBy("implicit_seq").collect()
    assert [r.section_id for r in rows] == ["sec_1", "sec_1_step_one", *(f"sec_1_step_one_{k}" for k in range(2, 10_001))]


def test_suffixes_against_one_after_the_other(spark):
    from lexmill.operators.rewrite import _unique_ids

    rng, rows = random.Random(8), []
    for d in range(30):
        names = rng.choice((["a"], ["a", "a_2"], ["a", "b", "a_2_3", "a_2"], ["a", "2", "b_2", "b", "_3"]))
        rows += [(d, k, 0, int(k > 2), rng.choice(names), "t") for k in range(1, rng.randrange(4, 25))]
    df = spark.createDataFrame(rows, "doc_id long, section_seq int, rating_seq int, implicit_seq int, section_id string, text string")
    got = {(r.doc_id, r.section_seq): r.section_id for r in _unique_ids(df).collect()}
    for d in range(30):
        used = {r[4] for r in rows if r[0] == d and not r[3]}
        for r in (r for r in rows if r[0] == d and r[3]):
            name, n = r[4], 2
            while name in used:
                name, n = f"{r[4]}_{n}", n + 1
            used.add(name)
            assert got[d, r[1]] == name


def test_verticals_equal_jobs_of_their_own(spark):
    from dataclasses import replace

    from lexmill.plans.pipeline import RecordedPlan, Verticals

    rules = {"x": FREE, "y": replace(FREE, name="y", skip={}, section_patterns={"level1": "^## .+$"}, brand=("krups",), skip_start_pages=1)}
    pages = [(k, p, t) for k, v in GOLD.items() for p, t in ((1, v), (2, "## Part\n" + v))]
    df = spark.createDataFrame([(*r, "xyz"[int(r[0][1:]) % 3]) for r in pages], "doc_id string, page_no long, text string, vertical string")
    both = Verticals(df, rules)
    key = lambda rows: sorted(str(r.asDict(True)) for r in rows)
    for v, cfg in rules.items():
        alone = SymbolicPlan(df.filter(F.col("vertical") == v).drop("vertical"), cfg)
        recorded = RecordedPlan(alone.pages, cfg)
        want = key(alone.sections.collect())
        assert key(both.plans[v].sections.collect()) == want == key(recorded.sections.collect()) and want
        assert key(both.plans[v].quality.collect()) == key(alone.quality.collect())
        stats = {r.step: (r.n_rows, r.n_chars) for r in recorded.statistics.collect()}
        assert stats["sections"] == (len(want), alone.sections.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]) and stats["lines"][0] == alone.lines.count()
        recorded.release()
    assert both.all("sections").select("vertical").distinct().count() == 2
    assert both.lines._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1
    both.release()


def test_no_frame_up_to_the_last_row(plan):
    """Spark works out a frame from the current row to the last one anew for each row: quadratic in a document's sections."""
    text = plan.sections._jdf.queryExecution().optimizedPlan().toString() + plan.drafts._jdf.queryExecution().analyzed().toString()
    assert "RowFrame, unboundedpreceding" in text.replace("$()", "")
    assert not re.search(r"(Row|Range)Frame, (?!unboundedpreceding)[^()]*, unboundedfollowing", text.replace("$()", ""))


def test_windows_that_number_ids_do_not_sort_texts(spark):
    """Numbers are found over keys alone: a window over whole rows would sort every text of a document."""
    from lexmill.operators.rewrite import _unique_ids

    rows = [(1, 1, 0, 0, "sec_1", "long text"), (1, 1, 0, 1, "sec_1_a", "x"), (1, 1, 0, 2, "sec_1_a", "y"), (1, 2, 0, 1, "sec_1_a", "z")]
    out = _unique_ids(spark.createDataFrame(rows, "doc_id long, section_seq int, rating_seq int, implicit_seq int, section_id string, text string"))
    assert sorted((r.section_seq, r.implicit_seq, r.section_id, r.text) for r in out.collect()) == [(1, 0, "sec_1", "long text"), (1, 1, "sec_1_a", "x"), (1, 2, "sec_1_a_2", "y"), (2, 1, "sec_1_a_3", "z")]
    todo, windows = [out._jdf.queryExecution().optimizedPlan()], 0
    while todo:
        node = todo.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        todo += children
        if node.nodeName() == "Window":
            windows += 1
            assert "text#" not in node.output().mkString(" ")
    assert windows


def test_tags_and_figures_are_compiled(spark):
    """Nothing of tags and figures stands below a lambda, where Spark compiles nothing and lower-cases a text once for each word."""
    from lexmill.functions import text as X
    from lexmill.operators import content

    df = spark.createDataFrame([(1, "sec_1", "View", "see the Schematic of 5 mm, 230 Voltage", 1), (2, "sec_2", "T", "plain", 1)], "section_seq int, section_id string, title string, text string, page_start int")
    figures = content.with_figures(df, RuleConfig())
    tagged = figures.withColumn("tables", F.array()).withColumn("tags", content.tags(RuleConfig()))
    assert [(r.section_seq, len(r.figures), r.tags) for r in tagged.orderBy("section_seq").collect()] == [(1, 1, ["dimensions", "electrical_specs", "figure_present", "measurements", "voltage"]), (2, 0, [])]
    plan = tagged.select("tags")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan.lower() and "arraysort" not in plan.lower() and "filter(array(" not in plan.lower()
    assert spark.range(1).select(X.sorted_set(F.array(F.lit("b"), F.lit("a"), F.lit("b"))).alias("s")).first().s == ["a", "b"]


def _text_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_steps_read_once_are_not_kept(spark):
    """a kept step makes and packs every column, texts too."""
    d = "/root/testdata/sf0.001"
    for q in (Q.section_tree, Q.section_spans, Q.section_ids, Q.section_text, Q.legend_items):
        assert "InMemoryRelation" not in _text_of(q(spark, d)), q.__name__
    for q in (Q.section_tree, Q.section_spans, Q.section_ids):
        assert "collect_list" not in _text_of(q(spark, d)), q.__name__
    assert _text_of(Q.rating_plate_sections(spark, d)).split("InMemoryRelation")[0].count("Join") <= 1


def test_odd_runs_and_graph_keep_no_step(spark):
    """lines and drafts are read once."""
    from lexmill.plans import extensions

    assert "InMemoryRelation" not in _text_of(extensions.odd_table_runs(spark, "/root/testdata/sf0.001"))


def test_tables_are_sought_where_a_separator_is(spark):
    """other sections' lines are not sorted, and the sections are joined to their tables once."""
    text = "1 AB\n- x\n* y\n1.1 C\n- a | b | c\nd | e | f\n1.2 D\nA ... 1\n- more\nB .... 2\nC ... 3"
    plan = SymbolicPlan(spark.createDataFrame([("d", 1, text)], "doc_id string, page_no long, text string"), FREE, keep=())
    assert [(r.section_seq, [(t.table_id, t.page, t.caption, t.n_rows) for t in r.tables]) for r in plan.content.orderBy("section_seq").collect()] == [
        (1, []), (2, [("tbl_1_1_1", 1, "1.1 C", 2)]), (3, [("tbl_1_2_1", 1, "1.2 D", 5)]),
    ]
    assert _text_of(plan.content).count("Join") == 1


def test_quality_numbers_no_ids(spark):
    """the quality reads neither numbered ids nor warnings, and counts the same."""
    plan = SymbolicPlan(spark.createDataFrame([(k, 1, v) for k, v in GOLD.items()], "doc_id string, page_no long, text string"), FREE, keep=())
    assert "fresh" not in _text_of(plan.quality)
    own = {r.doc_id: r for r in plan.quality.collect()}
    later = SymbolicPlan(plan.pages, FREE)
    later.sections  # noqa: B018  from here on the quality counts these
    assert own == {r.doc_id: r for r in later.quality.collect()}


def test_every_space_is_trimmed(spark):
    """trimmed sign by sign, as by the pattern before, and compiled."""
    points = spark.createDataFrame([(i, chr(i)) for i in [*range(1, 0xD800), *range(0xE000, 0x10000), 0x1F600]], "i int, c string")
    old = F.regexp_replace(F.concat("c", F.lit("a b"), "c", "c"), f"(?U)\\A{X.SPACE}+|{X.SPACE}+\\z", "")
    new = X.strip(F.concat("c", F.lit("a b"), "c", "c"))
    assert points.filter(old != new).count() == 0
    assert points.filter(new == "a b").count() == len(X.SPACES)
    assert "regexp_replace" not in points.select(new)._jdf.queryExecution().optimizedPlan().toString()


def test_kinds_are_asked_of_single_values(spark):
    """F8: the kind of an object or array is not told by its whole schema, which reads all below it once for each level."""
    from lexmill.operators.validate import violations

    schema = {"a": [{"b": "string", "n": "number", "k": "x|y"}], "o": {"i": "integer"}}
    docs = [
        (1, '{"a": [], "o": {}}'), (2, '{"a": {}, "o": []}'), (3, '{"a": "[]", "o": "{}"}'), (4, '{"a": [null, 1, {"b": null, "n": 1.5, "k": "x"}, {"b": 1, "n": "1", "k": "z"}, {"k": 1}], "o": {"i": 1.0}}'), (5, '{"a": null}'), (6, "[]"), (7, "null"), (8, "{"), (9, None),
    ]
    out = violations(spark.createDataFrame(docs, "doc_id int, json string"), schema, required=("$.a", "$.a[].b"))
    assert sorted((r.doc_id, r.path, r.rule) for r in out.collect()) == [
        (2, "$.a", "not an array"), (2, "$.o", "not an object"), (3, "$.a", "not an array"), (3, "$.o", "not an object"), (4, "$.a[1]", "not an object"), (4, "$.a[2].b", "missing"), (4, "$.a[3].b", "not a string"), (4, "$.a[3].k", "not allowed"),
        (4, "$.a[3].n", "not a number"), (4, "$.a[4].b", "missing"), (4, "$.a[4].k", "not allowed"), (4, "$.o.i", "not an integer"), (5, "$.a", "missing"), (6, "$", "not an object"), (8, "$", "not json"), (9, "$", "not json"),
    ]
    nest = violations(spark.createDataFrame(docs, "doc_id int, json string"), {"a": [{"b": "string"}]})
    assert nest._jdf.queryExecution().analyzed().toString().count("schema_of_variant") == 1
