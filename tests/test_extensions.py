"""Splitting, quarantine, validation and the graph merger against direct versions."""

import json
import random
import re
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexmill.config import SKIP, RuleConfig
from lexmill.operators import graph, quarantine, validate
from lexmill.operators.components import components
from lexmill.operators.split import STOP, WORD, soft_split
from lexmill.plans.pipeline import SymbolicPlan
from lexmill.schemas import DOCUMENT, GRAPH, RELATION_TYPES
from lexmill.scratch import Scratch

FREE = RuleConfig(skip_start_pages=0, skip_end_pages=0)


def pack(text, budget):
    """Greedy packing, unit after unit."""
    units = []
    for s in re.findall(f".*?(?:{STOP})|.+", text, re.S):
        for w in [s] if len(s) <= budget else re.findall(WORD, s, re.S):
            units += [w[i : i + budget] for i in range(0, len(w), budget)]
    assert "".join(units) == text
    out = []
    for u in units:
        if out and len(out[-1]) + len(u) <= budget:
            out[-1] += u
        else:
            out.append(u)
    return out


def test_soft_split(spark):
    rng = random.Random(1)
    texts = ["", None, " ", "x" * 95, "One. Two. Three! Four? " * 20, "a b c d e f g h i j k l m n o p" * 3 + ". end", "tiny", "\n\n  lines\nof 3.5 mm.\nwords\n" * 4, "😀. é! " * 30, "no stop at all but quite a few words in it " * 4]
    texts += ["".join(rng.choice(("word", "a", " ", ". ", "! ", "\n", "3.5", "averyverylongwordindeed" * 2, "é")) for _ in range(rng.randrange(200))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)] + [(0, "same key. " * 9, 1, 2), (None, "no key. " * 9, 1, 2)], "k long, text string, unit int, row int")
    for budget in (1, 7, 40):
        got = defaultdict(list)
        for r in soft_split(df, ["k"], budget).orderBy("k", "piece_no").collect():
            got[r.k].append((r.piece_start, r.piece_end, r.text))
        for i, t in enumerate(texts):
            at, want = 0, []
            for p in pack(t, budget) if t else []:
                want.append((at, at + len(p), p))
                at += len(p)
            if i:
                assert got[i] == want, (budget, t)
        assert "".join(t for *_, t in got[0]) == "same key. " * 9 and "".join(t for *_, t in got[None]) == "no key. " * 9


def test_split_of_rows_whose_partitions_differ_between_reads(spark):
    """Rows that are shuffled anew for each read come in other partitions there; no piece may be lost or mixed up."""
    rng = F.udf(lambda i: random.random(), "double").asNondeterministic()
    rows = spark.range(400).select("id", F.concat_ws(" ", *[F.concat(F.col("id").cast("string"), F.lit(f" word {k}.")) for k in range(9)]).alias("text"))
    got = soft_split(rows.repartition(7, rng("id")), ["id"], 60)
    want = {r.id: pack(r.text, 60) for r in rows.collect()}
    pieces = defaultdict(list)
    for r in got.orderBy("id", "piece_no").collect():
        pieces[r.id].append(r.text)
    assert pieces == want


def test_split_of_many_pieces_is_not_all_pairs(spark):
    df = spark.createDataFrame([(1, "ten chars " * 30_000)], "k long, text string")
    got = soft_split(df, ["k"], 100)
    assert got.count() == 3000
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_quarantine(spark):
    good = [(f"g{i}", p, f"{p} ALPHA\n{p}.1 Beta\nword ..... {i}\nA ... 1\nB ... 2\n") for i in range(6) for p in (1, 2)]
    raw = [(d, str(p), t.encode()) for d, p, t in good]
    raw += [("b", "x", b"q"), ("b", "2", b"fine"), ("c", " 2 ", b"ok"), ("c", "2", b"ok"), ("d", "3000000000", b""), ("e", "1", b"\xff\xfe"), (None, "1", b"z"), ("f", "1.5", b"z"), ("i", None, b"z"), ("m", "1", b"a"), ("m", "3", b"c"), ("h", "1", None)]
    cfg = replace(FREE, skip={**SKIP, "bad": "(", "worse": "[a"}, warnings=replace(FREE.warnings, patterns=("*", *FREE.warnings.patterns)))
    plan = SymbolicPlan.guarded(spark.createDataFrame(raw, "doc_id string, page_no string, text binary"), cfg)
    want = [(None, "pages", "no document"), (None, "rules", "skip.bad does not compile"), (None, "rules", "skip.worse does not compile"), (None, "rules", "warnings.0 does not compile"), ("b", "pages", "page number"), ("c", "pages", "repeated page")]
    want += [("d", "pages", "page number"), ("e", "pages", "encoding"), ("f", "pages", "page number"), ("i", "pages", "page number"), ("m", "pages", "missing page")]
    assert sorted(map(tuple, plan.errors.collect()), key=str) == sorted(want, key=str)
    alone = SymbolicPlan(spark.createDataFrame(good, "doc_id string, page_no long, text string"), FREE)
    shape = lambda p: sorted((r.doc_id, json.dumps([s.asDict(True) for s in r.sections]), r.quality.notes) for r in p.accepted.collect())
    got = shape(plan)
    assert [r for r in got if r[0] != "h"] == shape(alone) and len(got) == 7
    assert alone.errors.count() == 0


def test_a_broken_step_sets_its_document_aside(spark):
    df = spark.createDataFrame([("a", 5, 3), ("a", 9, 3), ("b", 1, 2)], "doc_id string, start int, end int")
    got = quarantine.broken_promises("lines", df, {"backwards": "end < start", "far": "start > 8"})
    assert sorted(map(tuple, got.collect())) == [("a", "lines", "backwards"), ("a", "lines", "far")]


def test_reader_errors_and_empty_input(spark):
    df = spark.createDataFrame([("a", 1, "x", None), ("b", None, None, "cannot be opened")], "doc_id string, page_no long, text string, error string")
    parted = quarantine.part_pages(df)
    assert [tuple(r) for r in parted.errors.collect()] == [("b", "read", "cannot be opened")] and [r.doc_id for r in parted.pages.collect()] == ["a"]
    assert quarantine.part_pages(df.limit(0)).pages.count() == 0
    cfg = replace(FREE, skip={}, section_patterns={}, implicit=replace(FREE.implicit, heading_patterns=()), warnings=replace(FREE.warnings, patterns=()), component_list_pattern="")
    assert quarantine.sound_rules(spark, cfg)[1].count() == 0


def test_violations(spark):
    rows = [
        (1, '{"entities":[{"id":"a","type":"Component","confidence":0.5},{"id":3,"type":"Foo","confidence":"x","spans":[{"page":1.5},{"page":2},"s"]}],"relations":{},"quality":{"json_valid":1}}'),
        (2, "{oops"), (3, None), (4, "[]"), (5, '{"entities":null,"relations":[{"type":"affects","confidence":1}]}'), (6, '{"document_code": 5, "more": 1, "entities":[null, 7]}'), (7, ""), (7, '{"entities":[]}'),
    ]
    df = spark.createDataFrame([(*r, "v", "p") for r in rows], "doc_id long, json string, v string, path string")
    got = validate.violations(df, GRAPH, required=("$.entities", "$.entities[].id"))
    assert sorted(map(tuple, got.collect())) == [
        (1, "$.entities[1].confidence", "not a number"), (1, "$.entities[1].id", "not a string"), (1, "$.entities[1].spans[0].page", "not an integer"), (1, "$.entities[1].spans[2]", "not an object"), (1, "$.entities[1].type", "not allowed"),
        (1, "$.quality.json_valid", "not a boolean"), (1, "$.relations", "not an array"), (2, "$", "not json"), (3, "$", "not json"), (4, "$", "not an object"), (5, "$.entities", "missing"), (6, "$.document_code", "not a string"),
        (6, "$.entities[1]", "not an object"), (7, "$", "not json"),
    ]
    counts = validate.valid(df, DOCUMENT).groupBy("n_violations").count().collect()
    assert {r.n_violations: r["count"] for r in counts} == {0: 3, 1: 5}
    with pytest.raises(ValueError, match="unknown type"):
        validate.compiled(F.col("v"), {"a": "text"}, F.lit("$"))


def union_find(pairs):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return top


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300) if i != 150] + [(1000, i) for i in range(1001, 1050)] + [(5, 5), (None, 3), (2000, 1999)]
    top = union_find([e for e in edges if None not in e])
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert got == {n: top(n) for e in edges for n in e if None not in e and e[0] != e[1]}


E_SCHEMA = "pipeline string, doc_id long, id string, type string, name string, aliases array<string>, confidence double, entity_id string, n long"
V_SCHEMA, R_SCHEMA = "pipeline string, doc_id long, id string, attribute string, value string, confidence double", "pipeline string, doc_id long, type string, from_ref string, to_ref string, confidence double"


def key(name):
    return " ".join(sorted(w for w in re.split(r"[^\w]+|_+", (name or "").lower()) if w))


def test_merged_graph(spark):
    rng = random.Random(4)
    names = [f"{rng.choice(('Pump', 'heating', 'VALVE'))}{rng.choice((' ', '-', '_', '  '))}{rng.choice(('element', 'Seal', 'é'))} {rng.randrange(40)}" for _ in range(60)]
    ents = [(rng.choice("pq"), rng.randrange(4), f"e{rng.randrange(90)}", rng.choice(("Component", "Tool")), rng.choice(names), rng.choice((None, [], [rng.choice(names)], [" - ", rng.choice(names).upper()])), rng.choice((None, 0.1, 0.7)), "x", 1) for _ in range(220)]
    ents += [("p", 1, None, "Tool", "lost", [], 1.0, "x", 1), ("p", 1, "bare", None, None, None, None, "x", 1), ("q", 9, "hub", "Tool", "hub", names[:30], 0.2, "x", 1), ents[0]]
    vals = [(e[0], e[1], e[2], rng.choice(("size", "unit")), rng.choice(("1", "2", None)), rng.choice((0.5, 0.9, None))) for e in ents for _ in range(2)] + [("p", 0, "nobody", "size", "1", 1.0)]
    rels = [(e[0], e[1], rng.choice((*RELATION_TYPES[:2], "odd", None)), e[2], rng.choice(ents)[2], 0.5) for e in ents] + [("p", 0, "hasPart", None, "e1", 1.0)]
    g = graph.merge_graphs(spark.createDataFrame(ents, E_SCHEMA), spark.createDataFrame(vals, V_SCHEMA), spark.createDataFrame(rels, R_SCHEMA), RELATION_TYPES)

    nodes = {(f"{e[0]}/{e[1]}/{e[2]}", e[3] or "") for e in ents if e[2]}
    pairs = [((k, e[3] or "", 1), (f"{e[0]}/{e[1]}/{e[2]}", e[3] or "", 0)) for e in ents if e[2] for k in {key(n) for n in (e[4], *(e[5] or ()))} - {""}]
    top = union_find(pairs)
    least = defaultdict(lambda: "~")
    for n, t in nodes:
        c = top((n, t, 0))
        least[c] = min(least[c], n)
    cluster = {(n, t): least[top((n, t, 0))] for n, t in nodes}
    got = {(f"{r.pipeline}/{r.doc_id}/{r.id}", r.type): r.entity_id for r in g.members.collect()}
    assert got == cluster and 1 < len(set(cluster.values())) < len(nodes)

    by = defaultdict(list)
    for e in ents:
        if e[2]:
            by[cluster[f"{e[0]}/{e[1]}/{e[2]}", e[3] or ""], e[3] or ""].append(e)
    want = {k: (min(es, key=lambda e: (e[4] is None, -(e[6] or 0), e[4] or ""))[4], max(e[6] or 0 for e in es), len({e[:3] for e in es}), len({e[0] for e in es})) for k, es in by.items()}
    assert {(r.entity_id, r.type): (r.name, r.confidence, r.n_members, r.n_pipelines) for r in g.entities.collect()} == want
    assert sum(r.n_values > 1 for r in g.values.collect()) == sum(r.conflict for r in g.values.collect()) > 0

    first = {}
    for (n, _), c in cluster.items():
        first[n] = min(first.get(n, "~"), c)
    kinds, joined = Counter(), set()
    for p, d, t, a, b, _ in set(rels):
        x, y = first.get(f"{p}/{d}/{a}"), first.get(f"{p}/{d}/{b}")
        problem = "no from" if not x else "no to" if not y else "type" if t not in RELATION_TYPES else "loop" if x == y else None
        kinds[problem] += problem is not None
        if not problem:
            joined.add((t, x, y))
    assert Counter(r.problem for r in g.dangling.collect()) == +kinds
    assert {(r.type, r.from_id, r.to_id) for r in g.relations.collect()} == joined and joined


def test_empty_graph(spark):
    g = graph.merge_graphs(spark.createDataFrame([], E_SCHEMA), spark.createDataFrame([], V_SCHEMA), spark.createDataFrame([], R_SCHEMA))
    assert not any(df.count() for df in (g.members, g.entities, g.aliases, g.values, g.relations, g.sources, g.dangling))


@pytest.mark.parametrize("name", ["odd_tables", "odd_table_runs", "odd_section_ids", "split_sections", "graph_members", "graph_dangling", "graph_violations", "unreadable_outputs", "vertical_lines", "run_statistics"])
def test_oracle(spark, name):
    import duckdb

    import __spark_entry__

    d, c = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("part", "supplier", "documents"):
        c.sql(f"create view {t} as select * from read_parquet('{d}/{t}.parquet')")
    rel = c.sql(__spark_entry__.oracle_sql()[name])
    df = __spark_entry__.queries()[name](spark, d).select(*rel.columns)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(rel.fetchall(), key=repr)


def test_scratch_tables_can_be_read_and_dropped(spark):
    scratch = Scratch(spark, "kept")
    df, told = scratch.save_and_tell(spark.range(5), "a", F.sum("id").alias("sum"))
    assert told == {"n": 5, "sum": 10} and df.count() == 5 and scratch.marked
    scratch.drop("a")
    assert not scratch._found(f"{scratch.root}/a")[0].exists(scratch._found(f"{scratch.root}/a")[1])
