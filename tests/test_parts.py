"""What is asked of nested documents without making a document one row."""

from lexmill.config import RuleConfig
from lexmill.plans import queries as Q
from lexmill.plans.pipeline import SymbolicPlan

FREE = RuleConfig(skip_start_pages=0, skip_end_pages=0)
SF = "/root/testdata/sf0.001"
TEXTS = {
    "a": "1 GENERAL DATA\n1.1 Size\nWidth ..... 120 mm\nHeight .... 277 mm\nDepth ..... 372 mm\n-----\n12",
    "b": '1 AB\nDo not mix "oil" with water. Keep dry.\n2 CD\nAaa. Never mix b\\c. Ccc ddd ééé.\n7',
    "c": "1 AB\nCleaning Steps\nrinse the tank with clean water every single day.\nStorage\nkeep it dry and dark at home.",
    "d": "-----",
    "e": "1.3 Rating plates\nKRUPS, EU-version\n230 V 50 Hz\nMagimix\n120 V",
}


def corpus(spark):
    return spark.createDataFrame([(k, 1, t) for k, t in TEXTS.items()], "doc_id string, page_no long, text string")


def _text_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_headers_without_nested_rows(spark):
    """the numbers of sections and blocks are counted, not read off arrays that grow with the document."""
    plan = SymbolicPlan(corpus(spark), FREE, keep=())
    want = {r.doc_id: (len(r.sections), len(r.discarded_blocks), r.document_code, r.title, r.source, r.quality) for r in SymbolicPlan(corpus(spark), FREE).documents.collect()}
    assert {r.doc_id: (r.n_sections, r.n_discarded, r.document_code, r.title, r.source, r.quality) for r in plan.headers.collect()} == want and want["d"][:2] == (0, 1)
    assert "discarded_blocks" not in _text_of(Q.document_headers(spark, SF)) and "sort_array(collect_list(struct(k" not in _text_of(Q.document_headers(spark, SF))


def test_counters_without_nested_rows(spark):
    """the corpus counters are sums over flat sections, and equal those over nested documents."""
    from lexmill.operators.document import summary

    assert SymbolicPlan(corpus(spark), FREE, keep=()).summary.collect() == summary(SymbolicPlan(corpus(spark), FREE).documents).collect()
    assert "discarded_blocks" not in _text_of(Q.corpus_summary(spark, SF))


def test_violations_by_element(spark, monkeypatch):
    """sections and blocks are checked one by one, with the paths that they have in the whole document."""
    from pyspark.sql import functions as F

    from lexmill.operators.validate import violations
    from lexmill.plans import extensions, pipeline
    from lexmill.schemas import DOCUMENT

    wrong = {**DOCUMENT, "source": {**DOCUMENT["source"], "page_count": "string"}, "sections": [{**DOCUMENT["sections"][0], "level": "string", "role": "main|toc", "tables": [{"n_rows": "string"}]}]}
    monkeypatch.setattr(pipeline, "DOCUMENT", wrong)
    docs = SymbolicPlan(corpus(spark), FREE).documents
    want = violations(docs.select("doc_id", F.to_json(F.struct(*[c for c in docs.columns if c != "doc_id"])).alias("json")), wrong)
    plan = SymbolicPlan(corpus(spark), FREE)
    assert sorted(plan.violations.collect()) == sorted(want.collect()) and plan.violations.count() > 15
    assert "collect_list" not in _text_of(extensions.document_violations(spark, SF))


def test_parts_make_the_documents(spark):
    """a document's text is written part by part, and is the whole document's JSON."""
    import json

    from pyspark.sql import functions as F

    plan = SymbolicPlan(corpus(spark), FREE)
    docs = plan.documents
    whole = {r.doc_id: json.loads(r.j) for r in docs.select("doc_id", F.to_json(F.struct(*[c for c in docs.columns if c != "doc_id"]), {"ignoreNullFields": "false"}).alias("j")).collect()}
    got = {}
    for r in sorted(plan.json_parts.collect(), key=lambda r: (r.doc_id, r.part, r.at)):
        text, joint = got.get(r.doc_id, ("", False))
        got[r.doc_id] = (text + "," * (joint and r.joint) + r.json, r.joint)
    assert set(got) == set(whole) == set(TEXTS)
    for k, (text, _) in got.items():
        tree = json.loads(text)
        assert list(tree) == list(whole[k]) and len(text.split(',"sections"')[0]) > 200
        assert {**tree, "ingestion_id": 0, "created_utc": 0} == {**whole[k], "ingestion_id": 0, "created_utc": 0}


ODD = [
    b"{}", b" {} ", b"{} x", b"{}{", b"[]", b"5", b"null", b" ", b'"a"', b"{", b'{"title"', b'{"title": "x"', b'{"title": "x",}', b'{"title" "x"}', b'{"title": 5}', b'{"title": {"a": 1}}', b'{"title": "\\u00e9\\""}', b"{'title': 'x'}", b"{title: 1}",
    b'{"sections": []}', b'{"sections": [,]}', b'{"sections": [{}, {}]}', b'{"sections": [{} {}]}', b'{"sections": [{},]}', b'{"sections": [null]}', b'{"sections": null}', b'{"sections": [3]}', b'{"sections": [[]]}', b'{"sections": {"text": "a"}}', b'{"sections": [{"text": "a]}"}]}',
    b'{"sections": [{"text": "a", "n": [1, 2]}], "title": "t"}', b'{"sections": [{"n": "x"}]}', b'{"sections": [{"n": ["x"]}]}', b'{"sections": [{"text": "a}]}', b'{"sections": [{"n": [1, 2}]}', b'{"sections": [{"sub": [{"a": [1]}, {"a": []}]}]}', b'{"sections": [{"sub": [{"a": 1}]}]}',
    b'{"sections": [{"text": "\xff"}]}', b'{"title": "\xc3', b'{oops \xc3', b'{"other": [1, {"a": [}], "title": "x"}', b'{"other": [1, {"a": []}], "title": "x"}', b'{"title": "a", "title": 1.5}', b'{"sections": [{"text": "a\nb"}]}', b'{"sections": [{"text": tru}]}', b'\xef\xbb\xbf{"title": "x"}',
]


def test_files_are_judged_in_pieces(spark, tmp_path, monkeypatch):
    """files read a few bytes at a time give the warnings that whole ones give."""
    from pyspark.sql import functions as F

    from lexmill.sources import document_files as D

    for i, content in enumerate(ODD):
        (tmp_path / f"{i}.parsed.json").write_bytes(content)
    schema = "title string, sections array<struct<text: string, n: array<bigint>, sub: array<struct<a: array<bigint>>>>>"
    like = spark.createDataFrame([], schema).schema
    rows = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(ODD)], "i int, c binary").withColumn("t", F.col("c").cast("string"))
    doc = F.from_json("t", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    rows = rows.withColumn("p", F.when(~F.is_valid_utf8("t"), "encoding").when(doc.isNull() | doc["_corrupt"].isNotNull(), "unreadable")).filter("p is not null")
    want = {(f"{r.i}.parsed.json", r.p) for r in rows.collect()}
    for chunk, piece in ((1, 1), (7, 20), (1 << 20, 64 << 10)):
        monkeypatch.setattr(D, "CHUNK", chunk)
        monkeypatch.setattr(D, "PIECE", piece)
        got = set()
        for i, content in enumerate(ODD):
            at, pieces, broken = [0], [], False

            def read(n, at=at, content=content):
                at[0] += n
                return content[at[0] - n : at[0]]

            text = D._Text(read)
            try:
                pieces = [p.decode("utf-8", "replace") for p in D.json_pieces(text, frozenset({"sections"}))]
            except D.Unreadable:
                broken = True
            got |= {(i, p) for p in pieces} | ({(i, None)} if broken else set())
        judged = spark.createDataFrame(sorted(got, key=repr), "i int, t string").filter(F.col("t").isNull() | doc.isNull() | doc["_corrupt"].isNotNull())
        assert {f"{r.i}.parsed.json" for r in judged.select("i").distinct().collect()} | {n for n, p in want if p == "encoding"} == {n for n, _ in want}
    assert {(r.filename, r.problem) for r in D.read_documents(spark, str(tmp_path), like).warnings.collect()} == want


def test_pieces_are_bounded():
    """no piece and no buffer grows with the file."""
    import io
    import json

    from lexmill.sources import document_files as D

    body = json.dumps({"title": "x", "sections": [{"text": f"a{i}", "tables": [{"n": [i]}]} for i in range(90_000)], "quality": {"n": 1}}).encode()
    text = D._Text(io.BytesIO(body).read)
    sizes, n = [], 0
    for p in D.json_pieces(text, frozenset({"sections"})):
        sizes.append((len(p), len(text.buf)))
        n += len(json.loads(p)["sections"])
    assert len(body) > 3 * D.CHUNK and n == 90_000 and max(a for a, _ in sizes) < 2 * D.PIECE and max(b for _, b in sizes) <= D.CHUNK + 4096
