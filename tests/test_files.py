"""Page files in, document files out: identity by path, two-phase writing, unreadable outputs, the stream, and the command line."""

import json
import os
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexmill import cli
from lexmill.sources import page_files as PF
from lexmill.sources import pages as P
from lexmill.sources.document_files import ParsedDocuments, file_names, read_documents, save_documents


@pytest.fixture
def folder(tmp_path):
    for name, content in (("a/x.txt", b"1 AAA\fsecond\fthird"), ("b/x.txt", b"1 BBB"), ("a/y.txt", b"z" * 100), ("a/bad.txt", b"\xff\xfe"), ("a/empty.txt", b""), ("a/n.md", b"no")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    return tmp_path


def test_pages_by_partitions(spark, folder):
    df = PF.page_files(spark, f"{folder}/a", bytes=50)
    assert df.rdd.getNumPartitions() == 2
    got = df.filter("error is null")
    old = P.text_file_pages(P.files(spark, f"{folder}/a", "[xy]*.txt"))
    assert sorted(tuple(r) for r in got.filter("stem <> 'empty'").select("stem", "page_no", "text").collect()) == sorted(map(tuple, old.collect()))
    assert [(r.page_no, r.text) for r in got.filter("stem = 'empty'").collect()] == [(1, "")]
    bad = df.filter("error is not null").collect()
    assert [(r.stem, r.page_no, "UnicodeDecodeError" in r.error) for r in bad] == [("bad", None, True)]


def test_equal_stems_stay_apart(spark, folder):
    df = PF.page_files(spark, [f"{folder}/a/x.txt", f"{folder}/b/x.txt"])
    assert {(r.doc_id, r.stem): r.n for r in df.groupBy("doc_id", "stem").agg(F.count("*").alias("n")).collect()} == {(f"{folder}/a/x.txt", "x"): 3, (f"{folder}/b/x.txt", "x"): 1}
    with pytest.raises(PySparkException, match="FileNotFoundError"):
        PF.page_files(spark, [f"{folder}/a/x.txt", f"{folder}/none.txt"]).collect()


def test_packing():
    found = [PF.Found(0, f"f{i}", s) for i, s in enumerate((5, 5, 30, 1, 1, 9))]
    assert [p.paths for p in PF.packed(found, 10)] == [("f0", "f1"), ("f2",), ("f3", "f4"), ("f5",)] and PF.packed([], 10) == []


def test_stream_reads_each_file_once(spark, folder, tmp_path):
    spark.dataSource.register(PF.PageFiles)

    def run():
        df = spark.readStream.format("page_files").options(path=f"{folder}/a", glob="[xyw]*.txt", grace=0.2, files=1).load()
        q = df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="200 milliseconds").start(str(tmp_path / "out"))
        end = time.time() + 90
        while time.time() < end and q.isActive and not (q.lastProgress and q.lastProgress["numInputRows"] == 0 and q.lastProgress["batchId"] >= 1):
            time.sleep(0.3)
        q.stop()
        return sorted((r.stem, r.page_no) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    time.sleep(0.5)
    first = run()
    assert first == [("x", 1), ("x", 2), ("x", 3), ("y", 1)]
    (folder / "a" / "w.txt").write_text("late")
    time.sleep(0.5)
    assert run() == [("w", 1), *first]


DOC = "doc_id string, title string, sections array<struct<warnings:string>>"


def test_writer_names_and_json(spark, tmp_path):
    out = str(tmp_path / "out")
    docs = spark.createDataFrame([("p/1", "x", [(None,)]), ("p/2", "x", []), ("p/3", "q/r é", None), ("p/4", None, None)], DOC)
    save_documents(docs, out)
    names = sorted(os.listdir(out))
    assert len(names) == 4 and names[:2] == ["document.parsed.json", "q_r é.parsed.json"] and names[2].startswith("x-") and names[3].startswith("x-")
    text = open(f"{out}/q_r é.parsed.json", encoding="utf-8").read()
    assert text == '{\n  "title": "q/r é",\n  "sections": null\n}'
    assert [t for t in (json.load(open(f"{out}/{n}")) for n in names[2:]) if t["sections"]] == [{"title": "x", "sections": [{}]}]
    save_documents(docs.limit(1), out)  # overwrites
    assert os.listdir(out) == ["x.parsed.json"]


def test_a_failing_task_leaves_no_file(spark, tmp_path):
    out = tmp_path / "out"
    spark.dataSource.register(ParsedDocuments)
    rows = spark.createDataFrame([(f"{i}.parsed.json", "{}" if i != 7 else "{broken") for i in range(12)], "file string, doc string").repartition(4)
    with pytest.raises(PySparkException):
        rows.write.format("parsed_documents").mode("append").save(str(out))
    assert not out.exists() or os.listdir(out) == []
    rows.filter("doc = '{}'").write.format("parsed_documents").mode("append").save(str(out))
    assert len(os.listdir(out)) == 11


def test_unreadable_outputs(spark, tmp_path):
    docs = spark.createDataFrame([(str(i), f"t{i}", [("w",)]) for i in range(20)], DOC)
    save_documents(docs, str(tmp_path))
    for name, content in (("e", b""), ("f", b"{oops"), ("g", b"\xff{}"), ("h", b'{"title": "h", "sections": 5}')):
        (tmp_path / f"{name}.parsed.json").write_bytes(content)
    got = read_documents(spark, str(tmp_path), docs.drop("doc_id").schema)
    assert sorted(r.title for r in got.documents.collect()) == sorted(f"t{i}" for i in range(20))
    assert {(r.filename[0], r.problem) for r in got.warnings.collect()} == {("e", "empty"), ("f", "unreadable"), ("g", "encoding"), ("h", "unreadable")}
    assert file_names(docs.limit(0), F.col("doc_id"), F.col("title")).count() == 0


CONFIG = """
pdf_processing: {{skip_start_pages: 0, skip_end_pages: 0, default_language: en}}
output: {{indent: 1, ensure_ascii: false}}
logging: {{level: INFO}}
pipelines:
  product_technical:
    enabled: true
    source_dir: {source}
    output_dir: {out}
    document_glob: "*.txt"
    symbolic:
      section_patterns: {{level1: '^\\d+\\s+[A-Z][A-Z\\s&]+$'}}
      skip_header_footer_patterns: {{page_number: '^\\s*\\d+\\s*$', broken: '('}}
"""


def test_a_whole_run(spark, folder, tmp_path, capsys, caplog):
    pytest.importorskip("yaml")
    out, config = tmp_path / "parsed", tmp_path / "c.yaml"
    config.write_text(CONFIG.format(source=folder, out=out))
    assert cli.main(["--config", str(config), "--document", "a/x.txt", "--document", "b/x.txt", "--document", "a/bad.txt"]) == 0
    names = sorted(os.listdir(out))
    assert len(names) == 2 and all(n.startswith("x-") for n in names)  # two files with one stem
    trees = [json.load(open(out / n)) for n in names]
    assert sorted(s["title"] for t in trees for s in t["sections"]) == ["1 AAA", "1 BBB"] and {t["title"] for t in trees} == {"x"}
    assert {t["source"]["uri"] for t in trees} == {f"{folder}/a/x.txt", f"{folder}/b/x.txt"}
    assert "documents: 2" in capsys.readouterr().out
    assert "broken does not compile" in caplog.text and "bad.txt: read: UnicodeDecodeError" in caplog.text
    assert cli.main(["--config", str(config), "--document", "none.txt"]) == 2
    config.write_text(CONFIG.format(source=tmp_path / "nowhere", out=out))
    assert cli.main(["--config", str(config)]) == 2
