"""One JSON file for each structured document: written in two phases, read again with a warning for each unreadable file."""

import codecs
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .page_files import file_system, listed

SUFFIX = ".parsed.json"
CORRUPT = "_corrupt"


@dataclass
class Staged(WriterCommitMessage):
    """Where a task left its files; no names go to the driver."""

    folder: str
    n: int


def pretty(doc: str, indent: int, ascii_: bool) -> str:
    tree = json.loads(doc)
    for s in tree.get("sections") or ():
        if s.get("warnings") is None:
            s.pop("warnings", None)
    return json.dumps(tree, indent=indent, ensure_ascii=ascii_)


class DocumentWriter(DataSourceWriter):
    """Tasks write under a staging folder of the job, each attempt in its own; the commit renames what the attempts that count have left.

    A failed task, a repeated or a speculative attempt, or an aborted job leaves no file in the target, whole or half.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.overwrite = options["path"], overwrite
        self.indent, self.ascii, self.raw = int(options.get("indent", 2)), options.get("ascii", "false") == "true", options.get("raw", "false") == "true"
        self.parts = options.get("parts", "false") == "true"
        self.staging = f"{self.folder}/_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Staged:
        from pyspark import TaskContext

        task = TaskContext.get()
        at = f"{self.staging}/{task.partitionId()}-{task.taskAttemptId()}"
        system, inner = file_system(at)
        system.create_dir(inner, recursive=True)
        n, name, out, joint = 0, None, None, False
        try:
            for row in iterator:
                text = row["doc"] if self.raw else pretty(row["doc"], self.indent, self.ascii)
                if out is None or not self.parts or row["file"] != name:
                    if out is not None:
                        out.close()
                    name, joint = row["file"], False
                    out = system.open_output_stream(f"{inner}/{name}")
                    n += 1
                if self.parts:
                    if joint and row["joint"]:
                        out.write(b",")
                    joint = row["joint"]
                out.write(bytes(text) if isinstance(text, (bytes, bytearray)) else text.encode("utf-8"))
        finally:
            if out is not None:
                out.close()
        return Staged(at, n)

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        system, target = file_system(self.folder)
        system.create_dir(target, recursive=True)
        if self.overwrite:
            for old in system.get_file_info(fs.FileSelector(target)):
                if old.type == fs.FileType.File and old.base_name.endswith(SUFFIX):
                    system.delete_file(old.path)
        for m in messages:
            if m is not None and m.n:
                for f in system.get_file_info(fs.FileSelector(file_system(m.folder)[1])):
                    system.move(f.path, f"{target}/{f.base_name}")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        system, inner = file_system(self.staging)
        if system.get_file_info(inner).type == fs.FileType.Directory:
            system.delete_dir(inner)


class ParsedDocuments(DataSource):
    """``format("parsed_documents")`` for rows ``file string, doc`` (JSON text; with the option ``raw`` any text or bytes, as it is).

    With the options ``raw`` and ``parts`` rows ``file, doc, joint boolean`` are parts of files, in the order in which a task gets them; all of a file
    must come to one task, together.  A comma goes between two parts that are ``joint``.
    """

    @classmethod
    def name(cls) -> str:
        return "parsed_documents"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options, overwrite)


def file_names(docs: DataFrame, id_: Column, title: Column) -> DataFrame:
    """``docs`` with ``file``: the title, and a mark of the id where several documents have one title."""
    safe = F.regexp_replace(F.coalesce(title, F.lit("document")), "[/\\x00]", "_")
    docs = docs.withColumn("name_", safe).withColumn("mark_", F.substring(F.md5(id_.cast("string").cast("binary")), 1, 12))
    shared = docs.groupBy("name_").agg(F.count(F.lit(1)).alias("n_")).filter("n_ > 1").drop("n_").withColumn("shared_", F.lit(True))
    mark = F.when(F.col("shared_"), F.concat(F.lit("-"), "mark_")).otherwise("")
    return docs.join(shared, "name_", "left").withColumn("file", F.concat("name_", mark, F.lit(SUFFIX))).drop("name_", "mark_", "shared_")


def save_documents(docs: DataFrame, folder: str, *, indent: int = 2, ascii_: bool = False, overwrite: bool = True) -> None:
    """Write nested documents (``doc_id``, ``title`` and the rest) as one pretty JSON file each, into a folder that driver and executors share."""
    docs.sparkSession.dataSource.register(ParsedDocuments)
    body = F.to_json(F.struct(*[c for c in docs.columns if c != "doc_id"]), {"ignoreNullFields": "false"})
    rows = file_names(docs.select("doc_id", "title", body.alias("doc")), F.col("doc_id"), F.col("title")).select("file", "doc")
    rows.write.format("parsed_documents").options(indent=indent, ascii=str(ascii_).lower()).mode("overwrite" if overwrite else "append").save(folder)


CHUNK, PIECE = 1 << 20, 64 << 10  # bytes that are read of a file at once, and of elements that make one piece
_TEXT = rb"""(?:"(?:[^"\\]++|\\.)*+"|'(?:[^'\\]++|\\.)*+')"""
_LIST = rb"\[(?:[^\"'{}\[\]]++|" + _TEXT + rb")*+\]"
_FLAT = re.compile(rb"\{(?:[^\"'{}\[\]]++|" + _TEXT + rb"|" + _LIST + rb")*+\}", re.S)  # an object of texts, numbers and lists of these
_TOKEN = re.compile(_TEXT + rb"|[{}\[\]]|[\"']", re.S)
_STRING, _SCALAR, _SPACE = re.compile(_TEXT, re.S), re.compile(rb"[^\s,\]}{\[\"':]+"), re.compile(rb"[ \t\r\n]*")


class Unreadable(Exception):
    """A file that is no JSON object."""


class _Text:
    """A file's bytes, of which no more is held than the value that is being read; ``broken`` once they are no UTF-8."""

    def __init__(self, read):
        self.read, self.buf, self.at, self.ended, self.broken = read, b"", 0, False, False
        self.decode = codecs.getincrementaldecoder("utf-8")().decode

    def more(self, size: int = CHUNK) -> bool:
        """Read on; whether there was more."""
        if self.ended:
            return False
        data = self.read(size)
        self.ended = not data
        if not self.broken:
            try:
                self.decode(data, self.ended)
            except UnicodeDecodeError:
                self.broken = True
        self.buf, self.at = self.buf[self.at :] + data, 0
        return not self.ended

    def peek(self) -> bytes:
        """The next sign that is no white space; none at the end."""
        while True:
            self.at = _SPACE.match(self.buf, self.at).end()
            if self.at < len(self.buf):
                return self.buf[self.at : self.at + 1]
            if not self.more():
                return b""

    def take(self, sign: bytes) -> None:
        if self.peek() != sign:
            raise Unreadable
        self.at += 1

    def value(self) -> bytes:
        """The text of the next value; only where it ends is looked for, not whether it is right."""
        self.peek()
        while (end := self._end()) is None:
            if not self.more(max(CHUNK, len(self.buf) - self.at)):
                raise Unreadable
        out = self.buf[self.at : end]
        self.at = end
        return out

    def _end(self) -> int | None:
        first = self.buf[self.at : self.at + 1]
        if first in b"\"'":
            m = _STRING.match(self.buf, self.at)
            return m and m.end()
        if first not in b"{[":
            m = _SCALAR.match(self.buf, self.at)
            if m is None:
                raise Unreadable
            return m.end() if m.end() < len(self.buf) or self.ended else None
        if m := _FLAT.match(self.buf, self.at):
            return m.end()
        depth = 0
        for m in _TOKEN.finditer(self.buf, self.at):
            if (t := m[0]) in (b"{", b"["):
                depth += 1
            elif t in (b"}", b"]"):
                depth -= 1
                if not depth:
                    return m.end()
            elif len(t) == 1:  # a text that does not end here
                return None
        return None


def json_pieces(read, arrays: frozenset[str]):
    """The JSON object that ``read(size)`` gives, as smaller objects: one without the elements of its ``arrays``, and some with a few elements each.

    Where a piece is no JSON, neither is the whole, and a value stands where it stood, so a piece has the shape of a schema if the whole has.
    ``Unreadable`` is raised where the object's frame is broken.
    """
    text = read if isinstance(read, _Text) else _Text(read)
    text.take(b"{")
    head = []
    while text.peek() != b"}" or head:
        if text.peek() not in (b'"', b"'"):
            raise Unreadable
        key = text.value()
        text.take(b":")
        if text.peek() == b"[" and key[1:-1].decode("utf-8", "replace") in arrays:
            text.take(b"[")
            held, size = [], 0
            while text.peek() != b"]" or held or size:
                held.append(text.value())
                size += len(held[-1]) + 1
                if size >= PIECE:
                    yield b"{" + key + b":[" + b",".join(held) + b"]}"
                    held, size = [], 1
                if text.peek() == b"]":
                    break
                text.take(b",")
                if text.peek() == b"]":
                    raise Unreadable
            if held:
                yield b"{" + key + b":[" + b",".join(held) + b"]}"
            text.take(b"]")
            head.append(key + b":[]")
        else:
            head.append(key + b":" + text.value())
        if text.peek() == b"}":
            break
        text.take(b",")
    text.take(b"}")
    yield b"{" + b",".join(head) + b"}"


def _checked(batches, arrays: frozenset[str]):
    """Pieces of the files, and the problem of a file that has no more of them."""
    import pyarrow as pa

    def rows(path: str, system, inner: str):
        with system.open_input_stream(inner) as f:
            text = _Text(f.read)
            try:
                for piece in json_pieces(text, arrays):
                    if text.broken:
                        break
                    yield path, piece.decode("utf-8"), None
            except Unreadable:
                yield path, None, "unreadable"
            text.buf, text.at = b"", 0
            while not text.broken and text.more():
                text.buf = b""
            if text.broken:
                yield path, None, "encoding"

    out, size = [], 0
    for batch in batches:
        for path in batch.column("path").to_pylist():
            for row in rows(path, *file_system(path)):
                out.append(row)
                size += len(row[1] or "")
                if size >= 16 * PIECE or len(out) >= 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], names=["path", "piece", "problem"])
                    out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], names=["path", "piece", "problem"])


@dataclass(frozen=True)
class Reread:
    """Documents of a folder, and a warning for each file that gave none."""

    documents: DataFrame
    warnings: DataFrame  # path, filename, problem


def read_documents(spark: SparkSession, folder: str, schema: StructType) -> Reread:
    """Read the JSON files of a folder again.  A file that is empty, no UTF-8, no JSON or of another shape is a warning, and the rest is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder)
    text = F.col("content").cast("string")
    df = found.select("path", F.is_valid_utf8(text).alias("utf8"), text.alias("text"))
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json("text", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    df = df.withColumn("doc", F.when(F.col("utf8"), parsed))
    df = df.withColumn("problem", F.when(~F.col("utf8"), "encoding").when(F.col("doc").isNull() | F.col(f"doc.{CORRUPT}").isNotNull(), "unreadable"))
    # Spark's readers pass over empty files
    empty = spark.createDataFrame([(f.path,) for f in listed(folder, f"*{SUFFIX}") if not f.size], "path string")
    # The warnings come from pieces of the files, as a whole file may be larger than a task's memory.
    arrays = frozenset(f.name for f in schema.fields if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType))
    names = found.filter("length > 0").select("path").repartition("path")
    pieces = names.mapInArrow(lambda batches: _checked(batches, arrays), "path string, piece string, problem string")
    pieces = pieces.withColumn("doc", F.from_json("piece", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    wrong = F.col("piece").isNotNull() & (F.col("doc").isNull() | F.col(f"doc.{CORRUPT}").isNotNull())
    problem = F.coalesce("problem", F.when(wrong, "unreadable"))
    bad = pieces.select("path", problem.alias("problem")).groupBy("path").agg(F.min("problem").alias("problem")).filter("problem is not null")  # "encoding" before "unreadable"
    bad = bad.unionByName(empty.withColumn("problem", F.lit("empty")))
    bad = bad.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), "problem")
    return Reread(df.filter("problem is null").select("doc.*").drop(CORRUPT), bad)
