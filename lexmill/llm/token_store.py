"""Token ids in binary shards: one zstandard dictionary, a frame for each document, and an offset index.

A shard is: ``LXTK``, version (u16), bytes per id (u16), documents (u32), how many of them, the first ones, have no id (u32), tokens of earlier shards of the same
partition (u64), dictionary SHA-256 (32 bytes); then for each document its id (i64), frame offset (u64) and
number of ids (u32); then the frames.  All integers are little-endian.  A short document is read through the index
by decompressing its own frame.  Shards are binary cells of a Parquet table, so any file system that Spark writes
will do; the dictionary is a table of its own beside it.
"""

import hashlib
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .chunks import SLICE, TABLE, Table, bounded_batches, chunks, cut_at_words, gathered, held, joined, tidied, wide_space
from .scratch import Scratch

HEAD = struct.Struct("<4sHHIIQ32s")
ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("n", "<u4")])
MAGIC, VERSION = b"LXTK", 2
SHARD_BYTES = 4 << 20
DICT_BYTES, DICT_DOCS, DICT_CHARS = 64 << 10, 2000, 16_000  # the dictionary's size and the bound of its training sample
LEVEL = 1
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class ChunkEncoder:
    """Encodes by a byte-level tokenizer, chunk by chunk: where its chunks start, a pre-token always starts.

    Texts with white space above U+007F or with the text of a special token are encoded as a whole.
    """

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; idle threads of the library's pool take others'
        self.tok, self.kind = Tokenizer.from_file(path), np.dtype("<u2" if width == 2 else "<u4")
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.stop = self.tok.encode("\n", add_special_tokens=False).ids
        self.table = Table(self._solve, 2 * TABLE)

    def _solve(self, asked: list[str]) -> list[bytes]:
        """Ids of chunks.  A line end before a chunk's word is a token of its own and changes nothing else, so plain chunks are joined by it."""
        w, out = self.kind.itemsize, {}
        plain = [c for c in asked if not c.isspace() and (c.isascii() or not _WIDE.search(c)) and not any(s in c for s in self.special)] if len(self.stop) == 1 else []
        blocks = [plain[at : at + 512] for at in range(0, len(plain), 512)]
        for some, e in zip(blocks, self.tok.encode_batch_fast(["\n".join(b) for b in blocks], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.kind)
            cut, raw = np.flatnonzero(ids == self.stop[0]).tolist(), ids.tobytes()
            if len(cut) == len(some) - 1:
                out.update(zip(some, [raw[a * w : b * w] for a, b in zip([0, *[x + 1 for x in cut]], [*cut, len(ids)], strict=True)], strict=True))
        rest = [c for c in asked if c not in out]
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            out.update(zip(some, [np.array(e.ids, self.kind).tobytes() for e in self.tok.encode_batch_fast(some, add_special_tokens=False)], strict=True))
        return [out[c] for c in asked]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Serialized ids of each text; none of a null text."""
        whole = wide_space(texts)
        for s in self.special:
            whole |= pc.fill_null(pc.match_substring(texts, s), False).to_numpy(zero_copy_only=False)
        parts, at, bounds = chunks(texts, cut_at_words, whole)
        data, off = joined(self.table(parts), at, bounds)
        cuts = off.tolist()
        return [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _encoder(path: str, width: int) -> ChunkEncoder:
    return held(("ids", path, width), lambda: ChunkEncoder(path, width))


def _train(samples: list[bytes]) -> bytes:
    """A shared dictionary; empty if there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _codec(dictionary: bytes):
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def pack_shard(docs: list[tuple[int | None, int, bytes]], before: int, width: int, digest: bytes) -> bytes:
    """A shard of ``(doc_id, number of ids, frame)``, documents without an id first."""
    index = np.zeros(len(docs), ENTRY)
    at = 0
    for i, (doc, n, frame) in enumerate(docs):
        index[i] = (doc or 0, at, n)
        at += len(frame)
    return b"".join([HEAD.pack(MAGIC, VERSION, width, len(docs), sum(d is None for d, _, _ in docs), before, digest), index.tobytes(), *[f for _, _, f in docs]])


class Shard:
    """Reads a shard, checking that the dictionary is the one it was written with."""

    def __init__(self, blob: bytes, dictionary: bytes):
        magic, version, self.width, n, self.nulls, self.before, digest = HEAD.unpack_from(blob)
        if magic != MAGIC or version != VERSION or digest != hashlib.sha256(dictionary).digest():
            raise ValueError("not a shard of this dictionary")
        self.index = np.frombuffer(blob, ENTRY, n, HEAD.size)
        self.frames = memoryview(blob)[HEAD.size + n * ENTRY.itemsize :]
        self.unpack = zstandard.ZstdDecompressor(**_codec(dictionary))

    def ids(self, i: int) -> np.ndarray:
        e = self.index[i]
        end = self.index[i + 1]["offset"] if i + 1 < len(self.index) else len(self.frames)
        raw = self.unpack.decompress(self.frames[e["offset"] : end], max_output_size=max(1, int(e["n"]) * self.width))
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document, by its place in the index."""
        i = self.nulls + int(np.searchsorted(self.index["doc_id"][self.nulls :], doc_id))
        return self.ids(i) if i < len(self.index) and self.index[i]["doc_id"] == doc_id else None


def _samples(docs: DataFrame) -> pa.Array:
    """At most ``2 * DICT_DOCS`` short texts, drawn by a hash before any text is sent."""
    short = docs.filter(F.length("text") <= DICT_CHARS).select("text", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1_000_000)).alias("draw"))
    share = min(1.0, DICT_DOCS / max(1, docs.count()))
    some = short.filter(F.col("draw") <= int(share * 1_000_000)).limit(2 * DICT_DOCS).select("text").collect()
    return pa.array([r.text for r in some or short.limit(DICT_DOCS).select("text").collect()], pa.string())


def write_shards(documents: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the ids of every whole text, each with ``end_id`` after it, in ascending doc_id order, null ids first, under ``path``.

    ``tokenizer`` is a path on the driver and the executors.  Null texts are empty.  Documents with a null doc_id come first and
    are counted in their shard's head.  Rows that repeat a doc_id, null ones too, are stored one after the other, in the order of a
    hash of their texts and then of the texts, so that the order of the input's rows does not matter.  Further columns are ignored.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    width = 2 if max(end_id, Tokenizer.from_file(tokenizer).get_vocab_size() - 1) < 1 << 16 else 4
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    end = end_id.to_bytes(width, "little")
    dictionary = _train([x + end for x in ChunkEncoder(tokenizer, width).encode(_samples(docs))])
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest.hex(), bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def run(batches):
        enc, pack = _encoder(tokenizer, width), zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False, **_codec(shared.value))
        docs, size, tokens, before = [], 0, 0, 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([pack_shard(docs, before, width, digest)], pa.large_binary())], names=["tokens", "shard"])
        for part in gathered(batches, "text", 2 * SLICE):
            for doc, x in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text")), strict=True):
                x += end
                frame = pack.compress(x)
                docs.append((doc, len(x) // width, frame))
                size, tokens = size + len(frame) + ENTRY.itemsize, tokens + len(x) // width
                if size >= SHARD_BYTES:
                    yield out()
                    before, docs, size, tokens = before + tokens, [], 0, 0
        if docs:
            yield out()

    ordered = docs.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")  # a hot id is dealt by the hash
    shards = ordered.select("doc_id", "text").mapInArrow(tidied(run, keeps=True), "tokens long, shard binary").withColumn("part", F.spark_partition_id())
    shards.write.parquet(f"{path}/shards")


def read_shards(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, start long, n_tokens long, ids_crc32 long`` (and ``ids array<int>``) of every document that the files hold."""
    head = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = spark.sparkContext.broadcast(bytes(head.dictionary))
    shards = spark.read.parquet(f"{path}/shards")
    totals = shards.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect()  # a row for each partition of the writer, which ascend by doc_id
    starts, at = {}, 0
    for r in totals:
        starts[r.part], at = at, at + r.n
    starts = spark.sparkContext.broadcast(starts)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")

    def run(batches):
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("shard"), strict=True):
                s = Shard(blob.as_py(), dictionary.value)
                n = s.index["n"].astype(np.int64)
                ids = [s.ids(i) for i in range(len(n))] if keep_ids else None
                crc = [zlib.crc32((ids[i] if keep_ids else s.ids(i)).tobytes()) for i in range(len(n))]
                start = starts.value[part] + s.before + np.cumsum(n) - n
                cols = [pa.array(s.index["doc_id"].astype(np.int64), mask=np.arange(len(n)) < s.nulls), pa.array(start.astype(np.int64)), pa.array(n), pa.array(crc, pa.int64())]
                if keep_ids:
                    cols.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    return shards.select("part", "shard").mapInArrow(run, schema)


def token_files(documents: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the token files in the shared folder and return what reading them back gives."""
    spark = documents.sparkSession
    path = Scratch(spark, "tokens").root
    write_shards(documents, path, tokenizer, end_id)
    return read_shards(spark, path)
