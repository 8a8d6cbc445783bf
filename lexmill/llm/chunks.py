"""Bounded work in Arrow workers: slices of batches, chunks of texts and tables of known chunks.

Spark's Arrow batches are bounded by rows, not by bytes, so every mapper of this package works on slices of
about ``SLICE`` bytes of text.  A slice is cut into chunks by array operations; each different chunk of the
slice is looked up or solved once, and a document's answer is put together from those of its chunks.
"""

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

ROWS = 1024  # rows of an Arrow batch
SLICE = 4 << 20  # bytes of text that a mapper works on at once; a longer text is a slice of its own
TABLE = 48 << 20  # bytes of a worker's table of known chunks, about
LONG = 1024  # longer chunks are not kept in tables
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_SIGN = np.isin(np.arange(256), [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``ROWS`` rows, as Spark and its workers hold whole batches.  A lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS:
        spark.conf.set(name, str(ROWS))


def tidied(run: Callable, keeps: bool = False) -> Callable:
    """A mapper that gives memory back at its end and, unless it ``keeps`` a table itself, starts by dropping what others left in the worker."""

    def whole(batches):
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if not keeps:
            _HELD.clear()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)

    return whole


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts whose ``column`` holds about ``size`` bytes."""
    if not len(batch):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(batch):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def gathered(batches, column: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches, in their order, put together to about ``size`` bytes of ``column``; larger ones are cut."""
    some, held_ = [], 0
    for batch in batches:
        for part in slices(batch, column, size):
            n = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if some and held_ + n > size:
                yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]
                some, held_ = [], 0
            some.append(part)
            held_ += n
    if some:
        yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]


def buffers(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """Texts (null: empty), their bytes one after the other and the places where each starts (and the last ends)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return texts, np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if off[0] == off[-1]:
        return texts, np.zeros(0, np.uint8), np.zeros(len(off), np.int64)
    return texts, np.frombuffer(texts.buffers()[2], np.uint8)[off[0] : off[-1]], off - off[0]


def cut_at_blanks(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where chunks start that each begin with a blank (or the text)."""
    cut = data == 32
    cut[off[:-1][off[:-1] < len(data)]] = True
    return cut


def cut_at_words(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where chunks start, by bytes below 128: at white space, and where a letter is followed by a sign.

    A run of white space before another character gives its last one away: a blank begins the next chunk, others are
    chunks of their own.  The rest of the run, or a whole run at a text's end, is a chunk.
    """
    heads = off[:-1][off[:-1] < len(data)]
    space = _SPACE[data]
    cut, word = space.copy(), ~space
    cut[1:] &= ~space[:-1]
    word[1:] &= space[:-1]
    word[heads] = False
    at = np.flatnonzero(word)
    cut[at - 1] = True
    cut[at[data[at - 1] != 32]] = True
    cut[1:] |= _LETTER[data[:-1]] & _SIGN[data[1:]]
    cut[heads] = True
    return cut


def wide_space(texts: pa.Array) -> np.ndarray:
    """Which texts hold white space above U+007F."""
    texts, data, off = buffers(texts)
    out = np.zeros(len(texts), bool)
    if len(data) < 2:
        return out
    a, b, c = data[:-2], data[1:-1], data[2:]
    two = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
    some = np.flatnonzero((a == 0xE1) | (a == 0xE2) | (a == 0xE3))
    b, c, a = b[some], c[some], a[some]
    three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
    three |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    out[np.searchsorted(off, np.concatenate([np.flatnonzero(two), some[three]]), side="right") - 1] = True
    return out


def chunks(texts: pa.Array, cut: Callable, whole: np.ndarray | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different chunks of ``texts``, the place in them of each chunk, and the chunk where each text starts (and the last ends).

    ``cut`` says where chunks start; texts that ``whole`` marks are one chunk.
    """
    texts, data, off = buffers(texts)
    if not len(data):
        return [], np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    flags = cut(data, off)
    for i in np.flatnonzero(whole) if whole is not None else ():
        flags[off[i] + 1 : off[i + 1]] = False
    starts = np.append(np.flatnonzero(flags), len(data))
    parts = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = parts.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.searchsorted(starts, off)


class Table:
    """Answers of a function over lists of chunks, the recent ones kept: two generations of bounded size."""

    def __init__(self, solve: Callable[[list[str]], list], limit: int = TABLE):
        self.solve, self.limit = solve, limit // 2
        self.young, self.old, self.size = {}, {}, 0

    def __call__(self, asked: list[str]) -> list:
        """An answer for each of ``asked``, which are different."""
        out = list(map(self.young.get, asked))
        miss = [i for i, v in enumerate(out) if v is None]
        if not miss:
            return out
        keys = [asked[i] for i in miss]
        got = list(map(self.old.get, keys))
        new = [k for k, v in zip(keys, got, strict=True) if v is None]
        if new:
            solved = iter(self.solve(new))
            got = [next(solved) if v is None else v for v in got]
        for i, v in zip(miss, got, strict=True):
            out[i] = v
        if max(map(len, keys)) > LONG:
            kept = [(k, v) for k, v in zip(keys, got, strict=True) if len(k) <= LONG]
            keys, got = [k for k, _ in kept], [v for _, v in kept]
        self.young.update(zip(keys, got, strict=True))
        self.size += 150 * len(keys) + sum(map(len, keys)) + (33 * len(got) + sum(map(len, got)) if got and isinstance(got[0], bytes) else 0)
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, 0
        return out


def joined(answers: list[bytes], at: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The answers at ``at`` one after the other as bytes, and the place where each text starts (and the last ends)."""
    taken = pa.array(answers, pa.large_binary()).take(pa.array(at))
    off = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    data = np.frombuffer(taken.buffers()[2], np.uint8) if len(taken) and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off[bounds] - off[0]


_HELD: dict = {}


def held(key, make: Callable):
    """What ``make`` gives, kept in this worker until another key is asked for, so that tables of stages that ended do not add up."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]
