"""Exact Jaccard self-join on word n-grams with skipping by set relations.

Sets that are equal are one class.  Every class indexes a prefix of its shingles in one global order (rare
first, by a count sketch of fixed size over all documents), and a list is read in blocks of like set size, of
which only those at a compatible size and position are visited.

Highly similar sets are not looked up one by one: the sets that share most of their indexed shingles with one leader
are its family.  Inside a family, the overlaps of one set with all others bound those of any two others, so most answers are
derived from it, and only the rest are compared, in cells of bounded size.  Lists are then visited for
links between families alone, where a pair is met at the first shingle that both index.
Every link lies inside a component, so the links are counted by comparing the sets of a component in the same way.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import bounded_batches, slices, tidied
from .components import components
from .scratch import Scratch

TEXT = 1 << 20  # bytes of text whose sets are held at once
BUCKETS, SHIFT = 1 << 22, 42
CHUNK = 1 << 18
HOT_DF = 4096  # a shingle in more documents than this, by the sketch, has its list split over tasks
FIRST = 12  # of a set's tokens in the last round, so many are known wherever it is met
BROADCAST_IDS = 500_000
CELL_SETS, CELL_VALUES, WIDTH = 1024, 1 << 20, 2048  # sets and shingles of a cell, about, and columns multiplied at once
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


BLOCK_BYTES = 2 << 20  # bytes whose hashes are summed at once
_BLANK = [0x20, *range(0x09, 0x0E)]
_SOLID = ~np.isin(np.arange(256), _BLANK)
_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _MULT[0])
_BYTES[65:91] = _BYTES[97:123]  # A-Z count as a-z
_PLACES = _mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * _MULT[1]) | np.uint64(1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts``, and the place in them where each text's words start (and the last end).

    A hash is a sum over a word's bytes of a value of the byte times a value of its place, then mixed with the length.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if off[0] == off[-1]:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    data, off = np.frombuffer(texts.buffers()[2], np.uint8)[off[0] : off[-1]], off - off[0]
    solid = _SOLID[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    head, tail = off[:-1][off[:-1] < len(data)], off[1:][off[1:] > 0] - 1  # texts touch each other in the buffer
    first[head], last[tail] = solid[head], solid[tail]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), BLOCK_BYTES)), len(starts))).tolist()
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        n = ends[i:j] - starts[i:j]
        at = np.cumsum(n) - n
        place = np.arange(at[-1] + n[-1]) - np.repeat(at, n)
        span = slice(starts[i], ends[j - 1])
        values = _PLACES[place & 0xFFFF] + (place >> 16).astype(np.uint64) * _MULT[2] if n.max() > 1 << 16 else _PLACES[place]
        out[i:j] = np.add.reduceat(_BYTES[data[span][solid[span]]] * values, at) + n.astype(np.uint64) * _MULT[3]
    return _mix(out), np.searchsorted(starts, off)


def _distinct(s: np.ndarray) -> np.ndarray:
    s.sort()
    return s if len(s) < 2 else s[np.concatenate([[True], s[1:] != s[:-1]])]


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    """The distinct hashes of ``k`` successive word hashes."""
    n = len(h) - k + 1
    s = h[:n] * _MULT[0]
    for i in range(1, k):
        s = s + h[i : i + n] * _MULT[i]
    return _distinct(_mix(s))


def shingle_sets(texts: pa.Array, k: int):
    """The set of ``k``-word shingles of each text as sorted 64-bit hashes.

    Words are runs of bytes other than space and 0x09-0x0D with A-Z lower-cased.  Fewer than ``k`` words
    make one shingle, none make an empty set; a null text has none.
    """
    hashes, bounds = word_hashes(texts)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            yield _shingles(hashes[a:b], k)
        elif b > a:
            yield np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes(), 1 + b - a)], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _slices(batches):
    for batch in batches:
        yield from slices(batch, "text", TEXT)


def _docs(batch: pa.RecordBatch, k: int):
    return zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), k), strict=True)


def _summarise(k: int):
    def run(batches):
        counts, held, size = np.zeros(BUCKETS, np.uint32), [], 0
        for batch in _slices(batches):
            ids, ns, his, los = [], [], [], []
            for doc, s in _docs(batch, k):
                held.append(s >> np.uint64(SHIFT))
                size += len(s)
                if size > BUCKETS // 4:
                    counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=BUCKETS).astype(np.uint32)
                    held, size = [], 0
                sig = xxhash.xxh3_128_intdigest(s.tobytes())
                ids.append(doc), ns.append(len(s)), his.append((sig >> 64) - (1 << 63)), los.append((sig & ((1 << 64) - 1)) - (1 << 63))
            none = pa.nulls(len(ids), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int32()), pa.array(his, pa.int64()), pa.array(los, pa.int64()), none, pa.nulls(len(ids), pa.binary())], names=["doc_id", "n", "hi", "lo", "chunk", "counts"])
        if size:
            counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=BUCKETS).astype(np.uint32)
        full = [i for i in range(BUCKETS // CHUNK) if counts[i * CHUNK : (i + 1) * CHUNK].any()]
        if full:
            data = [zstandard.compress(counts[i * CHUNK : (i + 1) * CHUNK].tobytes(), 3) for i in full]
            empty = [pa.nulls(len(full), t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(full, pa.int32()), pa.array(data, pa.binary())], names=["doc_id", "n", "hi", "lo", "chunk", "counts"])

    return run


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint32)


def _add(pdf):
    total = np.zeros(CHUNK, np.int64)
    for c in pdf["counts"]:
        total += _counts(c)
    return pdf.iloc[:1].assign(counts=[zstandard.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 3)])


def _prefixes(k: int, percent: int, levels, hot_level: int):
    def run(batches):
        level_of = levels.value
        for batch in _slices(batches):
            tokens, reps, ns, at, hot = [], [], [], [], []
            for doc, s in _docs(batch, k):
                n = len(s)
                if not n:
                    continue
                level = level_of[s >> np.uint64(SHIFT)]
                p = n - -(-percent * n // 100) + 1
                order = np.argsort((level.astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8)), kind="stable")[:p]
                tokens.append(s[order].view(np.int64)), reps.append(np.full(p, doc, np.int64)), ns.append(np.full(p, n, np.int32))
                at.append(np.arange(p, dtype=np.int32)), hot.append(level[order] >= hot_level)
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, reps, ns, at, hot)], names=["token", "rep", "n", "pos", "hot"])

    return run


def _sets(k: int):
    def run(batches):
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([s.view(np.int64) for s in shingle_sets(batch.column("text"), k)], pa.list_(pa.int64()))], names=["rep", "s"])

    return run


def _checked(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ids only up to a fixed number of them; beyond it Spark shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_IDS else df


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    sets = left + right
    values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, col, n = np.unique(values, return_inverse=True, return_counts=True)
    new = np.cumsum(n > 1) - 1  # only shingles of two sets or more
    some = n[col] > 1
    row, col = row[some], new[col[some]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, int(col[-1]) + 1 if len(col) else 0, WIDTH):
        i, j = np.searchsorted(col, (at, at + WIDTH))
        flags = np.zeros((len(sets), WIDTH), np.float32)
        flags[row[i:j], col[i:j] - at] = 1
        out += (flags[: len(left)] @ flags[len(left) :].T).astype(np.int64)
    return out


def _linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which left set links with which right set.

    The overlaps of a leader (the first set) with all others are computed; they bound the overlap of any two others, as what a
    set lacks of the leader, or has besides it, is all that can differ.  Answers that the bounds settle are derived so; only
    sets with others are compared.
    """
    leader = left[0]
    n, m = (np.array([len(s) for s in x]) for x in (left, right))
    p, q = (np.array([np.isin(s, leader, assume_unique=True).sum() for s in x]) for x in (left, right))
    need = percent * (n[:, None] + m)
    yes = (100 + percent) * (p[:, None] + q - len(leader)) >= need
    open_ = ~yes & ((100 + percent) * (np.minimum(p[:, None], q) + np.minimum((n - p)[:, None], m - q)) >= need)
    i, j = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
    if len(i):
        yes[np.ix_(i, j)] |= (100 + percent) * _common([left[x] for x in i], [right[y] for y in j]) >= need[np.ix_(i, j)]
    return yes


def _forest(a: np.ndarray, b: np.ndarray, linked: np.ndarray):
    """The smallest id that each row's and column's links reach, for those that are not it themselves."""
    x, y, top = a, b, np.iinfo(np.int64).max
    while True:
        u = np.minimum(x, np.where(linked, y, top).min(1, initial=top))
        v = np.minimum(y, np.where(linked, u[:, None], top).min(0, initial=top))
        if (u == x).all() and (v == y).all():
            break
        x, y = u, v
    for own, least in ((a, x), (b, y)):
        some = own != least
        yield own[some], least[some]


PAIRS, COPIES, FOREST = "pairs", "copies", "forest"


def _compare(percent: int, what: str):
    """Rows sorted by ``key`` to the links of each key's cells: as pairs, as the copies that each set links with, or as a spanning forest."""

    def links(rows):
        left, right = [r for r in rows if r[1]], [r for r in rows if r[2]]
        if not left or not right:
            return
        a, b = (np.array([r[3] for r in x], np.int64) for x in (left, right))
        linked = _linked([r[5] for r in left], [r[5] for r in right], percent)
        same = {*a.tolist()} == {*b.tolist()}  # a cell with itself
        linked &= a[:, None] > b if same else a[:, None] != b
        if what == FOREST:
            yield from _forest(a, b, linked | linked.T if same and (a == b).all() else linked)
            return
        i, j = np.nonzero(linked)
        if what == PAIRS:
            yield np.maximum(a[i], b[j]), np.minimum(a[i], b[j])
            return
        x, y = (np.array([r[4] for r in q]) for q in (left, right))
        for u, v in ((a, linked @ y), (b, x @ linked)):
            yield u[v != 0], v[v != 0]

    def run(batches):
        held, key = [], None

        def flush():
            for u, v in links(held):
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["a", "b"])

        for batch in batches:
            s = batch.column("s")
            sets = [x.values.to_numpy(zero_copy_only=False) for x in s]
            for k, l, r, rep, copies, x in zip(*[batch.column(c).to_pylist() for c in ("key", "l", "r", "rep", "copies")], sets, strict=True):
                if k != key:
                    yield from flush()
                    held, key = [], k
                held.append((k, l, r, rep, copies, x.copy()))
        yield from flush()

    return run


def _cells(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, what: str) -> DataFrame:
    """The links inside each group ``c`` of ``members(rep, n, copies, c)``.

    A group's sets are dealt by size and then by hash into cells; a cell is compared with those of its own and the
    next block of sizes.  Groups of one set have none.
    """
    block = F.floor(F.log("n") / (1.001 * math.log(100 / percent))).cast("int")
    some = scratch.save(members.withColumn("z", block), f"members_{what}")
    cells = some.groupBy("c", "z").agg(F.count("*").alias("sets"), F.ceil(F.count("*") / CELL_SETS + F.sum(F.col("n").cast("long")) / CELL_VALUES).alias("cells"))
    cells = scratch.save(cells, f"cells_{what}")
    near = [cells.select("c", (F.col("z") + d).alias("z"), F.col("cells").alias(name)) for d, name in ((-1, "after"), (1, "before"))]
    at = some.join(cells, ["c", "z"]).join(near[0], ["c", "z"], "left").join(near[1], ["c", "z"], "left").withColumn("i", F.pmod(F.xxhash64("rep"), F.col("cells")))
    at = at.filter("sets > 1 or after is not null or before is not null")
    upto = lambda name: F.sequence(F.lit(0).cast("long"), F.col(name) - 1)
    to = lambda z, i, w, j, l, r: F.struct(z.alias("z"), i.alias("i"), w.alias("w"), j.alias("j"), l.alias("l"), r.alias("r"))
    z, i, yes, no = F.col("z"), F.col("i"), F.lit(True), F.lit(False)
    inner = F.transform(upto("cells"), lambda j: to(z, F.least(i, j), z, F.greatest(i, j), i <= j, i >= j))
    after = F.when(F.col("after").isNotNull(), F.transform(upto("after"), lambda j: to(z, i, z + 1, j, yes, no)))
    before = F.when(F.col("before").isNotNull(), F.transform(upto("before"), lambda j: to(z - 1, j, z, i, no, yes)))
    none = F.array().cast("array<struct<z:int,i:bigint,w:int,j:bigint,l:boolean,r:boolean>>")
    dealt = at.withColumn("to", F.explode(F.concat(inner, F.coalesce(after, none), F.coalesce(before, none))))
    key = F.concat_ws(" ", "c", "to.z", "to.i", "to.w", "to.j").alias("key")
    dealt = dealt.select(key, "to.l", "to.r", "rep", "copies").join(sets, "rep")
    return dealt.repartition("key").sortWithinPartitions("key").select("key", "l", "r", "rep", "copies", "s").mapInArrow(tidied(_compare(percent, what)), "a long, b long")


def _links(classes: DataFrame, label: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, what: str) -> DataFrame:
    """The links between classes, all of which lie inside components."""
    return _cells(classes.join(label, "rep").select("rep", "n", "copies", F.col("component_id").alias("c")), sets, percent, scratch, what)


NUMBERS = 1 << 48  # numbers for rows that repeat an id: a partition takes 2**33 of them


def keyed(documents: DataFrame, scratch: Scratch, nulls: bool) -> tuple[DataFrame, bool]:
    """``documents`` with a column ``key_``: the doc_id where it is one row's own, else a number that is no id; and whether there are such.

    Rows that repeat an id (and with ``nulls`` those without one) are written once, so that their numbers stay.  Without ``nulls`` a null id
    has a null key.
    """
    docs = documents.withColumn("doc_id", F.col("doc_id").cast("long"))
    again = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("doc_id is null or n > 1" if nulls else "n > 1").filter("true" if nulls else "doc_id is not null")
    again, told = scratch.save_and_tell(again.select("doc_id"), "again")
    own = docs.withColumn("key_", F.col("doc_id"))
    if not told["n"]:
        return own, False
    low, top = docs.agg(F.coalesce(F.min("doc_id"), F.lit(0)), F.coalesce(F.max("doc_id"), F.lit(0))).first()
    if top < 2**63 - NUMBERS:
        start = top + 1
    elif low >= NUMBERS - 2**63:
        start = low - NUMBERS
    else:  # both ends are taken: a range of its own between them
        cells = {r[0] for r in docs.filter("doc_id is not null").select(F.shiftright("doc_id", NUMBERS.bit_length() - 1)).distinct().collect()}  # 65,536 at most
        start = next(c for c in range(-(2**15), 2**15) if c not in cells) * NUMBERS
    ids = _checked(again.select(F.col("doc_id").alias("id_")), told["n"])
    same = F.col("doc_id").eqNullSafe(F.col("id_"))
    rows = docs.join(ids, same, "left_semi").withColumn("key_", F.monotonically_increasing_id() + F.lit(start).cast("long"))
    return own.join(ids, same, "left_anti").unionByName(scratch.save(rows, "repeated")), True


def ngram_jaccard_join(documents: DataFrame, k: int = 4, percent: int = 85, links: bool = True) -> DataFrame:
    """Link documents when ``100 * intersection >= percent * union`` of their ``k``-word shingle sets.

    Returns ``doc_id, n_shingles long, component_id long, class_id long, n_links long``, a row for each input row: the
    set size, the smallest doc_id that links reach, the smallest doc_id with an equal set, and the number of other rows
    that the row links with (equal sets included; without ``links`` there is no such column).  Null or wordless texts have
    an empty set and link with nothing, so their component is their own id; a null doc_id links with nothing and has a null
    component.  Rows that repeat a doc_id are documents of their own, with the same text or another: each is returned with its own
    size, links and component.  Further columns are ignored.  Shingles are compared by 64-bit hashes and whole sets by 128-bit ones.
    """
    docs, many = keyed(documents.select("doc_id", F.col("text").cast("string").alias("text")), Scratch(documents.sparkSession, "keys"), False)
    scratch, facts, live, classes, label, sets = _solve(docs.select(F.col("key_").alias("doc_id"), "text"), k, percent)
    known = classes.join(label, "rep", "left").select("hi", "lo", "rep", F.coalesce("component_id", "rep").alias("c"), "copies")
    out, none = [F.col("doc_id"), F.col("n").cast("long").alias("n_shingles")], []
    if links:
        found = _links(classes, label, sets, percent, scratch, COPIES).groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("more"))
        known = known.join(scratch.save(found, "n_links"), "rep", "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("more", F.lit(0)))
        none = [F.lit(0).cast("long").alias("n_links")]
    linked, alone = live.join(known, ["hi", "lo"]), facts.filter("not (n > 0 and doc_id is not null)")
    if many:  # from keys back to ids
        ids = docs.select("key_", F.col("doc_id").alias("id_"))
        back = lambda df: df.join(ids, df["doc_id"] == ids["key_"], "left").drop("doc_id", "key_").withColumnRenamed("id_", "doc_id")
        linked, alone = scratch.save(back(linked), "linked"), back(alone)
        least = lambda by, name: linked.groupBy(by).agg(F.min("doc_id").alias(name))
        linked = linked.join(least("c", "component_id"), "c").join(least("rep", "class_id"), "rep")
    else:
        linked = linked.withColumns({"component_id": F.col("c"), "class_id": F.col("rep")})
    linked = linked.select(*out, "component_id", "class_id", *(["n_links"] if links else []))
    return linked.union(alone.select(*out, F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"), *none))


def one_of_each(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of each group of linked ones: that with the smallest doc_id.

    Rows that repeat an id or have none are documents of their own here, as a rule after all others, so of exact copies one stays
    whatever their ids.  Null and wordless texts link with nothing and all stay.
    """
    scratch = Scratch(documents.sparkSession, "unlike")
    docs, _ = keyed(documents, scratch, True)
    _, _, live, classes, label, _ = _solve(docs.select(F.col("key_").alias("doc_id"), F.col("text").cast("string").alias("text")), k, percent)
    known = classes.join(label, "rep", "left").select("hi", "lo", F.coalesce("component_id", "rep").alias("c"))
    gone, told = scratch.save_and_tell(live.join(known, ["hi", "lo"]).filter("doc_id <> c").select(F.col("doc_id").alias("key_")), "gone")
    return docs.join(_checked(gone, told["n"]), "key_", "left_anti").drop("key_")


def ngram_jaccard_pairs(documents: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """Every link between different sets as ``a long, b long``, class ids of ``ngram_jaccard_join`` with a > b.

    Rows without an id take no part.  A class of rows that repeat ids may be named by a number that is no id.
    """
    docs, _ = keyed(documents.select("doc_id", F.col("text").cast("string").alias("text")), Scratch(documents.sparkSession, "keys"), False)
    scratch, _, _, classes, label, sets = _solve(docs.select(F.col("key_").alias("doc_id"), "text"), k, percent)
    return _links(classes, label, sets, percent, scratch, PAIRS)


def _solve(documents: DataFrame, k: int, percent: int):
    """Sizes and signatures of all rows, classes of equal sets, component labels of linked classes, and the classes' sets.

    An id is null or one row's own.
    """
    spark = documents.sparkSession
    sc, scratch = spark.sparkContext, Scratch(spark, "jaccard")
    bounded_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = scratch.save(docs.mapInArrow(tidied(_summarise(k)), "doc_id long, n int, hi long, lo long, chunk int, counts binary"), "first")
    facts = first.filter("chunk is null").select("doc_id", "n", "hi", "lo")
    live = facts.filter("n > 0 and doc_id is not null")
    classes = scratch.save(live.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count("*").alias("copies")), "classes")

    parts = first.filter("chunk is not null").select("chunk", "counts").withColumn("salt", (F.monotonically_increasing_id().bitwiseXOR(F.spark_partition_id()) % 16).cast("int"))
    shape = "chunk int, counts binary, salt int"
    sums = parts.groupBy("chunk", "salt").applyInPandas(_add, shape).groupBy("chunk").applyInPandas(_add, shape).collect()  # BUCKETS counts in all
    as_level = lambda x: np.minimum(255, np.floor(8 * np.log2(np.maximum(1, x)))).astype(np.uint8)
    levels = np.zeros(BUCKETS, np.uint8)
    for c in sums:
        levels[c.chunk * CHUNK : (c.chunk + 1) * CHUNK] = as_level(_counts(c.counts))
    del sums
    levels, hot_level = sc.broadcast(levels), int(as_level(np.array([HOT_DF]))[0])

    spare = live.join(classes.select("hi", "lo", "rep"), ["hi", "lo"]).filter("doc_id <> rep").select("doc_id").distinct()
    spare, told = scratch.save_and_tell(spare, "spare")
    ones = docs.filter("doc_id is not null").join(_checked(spare, told["n"]), "doc_id", "left_anti")
    rows = ones.mapInArrow(tidied(_prefixes(k, percent, levels, hot_level)), "token long, rep long, n int, pos int, hot boolean")
    rows = scratch.save(rows, "prefixes")
    w = Window.partitionBy("token").orderBy("n", "rep")
    # Partners of a row have sizes from ``least`` to ``most``; the nearest sizes in the list tell whether there can be one.
    least = (percent * F.col("n") + 99) / 100
    most = F.least(F.floor((F.col("n") - F.col("pos")) * (100 + percent) / percent) - F.col("n"), F.floor(100 * F.col("n") / percent))
    below, above = F.lag("n").over(w), F.lead("n").over(w)
    fit = F.coalesce(below >= F.floor(least), F.lit(False)) | ((most >= F.col("n")) & F.coalesce(above <= most, F.lit(False)))
    cold = rows.filter("not hot").withColumn("fit", fit).filter("fit").select("token", "rep", "n", "pos")
    ends = rows.filter("hot").groupBy("token").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("token")
    warm = rows.filter("hot").join(ends, "token").select("token", "rep", "n", "pos")
    block = F.floor(F.log("n") / (1.001 * math.log(100 / percent))).cast("int")  # compatible sizes are at most one block apart
    shared = scratch.save(cold.union(warm).withColumn("block", block), "shared")
    scratch.drop("prefixes")

    need, told = scratch.save_and_tell(shared.select(F.col("rep").alias("doc_id")).distinct(), "need")
    sets = scratch.save(ones.join(_checked(need, told["n"]), "doc_id", "left_semi").mapInArrow(tidied(_sets(k)), "rep long, s array<long>"), "sets")

    # A family: the sets that share most of their indexed tokens with one leader, the least by a hash of each list.
    leaders = shared.groupBy("token").agg(F.min(F.struct(F.xxhash64("rep").alias("h"), "rep")).alias("p"))
    shares = shared.join(leaders, "token").groupBy("rep", "n", F.col("p.rep").alias("c")).count().filter("100 * count >= n")
    families = shares.groupBy("rep", "n").agg(F.max_by("c", F.struct("count", "c")).alias("c"))
    families = scratch.save(families.withColumn("copies", F.lit(1).cast("long")), "families")
    edges = scratch.save(_cells(families, sets, percent, scratch, FOREST), "forest")
    label = scratch.save(components(edges, scratch, "cc_family_").withColumnRenamed("id", "rep"), "near")

    # All links between families are left; sets that are in one component by now need no test.
    t = shared.join(label, "rep", "left").withColumn("c", F.coalesce("component_id", "rep")).drop("component_id")
    t = t.join(families.select("rep", F.col("c").alias("f")), "rep", "left").withColumn("f", F.coalesce("f", "rep"))
    t = scratch.save(t, "last")
    some = t.groupBy("token").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.min("f").alias("u"), F.max("f").alias("v")).filter("x < y and u < v").select("token")
    t = scratch.save(t.join(some, "token"), "mixed")
    # A pair is met at the first token that both have; further ones are skipped if it is among the first few of both.
    first = t.groupBy("rep").agg(F.slice(F.sort_array(F.collect_list(F.struct("pos", "token"))), 1, FIRST).alias("first"))
    t = t.join(first, "rep").withColumn("early", F.filter("first", lambda f: f["pos"] < F.col("pos"))["token"])
    columns = ("rep", "n", "pos", "c", "f", "early")
    l = t.select("token", "block", *[F.col(c).alias(f"l_{c}") for c in columns])
    s = t.withColumn("block", F.explode(F.array(F.col("block"), F.col("block") + 1))).select("token", "block", *[F.col(c).alias(f"r_{c}") for c in columns])
    rest = F.least(F.col("l_n") - F.col("l_pos"), F.col("r_n") - F.col("r_pos"))
    fits = (F.col("l_c") != F.col("r_c")) & (F.col("l_f") != F.col("r_f")) & (F.col("l_n") >= F.col("r_n")) & (100 * F.col("r_n") >= percent * F.col("l_n")) & ((100 + percent) * rest >= percent * (F.col("l_n") + F.col("r_n")))
    fits &= ~F.arrays_overlap("l_early", "r_early")
    pairs = l.join(s, (l["token"] == s["token"]) & (l["block"] == s["block"]) & fits).select(F.greatest("l_rep", "r_rep").alias("a"), F.least("l_rep", "r_rep").alias("b")).distinct()
    pairs, told = scratch.save_and_tell(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    few = sets.join(F.broadcast(ids) if told["n"] <= BROADCAST_IDS // 2 else ids, "rep", "left_semi")  # only the sets that pairs name are shuffled
    a, b = few.select(F.col("rep").alias("a"), F.col("s").alias("x")), few.select(F.col("rep").alias("b"), F.col("s").alias("y"))
    got = pairs.join(a, "a").join(b, "b").withColumn("i", F.size(F.array_intersect("x", "y")))
    links = got.filter((100 + percent) * F.col("i") >= percent * (F.size("x") + F.size("y"))).select("a", "b")
    label = components(edges.union(scratch.save(links, "links")), scratch, "cc_").withColumnRenamed("id", "rep")
    label = scratch.save(label, "labels")
    for name in ("shared", "need", "spare", "families", f"members_{FOREST}", f"cells_{FOREST}", "forest", "near", "last", "mixed", "pairs", "links"):
        scratch.drop(name)
    return scratch, facts, live, classes, label, sets
