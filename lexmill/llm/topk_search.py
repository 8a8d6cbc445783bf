"""Exact top-k inner products by no-random-access aggregation.

Each dimension is a list of a block's vectors sorted by component, read from the large end for positive query
weights and from the small end for negative ones.  After every round of sequential reading, a vector's score
lies between a lower bound (unread components at the list's far end) and an upper bound (unread components just
past the frontier).  A query stops as soon as few vectors' upper bounds reach what its k-th best is known to have:
the k-th best lower bound of the block, or the k-th best score of a first pass over a bounded sample, which holds in every
block, so that blocks that cannot beat it are left before a list is read.  The scores of those that remain are then
resolved.  All bounds of a round for a block of queries are two matrix products.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

ITEMS, QUERIES, SEEDS, SEED_BYTES = 4096, 1024, 2048, 64 << 20  # vectors of a block, queries of a block; about so many vectors of the first pass, fewer if they are long
DEPTHS = (0.5, 0.75)  # shares of every list read before the bounds are compared; the last round reads all
FEW = 8  # a query stops when at most 1 in FEW vectors of the block remain


def _exact_dtype(x: np.ndarray, q: np.ndarray) -> type:
    bound = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1])
    return np.float32 if bound < 2**23 else np.float64 if bound < 2**52 else object


def _as_long(v) -> int:
    return max(-(2**63), min(2**63 - 1, int(v)))


def _whole(m: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)


def block_topk(x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, k: int, known: np.ndarray | None = None):
    """For each query the ``k`` best of a block, by score and then by smaller id, as (query row, item row, score).

    ``ids`` and ``qids`` are (id, mark, twin) rows; a query's own row is no candidate.  ``known``: scores that each query's k-th best has
    at least; worse vectors of the block may be left out.
    """
    kind = _exact_dtype(x, q)
    x, q = (_whole(x), _whole(q)) if kind is object else (x.astype(kind), q.astype(kind))
    known = np.full(len(q), -np.inf) if known is None else known
    order = np.lexsort(ids.T[::-1])
    x, ids, n = x[order], ids[order], len(x)
    where = {key: i for i, key in enumerate(map(tuple, ids.tolist()))}
    mine = np.array([where.get(key, -1) for key in map(tuple, qids.tolist())], int)
    todo, out = np.arange(len(q)), []
    bounds = kind is not object and n > k
    if bounds:
        lists = np.sort(x, axis=0)
        best = np.maximum(q, 0) @ lists[-1] + np.minimum(q, 0) @ lists[0]  # before anything is read
        todo = todo[best >= known]
    for depth in (*DEPTHS, 1.0):
        if not len(todo):
            break
        w = q[todo]
        own = np.zeros((len(todo), n), bool)
        known_here = np.flatnonzero(mine[todo] >= 0)
        own[known_here, mine[todo][known_here]] = True
        alive, done = ~own, np.ones(len(todo), bool)
        if depth < 1 and bounds:
            read = max(1, int(depth * n))
            top, low = lists[n - read], lists[read - 1]
            seen_top, seen_low = x >= top, x <= low
            w2 = np.hstack([np.maximum(w, 0), np.minimum(w, 0)])
            upper = w2 @ np.hstack([np.where(seen_top, x, top - 1), np.where(seen_low, x, low + 1)]).T
            lower = w2 @ np.hstack([np.where(seen_top, x, lists[0]), np.where(seen_low, x, lists[-1])]).T
            lower[own] = -np.inf
            reach = np.maximum(np.partition(lower, n - k, axis=1)[:, n - k], known[todo])
            alive &= upper >= reach[:, None]
            done = alive.sum(1) <= n // FEW
        for r in np.flatnonzero(done):
            i = np.flatnonzero(alive[r])
            s = x[i] @ w[r]
            if len(i) > 4 * k and kind is not object:
                kth = np.partition(s, len(s) - k)[len(s) - k]
                i, s = i[s >= kth], s[s >= kth]
            best = sorted(range(len(i)), key=lambda j: -s[j])[:k]  # stable: ids ascend
            out.extend((todo[r], order[i[j]], _as_long(s[j])) for j in best)
        todo = todo[~done]
    return out


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Each query's ``k`` highest integer inner products over all vectors but its own row.

    Components become ``floor(scale * x)``.  Returns ``query_id long, rank int, vec_id long, score long``, ties to the
    smaller id; all vectors if fewer than ``k``.  Vectors that are null, hold null or non-finite components, or have a
    null id take no part; vectors of another length than the query's are no candidates of it.  Rows that repeat an id, also with the
    same vector, are rows of their own: each is a query, and a candidate of the others.  Scores beyond 64 bits saturate.
    Further columns are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")

    def usable(df: DataFrame) -> DataFrame:
        ok = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)))
        return df.withColumn("v", F.transform("v", lambda c: _floor(scale, c))).groupBy("id", "v").agg(F.count(F.lit(1)).alias("m")).select("id", "v", F.xxhash64("v").alias("mark"), F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("twin"))

    whole, told = scratch.save_and_tell(usable(vectors), "whole", F.max("dim").alias("longest"))
    share = min(1.0, min(SEEDS, SEED_BYTES // max(1, 8 * (told["longest"] or 0))) / max(1, told["n"]))
    seeds: dict[int, list] = {}
    for r in whole.filter(F.pmod(F.xxhash64("id", "mark", "twin"), F.lit(1 << 30)) < int(share * (1 << 30))).collect():  # the bound of the first pass; each task sends its share only
        seeds.setdefault(r.dim, []).append(r)
    seeds = spark.sparkContext.broadcast({d: (np.array([(r.id, r.mark, r.twin) for r in rs], np.int64).reshape(-1, 3), np.array([r.v for r in rs], np.float64).reshape(len(rs), -1)) for d, rs in seeds.items()})

    def packed(df: DataFrame, size: int, name: str, ask: bool) -> DataFrame:
        schema = "dim int, block int, blocks int, ids binary, xs binary, known binary"
        counts = df.groupBy("dim").count().collect()  # a row for each vector length
        if not counts:
            return spark.createDataFrame([], schema)
        blocks = F.create_map(*[F.lit(y) for c in counts for y in (c["dim"], -(-c["count"] // size))])
        df = df.withColumn("blocks", blocks[F.col("dim")].cast("int")).withColumn("block", F.pmod(F.xxhash64("id", "mark", "twin"), F.col("blocks")).cast("int"))

        def pack(g: pd.DataFrame) -> pd.DataFrame:
            x, ids = np.array(g["v"].to_list(), np.float64).reshape(len(g), -1), g[["id", "mark", "twin"]].to_numpy(np.int64)
            known = np.full(len(g), -np.inf)
            some, y = seeds.value.get(int(g["dim"].iloc[0]), (None, None))
            if ask and some is not None and len(some) > k and _exact_dtype(y, x) is not object:
                scores = x @ y.T
                scores[(ids[:, None, :] == some).all(2)] = -np.inf
                known = np.partition(scores, len(some) - k, axis=1)[:, len(some) - k]
            return pd.DataFrame({"dim": [g["dim"].iloc[0]], "block": [g["block"].iloc[0]], "blocks": [g["blocks"].iloc[0]], "ids": [ids.tobytes()], "xs": [x.tobytes()], "known": [known.tobytes()]})

        return scratch.save(df.groupBy("dim", "block", "blocks").applyInPandas(pack, schema), name)

    items, asked = packed(whole, ITEMS, "items", False), packed(usable(queries), QUERIES, "queries", True)
    counts = asked.groupBy("dim").agg(F.first("blocks").alias("q_blocks"))
    each = items.select("dim", "block", "ids", "xs").join(counts, "dim").withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
    pairs = each.join(asked.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("xs").alias("q_xs"), "known"), ["dim", "q_block"])
    n = items.count() * max(1, asked.count())
    pairs = pairs.repartition(max(8, min(n, 100_000) // 2), "dim", "block", "q_block")

    def search(batches):
        for pdf in batches:
            for t in pdf.itertuples():
                ids, qids = np.frombuffer(t.ids, np.int64).reshape(-1, 3), np.frombuffer(t.q_ids, np.int64).reshape(-1, 3)
                x, q = np.frombuffer(t.xs).reshape(len(ids), -1), np.frombuffer(t.q_xs).reshape(len(qids), -1)
                got = block_topk(x, ids, q, qids, k, np.frombuffer(t.known))
                yield pd.DataFrame({"query_id": [qids[a, 0] for a, _, _ in got], "mark": [qids[a, 1] for a, _, _ in got], "twin": [qids[a, 2] for a, _, _ in got], "vec_id": [ids[b, 0] for _, b, _ in got], "score": [s for _, _, s in got]}).astype("int64")

    found = pairs.select("ids", "xs", "q_ids", "q_xs", "known").mapInPandas(search, "query_id long, mark long, twin long, vec_id long, score long")
    w = Window.partitionBy("query_id", "mark", "twin").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _floor(scale: float, c: F.Column) -> F.Column:
    """``floor(scale * c)`` as a double; beyond 2**52 a double is whole already."""
    y = F.lit(scale) * c
    return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)
