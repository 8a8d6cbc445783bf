"""Hard negatives by a distributed nearest-neighbour join over Voronoi cells.

A further component gives all vectors of one length the same norm, so the largest inner products with an anchor are its nearest
vectors.  Anchors belong to the cell of their nearest pivot, and cells are packed into groups.  Scores of a bounded sample say how
far an anchor has to look, so each cell has a ring around its pivot outside of which no vector can serve it.  A vector is sent to the
groups that have a cell with such a ring around it, met there in slices by exact products, and the slices' best are merged by rank.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .topk_search import _as_long, _exact_dtype, _floor, _whole

PIVOTS, SEEDS, SEED_BYTES = 32, 2048, 64 << 20  # pivots of a vector length; sampled vectors, fewer if they are longer than the bytes allow
GROUP, SLICE, LEAST_SLICE, SPREAD = 4096, 4096, 512, 16  # anchors of a block; candidates of a slice; slices of a group where they aren't smaller
AT_ONCE = 256  # anchors whose products with a slice are held
ROW = "row long, id long, label long, v array<double>, dim int"


@dataclass(frozen=True)
class Space:
    """Sample and pivots of one vector length."""

    x: np.ndarray
    row: np.ndarray
    label: np.ndarray
    pivots: np.ndarray  # with the further component
    square: float  # the largest squared norm of all vectors of this length

    def distances(self, v: np.ndarray, anchors: bool) -> np.ndarray:
        """From vectors, as anchors or as candidates, to the pivots."""
        own = (v * v).sum(1)
        last = np.zeros(len(v)) if anchors else np.sqrt(np.maximum(self.square - own, 0))
        total = (own if anchors else self.square) + self.square - 2 * (v @ self.pivots[:, :-1].T + np.outer(last, self.pivots[:, -1])).T
        return np.sqrt(np.maximum(total, 0)).T

    def reach(self, v: np.ndarray, score: np.ndarray) -> np.ndarray:
        """How far from an anchor a vector with this score lies; farther ones have smaller scores."""
        return np.sqrt(np.maximum((v * v).sum(1) + self.square - 2 * score, 0))


def matrix(v: pd.Series) -> np.ndarray:
    return np.array(v.to_list(), np.float64).reshape(len(v), -1)


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    kind = _exact_dtype(x, a)
    return (_whole(a) @ _whole(x).T) if kind is object else a.astype(kind) @ x.astype(kind).T


def best(s: np.ndarray, ids: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores among ``ok``, ties by smaller id."""
    at = np.flatnonzero(ok)
    if s.dtype != object and len(at) > 4 * k:
        kth = np.partition(s[at], len(at) - k)[len(at) - k]
        at = at[s[at] >= kth]
    return np.array(sorted(at, key=lambda i: (-s[i], ids[i]))[:k], int)


def bands(ps: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """The least and the largest negative score for each positive score."""
    return [(-(-low * int(p) // 100), high * int(p) // 100) for p in ps]


@dataclass
class Join:
    """What both passes share: sample, sizes and the rows of the table."""

    rows: DataFrame
    spaces: object  # broadcast: vector length to Space
    scratch: Scratch

    def placed(self, anchors: DataFrame, wanted: str, name: str) -> DataFrame:
        """Anchors with their cell and its ring's two radii. ``wanted``: columns of the least and the largest score that they need."""
        spaces, (low, high) = self.spaces, wanted.split(",")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for dim, g in pdf.groupby("dim"):
                    space, v = spaces.value[dim], matrix(g["v"])
                    d = space.distances(v, True)
                    cell = np.nan_to_num(d, nan=np.inf).argmin(1)
                    own = d[np.arange(len(d)), cell]
                    far, near = space.reach(v, g[low].to_numpy(float)) + own, space.reach(v, g[high].to_numpy(float)) - own
                    yield g.assign(cell=cell.astype("int32"), far=far, near=near)

        schema = ", ".join(f"{c} {t}" for c, t in anchors.dtypes)
        return self.scratch.save(anchors.mapInPandas(run, f"{schema}, cell int, far double, near double"), name)

    def meet(self, anchors: DataFrame, name: str, work, schema: str) -> DataFrame:
        """``work(block of anchors, slice of candidates)`` wherever a slice may serve the block; anchors come from ``placed``."""
        spaces = self.spaces
        rings: dict[int, list] = {}  # a row for each cell
        for r in anchors.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), F.min("near").alias("near")).collect():
            rings.setdefault(r.dim, []).append((r.cell, r.n, r.far, r.near))
        plan: dict[int, tuple] = {}  # vector length to cells, radii, group of each cell, anchors of each group
        for dim, cells in rings.items():
            p = spaces.value[dim].pivots
            order = np.nan_to_num(((p - p[0]) ** 2).sum(1)).argsort().argsort()
            cells.sort(key=lambda c: order[c[0]])
            group, sizes = [], []
            for _, n, _, _ in cells:
                if not sizes or sizes[-1] + n > GROUP:
                    sizes.append(0)
                sizes[-1] += n
                group.append(len(sizes) - 1)
            plan[dim] = (np.array([c[0] for c in cells]), np.array([c[2] for c in cells]), np.array([c[3] for c in cells]), np.array(group), sizes)

        def served(pdf: pd.DataFrame, dim: int) -> np.ndarray:
            """Whether each vector may serve each group."""
            cells, far, near, group, sizes = plan[dim]
            d = spaces.value[dim].distances(matrix(pdf["v"]), False)[:, cells]
            slack = 1e-9 * (np.abs(d) + np.abs(far)) + 1e-6
            ok = ~(d > far + slack) & ~(d < near - slack)  # an overflow keeps the vector
            out = np.zeros((len(pdf), len(sizes)), bool)
            np.logical_or.at(out, (slice(None), group), ok)
            return out

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for dim, g in pdf.groupby("dim"):
                    if dim in plan:
                        n = served(g, dim).sum(0)
                        yield pd.DataFrame({"dim": np.full(len(n), dim, "int32"), "grp": np.arange(len(n), dtype="int32"), "n": n.astype("int64")})

        counts = {(r.dim, r.grp): r.n for r in self.rows.mapInPandas(count, "dim int, grp int, n long").groupBy("dim", "grp").agg(F.sum("n").alias("n")).collect()}
        slices = {k: max(1, -(-n // SLICE), min(SPREAD, n // LEAST_SLICE)) for k, n in counts.items()}
        blocks = {(dim, g): -(-n // GROUP) for dim, (*_, sizes) in plan.items() for g, n in enumerate(sizes)}

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for dim, g in pdf.groupby("dim"):
                    if dim in plan:
                        i, grp = np.nonzero(served(g, dim))
                        n = np.array([slices[dim, k] for k in range(len(plan[dim][4]))])
                        yield g.iloc[i].assign(grp=grp.astype("int32"), part=(g["salt"].to_numpy()[i] % n[grp]).astype("int32")).drop(columns="salt")

        salt = F.pmod(F.xxhash64("row"), F.lit(1 << 40))
        known = self.rows.withColumn("salt", salt).mapInPandas(send, f"{ROW}, grp int, part int")

        def lookup(values: dict, *key: Column) -> Column:
            return F.create_map(*[F.lit(x) for (d, g), n in values.items() for x in (f"{d} {g}", n)])[F.concat_ws(" ", *key)] if values else F.lit(None).cast("int")

        groups = F.create_map(*[F.lit(x) for dim, (cells, _, _, group, _) in plan.items() for c, g in zip(cells, group, strict=True) for x in (f"{dim} {c}", int(g))]) if plan else None
        left = anchors.withColumn("grp", groups[F.concat_ws(" ", "dim", "cell")].cast("int") if plan else F.lit(None).cast("int"))
        left = left.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), lookup(blocks, F.col("dim"), F.col("grp")).cast("long")).cast("int"))
        left = left.withColumn("part", F.explode(F.sequence(F.lit(0), lookup(slices, F.col("dim"), F.col("grp")).cast("int") - 1)))
        right = known.withColumn("block", F.explode(F.sequence(F.lit(0), lookup(blocks, F.col("dim"), F.col("grp")).cast("int") - 1)))
        keys = ["dim", "grp", "block", "part"]

        def task(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            out = [work(a.iloc[i : i + AT_ONCE], x) for i in range(0, len(a), AT_ONCE)] if len(x) else []
            return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(task, schema)


def _sample(rows: DataFrame, n: int, longest: int) -> list:
    """About ``SEEDS`` rows by a threshold on a hash, so that each task sends its share only."""
    share = min(1.0, min(SEEDS, SEED_BYTES // max(1, 8 * longest)) / max(1, n))
    return rows.filter(F.pmod(F.xxhash64("row", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).collect()


def mine_hard_negatives(
    vectors: DataFrame, anchors: str, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """Highest-scored rows of another label inside a band below each of an anchor's positives.

    Components become ``floor(scale * x)``; a row's score is its integer inner product with the anchor, ties go to smaller ids.
    ``anchors`` is a condition on the given columns.  An anchor's positives are its first ``positives`` other rows of the same label; for
    each, the first ``negatives`` rows of another label with ``low * positive_score <= 100 * score <= high * positive_score`` are returned.

    Rows with a null label or id, a null vector, or a null or non-finite component (also once scaled) take no part; vectors of
    another length are no candidates of an anchor.  Rows that repeat an id, also with the same vector, are rows of their own, so an
    anchor that occurs twice is a positive of itself and gives its rows twice.  A zero vector takes part.  Scores beyond 64 bits
    saturate.  An empty table, or one without anchors, gives no rows; further columns are ignored, whatever their names.

    Returns ``anchor_id, positive_id, rank int, negative_id, positive_score, negative_score`` (longs).
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda c: _floor(scale, c))
    ok = F.coalesce(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("v"), F.coalesce(F.expr(anchors), F.lit(False)).alias("anchor"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ok).withColumn("dim", F.size("v"))
    rows = scratch.save(rows, "rows")
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    dims = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("square")).collect()  # a row for each vector length
    seeds: dict[int, list] = {}
    for r in _sample(rows, sum(d["n"] for d in dims), max((d["dim"] for d in dims), default=0)):
        seeds.setdefault(r.dim, []).append(r)

    def space(dim: int, square: float) -> Space:
        got = seeds.get(dim, [])
        x = np.array([r.v for r in got], np.float64).reshape(len(got), dim)
        p = x[:PIVOTS] if len(x) else np.zeros((1, dim))
        p = np.hstack([p, np.sqrt(np.maximum(square - (p * p).sum(1), 0))[:, None]])
        return Space(x, np.array([r.row for r in got], np.int64), np.array([r.label for r in got], np.int64), p, square)

    spaces = spark.sparkContext.broadcast({d["dim"]: space(d["dim"], d["square"]) for d in dims})
    join = Join(rows.drop("anchor"), spaces, scratch)

    def first_look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The score that an anchor's last positive has at least, by the sample."""
        for pdf in batches:
            for dim, g in pdf.groupby("dim"):
                s = spaces.value[dim]
                for i in range(0, len(g), AT_ONCE):
                    a = g.iloc[i : i + AT_ONCE]
                    got, least = scores(matrix(a["v"]), s.x), np.full(len(a), -np.inf)
                    for k, (row, label) in enumerate(zip(a["row"], a["label"], strict=True)):
                        at = best(got[k], s.row, (s.label == label) & (s.row != row), positives)
                        if len(at) == positives:
                            least[k] = float(got[k][at[-1]])
                    yield a.assign(least=least, most=np.inf)

    asked = rows.filter("anchor").drop("anchor").mapInPandas(first_look, f"{ROW}, least double, most double")

    def nearest(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        got, ids, labels, own = scores(matrix(a["v"]), matrix(x["v"])), x["id"].to_numpy(), x["label"].to_numpy(), x["row"].to_numpy()
        out = []
        for s, row, label in zip(got, a["row"], a["label"], strict=True):
            out += [(row, ids[i], _as_long(s[i])) for i in best(s, ids, (labels == label) & (own != row), positives)]
        return pd.DataFrame(out, columns=["row", "positive_id", "ps"])

    found = join.meet(join.placed(asked, "least,most", "asked"), "positives", nearest, "row long, positive_id long, ps long")
    order = Window.partitionBy("row").orderBy(F.desc("ps"), "positive_id")
    found = found.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= positives)
    found = scratch.save(found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("k", "positive_id", "ps"))).alias("p")), "positives")
    pairs = rows.filter("anchor").drop("anchor").join(found, "row").select("row", "id", "label", "v", "dim", F.col("p.positive_id").alias("pids"), F.col("p.ps").alias("ps"))

    def second_look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The scores between which an anchor's negatives lie, by its positives and the sample; anchors whose bands are empty end here."""
        for pdf in batches:
            for dim, g in pdf.groupby("dim"):
                s = spaces.value[dim]
                for i in range(0, len(g), AT_ONCE):
                    a = g.iloc[i : i + AT_ONCE]
                    got, keep = scores(matrix(a["v"]), s.x), []
                    lows, highs = [], []
                    for k, (label, ps) in enumerate(zip(a["label"], a["ps"], strict=True)):
                        band, least = bands(ps, low, high), []
                        for lo, hi in band:
                            at = best(got[k], s.row, (s.label != label) & (got[k] >= lo) & (got[k] <= hi), negatives) if lo <= hi else ()
                            least.append(int(got[k][at[-1]]) if len(at) == negatives else lo)
                        real = [j for j, (lo, hi) in enumerate(band) if lo <= hi]
                        keep.append(bool(real))
                        lows.append(float(min((least[j] for j in real), default=0)))
                        highs.append(float(max((band[j][1] for j in real), default=0)))
                    yield a.assign(least=lows, most=highs)[keep]

    asked = pairs.mapInPandas(second_look, f"{ROW}, pids array<long>, ps array<long>, least double, most double")

    def below(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        got, ids, labels = scores(matrix(a["v"]), matrix(x["v"])), x["id"].to_numpy(), x["label"].to_numpy()
        out = []
        for s, row, anchor, label, pids, ps in zip(got, a["row"], a["id"], a["label"], a["pids"], a["ps"], strict=True):
            other = labels != label
            for k, (lo, hi) in enumerate(bands(ps, low, high)):
                out += [(row, anchor, k, pids[k], ps[k], ids[i], _as_long(s[i])) for i in best(s, ids, other & (s >= lo) & (s <= hi), negatives)] if lo <= hi else []
        return pd.DataFrame(out, columns=["row", "anchor_id", "k", "positive_id", "positive_score", "negative_id", "negative_score"])

    schema = "row long, anchor_id long, k long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = join.meet(join.placed(asked, "least,most", "paired"), "negatives", below, schema)
    order = Window.partitionBy("row", "k").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: The same in DuckDB by all products of anchors with rows.
ORACLE_SQL = """with v as (select row_number() over () as r, vec_id as id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
    where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  s as (select a.r as ar, a.id as anchor_id, c.id, a.label = c.label as same, cast(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
    from v a join v c on a.r <> c.r and len(a.e) = len(c.e) where a.id % 100 = 0),
  p as (select ar, anchor_id, id as positive_id, score as positive_score, row_number() over (partition by ar order by score desc, id) as k from s where same),
  n as (select p.ar, k, p.anchor_id, positive_id, s.id as negative_id, positive_score, score as negative_score, cast(row_number() over (partition by p.ar, k order by score desc, s.id) as integer) as rank
    from p join s on p.ar = s.ar where k <= 5 and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
  select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10"""
