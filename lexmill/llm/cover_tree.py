"""Exact cosine links between embeddings by dual traversal of a cover tree.

Vectors are scaled to length 1, where ``cosine >= t`` says ``distance <= sqrt(2 - 2t)``.  The tree is one for each vector
length and grows with the table: a node of more than a block of vectors is split among centres taken farthest first from a
bounded sample of it, until their radius is half the node's or there are ``FANOUT``; each row goes to its nearest centre.
Levels, centres and radii are tables, never the driver's.  Node pairs then descend from the root, and a pair is dropped when
its centres are farther apart than both covering radii and the link distance.  The vectors are written once, a file for each group of
leaves, and a task that meets two groups reads their files from the shared folder, so that no row is sent to the leaves it meets.
Of a pair of leaves, rows are compared by short heads whose products bound the cosines from above; those that stay open are worked out in full.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch, read_in_task

FANOUT, SAMPLE, BLOCK = 32, 512, 4096  # centres of a node, rows they are chosen from, vectors of a leaf
FINE = 256  # fine centres of a leaf at most
GROUP = 16 << 20  # bytes of unit vectors that a group of leaves has, of which a task holds two
SLICE = 8 << 20  # bytes of packed vectors that a task takes down the tree at once
HEAD, TILE = 20, (256, 2048)  # coordinates that are compared first, and how many rows with how many
EDGES = 1 << 20  # links that a task holds before it joins them
SLICES, NEAR = 8, 64  # nothing reads these; tests set them
SLACK = 1e-6  # bounds are computed in double precision; the slack keeps pairs that rounding would lose


def farthest_first(distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which each point is as far as can be from those before it, and those distances."""
    n = len(distance)
    order, insertion = np.zeros(n, np.int64), np.zeros(n)
    near = distance[0].copy()
    insertion[0] = np.inf
    for i in range(1, n):
        order[i] = k = int(near.argmax())
        insertion[i] = near[k]
        np.minimum(near, distance[k], out=near)
    return order, insertion


def farthest_prefix(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``most`` of a farthest-first order of unit vectors, then the others with distance 0, without all distances at once."""
    order, insertion = [0], np.zeros(len(x))
    near, insertion[0] = _gaps(x @ x[0]), np.inf
    near[0] = 0
    while len(order) < min(most, len(x)):
        k = int(near.argmax())
        if near[k] == 0:
            break
        insertion[len(order)] = near[k]
        order.append(k)
        np.minimum(near, _gaps(x @ x[k]), out=near)
        near[k] = 0
    rest = np.ones(len(x), bool)
    rest[order] = False
    return np.concatenate([order, np.flatnonzero(rest)]).astype(np.int64), insertion


class Tree:
    """Nested levels over unit vectors ``x`` (already in farthest-first order).

    ``sizes[l]``: the first so many points are the centres of level l; ``parent[l]``: for each centre of level
    l + 1 its centre in level l; ``radius[l]``: for each centre of level l the largest distance to a descendant.
    The last level holds all points.
    """

    def __init__(self, x: np.ndarray, sizes: list[int]):
        self.x, self.sizes = x, sizes
        self.parent, self.radius = [], []
        anc = np.arange(len(x))
        self.radius.append(np.zeros(len(x)))
        for m_down, m_up in zip(sizes[:0:-1], sizes[-2::-1], strict=True):
            up = (x[:m_down] @ x[:m_up].T).argmax(1)
            up[:m_up] = np.arange(m_up)
            anc = up[anc]
            gap = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", x, x[anc])))
            r = np.zeros(m_up)
            np.maximum.at(r, anc, gap)
            self.parent.insert(0, up)
            self.radius.insert(0, r)


def level_sizes(insertion: np.ndarray, stop: float) -> list[int]:
    """Level sizes for radii that halve from the first covering radius down to ``stop``; then all points."""
    n, sizes = len(insertion), [1]
    r = insertion[1] / 2 if n > 1 else 0
    while r > stop and sizes[-1] < n:
        m = int(np.searchsorted(-insertion, -r, side="left"))
        if m > 1.3 * sizes[-1]:
            sizes.append(m)
        r /= 2
    return sizes if sizes[-1] == n else [*sizes, n]


def dual_links(p: Tree, q: Tree, threshold: float):
    """Pairs ``(i, j)`` of the trees' points with cosine >= threshold, in chunks, by dual traversal."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    lp = lq = 0
    alive = np.ones((1, 1), bool)
    while (lp, lq) != (len(p.sizes) - 1, len(q.sizes) - 1):
        down_p = lp < len(p.sizes) - 1 and (lq == len(q.sizes) - 1 or p.sizes[lp] <= q.sizes[lq])
        if down_p:
            alive, lp = alive[p.parent[lp]], lp + 1
        else:
            alive, lq = alive[:, q.parent[lq]], lq + 1
        if lp == len(p.sizes) - 1 and lq == len(q.sizes) - 1:
            break
        rows, cols = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(rows):
            return
        gap = _gaps(p.x[rows] @ q.x[cols].T)
        alive[np.ix_(rows, cols)] &= gap <= p.radius[lp][rows][:, None] + q.radius[lq][cols][None, :] + reach
    for at in range(0, len(p.x), 512):
        part = alive[at : at + 512]
        rows, cols = np.flatnonzero(part.any(1)), np.flatnonzero(part.any(0))
        if len(rows):
            i, j = np.nonzero(((p.x[at + rows] @ q.x[cols].T) >= threshold) & part[np.ix_(rows, cols)])
            if len(i):
                yield at + rows[i], cols[j]


def _labels(n: int, i: np.ndarray, j: np.ndarray, lab: np.ndarray) -> np.ndarray:
    """Smallest label over the components that the edges (i, j) add."""
    while len(i):
        low = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, lab[i], low)
        np.minimum.at(new, lab[j], low)
        new = new[new]
        if (new == lab).all():
            break
        lab = new
    return lab


def _unit(raw) -> np.ndarray:
    x = np.array(raw, np.float64)
    x /= np.abs(x).max(1)[:, None]  # so that squares neither overflow nor vanish
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def usable(column) -> F.Column:
    """Whether a vector can link: not null, no null or non-finite component, not all zeros."""
    finite = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(column.isNotNull() & finite & F.exists(column, lambda v: v != 0), F.lit(False))


def _pack(rows) -> list[bytes]:
    """Vectors as bytes: single precision where that loses nothing, else double."""
    out = []
    for v in rows:
        x = np.asarray(v, np.float64) + 0.0  # no negative zero
        with np.errstate(over="ignore"):
            y = x.astype(np.float32)
        out.append((y if (y == x).all() else x).tobytes())
    return out


def _units(packed, dim: int) -> np.ndarray:
    return _unit([np.frombuffer(b, np.float32 if len(b) == 4 * dim else np.float64) for b in packed])


def _dim(node: str) -> int:
    return int(node.partition("/")[0].partition("#")[0])


def _gaps(dot: np.ndarray) -> np.ndarray:
    """Distances of unit vectors by their inner products, written over these."""
    dot *= -2
    dot += 2
    return np.sqrt(np.maximum(dot, 0, out=dot), out=dot)


class Descent:
    """The centres of the tree's first levels, read by a task from the shared folder; rows go down to the nearest ones."""

    def __init__(self, root: str, levels: int):
        self.below: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for level in range(1, levels + 1):
            t = read_in_task(f"{root}/centres{level}", ["node", "parent", "x"]).to_pandas()
            for parent, g in t.groupby("parent"):
                g = g.iloc[np.argsort([int(name.rpartition("/")[2]) for name in g["node"]])]
                self.below[parent] = g["node"].to_numpy(object), _units(g["x"], _dim(parent))

    def places(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each row's last node, and by level its distance to its node there (NaN below its last node)."""
        n, root = len(x), str(x.shape[1])
        nodes, gaps, live = np.full(n, root, object), [np.full(n, 2.0)], {root: np.arange(n)}  # any unit vector is within 2 of a root's rows
        while live := {node: rows for node, rows in live.items() if node in self.below}:
            gap, then = np.full(n, np.nan), {}
            for node, rows in live.items():
                names, centres = self.below[node]
                dot = x[rows] @ centres.T
                nearest = dot.argmax(1)
                nodes[rows], gap[rows] = names[nearest], _gaps(dot.max(1))
                then |= {names[k]: rows[nearest == k] for k in np.unique(nearest)}
            gaps.append(gap)
            live = then
        return nodes, gaps


def _slices(batches):
    """Rows of ``points`` as (Arrow table, unit vectors), of one vector length and about ``SLICE`` bytes."""
    held, size = [], 0

    def parts():
        t = pa.Table.from_batches(held)
        dims = t["dim"].to_numpy()
        for dim in np.unique(dims):
            some = t if (dims == dim).all() else t.filter(pa.array(dims == dim))
            yield some, _matrix(some["x"], int(dim))

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SLICE:
            yield from parts()
            held, size = [], 0
    if size:
        yield from parts()


def _matrix(packed: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Packed vectors of one length as unit vectors."""
    if not len(packed):
        return np.zeros((0, dim))
    cells = pa.concat_arrays(packed.cast(pa.large_binary()).chunks)
    _, ends, data = cells.buffers()
    at = np.frombuffer(ends, np.int64, len(cells) + 1, 8 * cells.offset)
    if (np.diff(at) == 4 * dim).all():
        return _unit(np.frombuffer(data, np.float32, len(cells) * dim, int(at[0])).reshape(-1, dim))
    return _units(cells.to_pylist(), dim)


def _grow(points: DataFrame, scratch: Scratch, block: int, reach: float) -> tuple[DataFrame, int]:
    """The tree over ``points(vec_id, dim, key, x)``: its nodes, and the number of its levels below the root.

    Nodes are (level, node, parent, n, r, least, x, c, leaf): ``x`` the packed centre, ``c`` the centre at length 1, ``r`` the radius, and
    ``leaf`` how many leaves the node is (0 for inner nodes).  A node that no centre can divide, since all its vectors
    lie within the link distance of each other or a split made it hardly smaller, is several leaves by hash with one centre.
    No vector is sent or written again for a level: tasks read the centres and take each row down from the root.
    """
    root = scratch.root

    def seen(level: int):
        def run(batches):
            tree = Descent(root, level)
            for t, x in _slices(batches):
                nodes, gaps = tree.places(x)
                if len(gaps) > level and (at := ~np.isnan(gaps[level])).any():
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[at], pa.string()), pa.array(gaps[level][at]), t["key"].filter(pa.array(at)).combine_chunks()], names=["node", "gap", "key"])

        return run

    def sampled(level: int):
        def run(batches):
            tree = Descent(root, level)
            inner = read_in_task(f"{root}/nodes{level}", ["node", "n", "r", "least", "leaf"]).to_pandas()
            inner = inner[inner["leaf"] == 0].set_index("node")
            for t, x in _slices(batches):
                nodes, keys = tree.places(x)[0], t["key"].to_pylist()
                own = inner.reindex(nodes)
                n = own["n"].fillna(0).to_numpy(np.int64)
                draw = np.frombuffer(b"".join(keys), "<u8")[::2] % np.maximum(n, 1).astype(np.uint64)
                take = np.flatnonzero((n > 0) & ((draw < SAMPLE) | (own["least"].to_numpy(object) == np.array([*keys, None], object)[:-1])))
                if len(take):
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[take], pa.string()), pa.array(n[take]), pa.array(own["r"].to_numpy(np.float64)[take]), *[t[c].take(pa.array(take)).combine_chunks() for c in ("key", "x")]], names=["node", "n", "r", "key", "x"])

        return run

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        node, n = pdf["node"].iloc[0], int(pdf["n"].iloc[0])
        pdf = pdf.sort_values("key")
        x = _units(pdf["x"], _dim(node))
        order, insertion = farthest_first(_gaps(x @ x.T))
        half = int(np.searchsorted(-insertion, -insertion[1:2].sum() / 2))  # centres that cover the sample with half its radius
        order = order[: max(2, min(FANOUT, half, -(-2 * n // block)))]
        return pd.DataFrame({"node": [f"{node}/{i}" for i in range(len(order))], "parent": node, "was": n, "was_r": pdf["r"].iloc[0], "x": pdf["x"].iloc[order].to_list(), "c": [x[i] for i in order]})

    level, tree, centres = 0, None, None
    while True:
        # equal vectors count once, about
        nodes = points.mapInArrow(seen(level), "node string, gap double, key binary").groupBy("node").agg(F.approx_count_distinct("key", 0.02).alias("n"), F.max("gap").alias("r"), F.min("key").alias("least"))
        if level:
            nodes = centres.join(nodes, "node", "left").na.fill(0, ["n", "r"])
        else:
            nodes = nodes.withColumns({"parent": F.lit(None).cast("string"), "was": F.lit(None).cast("long"), "was_r": F.lit(None).cast("double"), "x": F.lit(None).cast("binary"), "c": F.lit(None).cast("array<double>")})
        stuck = (F.col("r") <= reach / 2) | F.coalesce((F.col("n") > 0.75 * F.col("was")) & (F.col("r") > 0.6 * F.col("was_r")), F.lit(False))
        nodes = nodes.withColumn("leaf", F.when((F.col("n") <= block) | stuck, F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("int")).otherwise(0))
        nodes = nodes.select(F.lit(level).alias("level"), "node", "parent", "n", "r", "least", "x", "c", "leaf")
        nodes, told = scratch.save_and_tell(nodes, f"nodes{level}", F.count(F.when(F.col("leaf") == 0, 1)).alias("inner"))
        tree = nodes if tree is None else tree.union(nodes)
        if not told["inner"]:
            return tree, level
        sample = points.mapInArrow(sampled(level), "node string, n long, r double, key binary, x binary").dropDuplicates(["node", "key"])
        centres = sample.groupBy("node").applyInPandas(choose, "node string, parent string, was long, was_r double, x binary, c array<double>")
        centres, level = scratch.save(centres, f"centres{level + 1}"), level + 1


def _leaves(tree: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """The leaves ``leaf long, node, part, parts, dim, g`` with the group that is their file, and the number of groups."""
    ends = tree.join(tree.select(F.col("parent").alias("node")).distinct(), "node", "left_anti").withColumn("parts", F.greatest(F.lit(1), "leaf"))
    dim = F.substring_index("node", "/", 1).cast("int")
    parts = ends.select("node", "n", "parts", dim.alias("dim"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    cost = F.greatest(F.col("n") / F.col("parts") * F.col("dim") * 8, F.lit(GROUP / 64))  # so that a group has at most 64 leaves
    every = Window.partitionBy("dim")
    row = every.orderBy("node", "part")
    parts = parts.withColumn("cost", cost).withColumns({"before": F.sum("cost").over(row) - F.col("cost"), "all": F.sum("cost").over(every)})
    g = F.concat_ws("-", "dim", F.floor(F.col("before") / F.least(F.lit(float(GROUP)), F.col("all") / 8)).cast("string"))
    leaves = parts.select(F.row_number().over(Window.orderBy("dim", "node", "part")).cast("long").alias("leaf"), "node", "part", "parts", "dim", g.alias("g"))
    leaves, told = scratch.save_and_tell(leaves, "leaves", F.max("leaf").alias("last"))
    return leaves, leaves.select("g").distinct().count()


def _blocks(points: DataFrame, leaves: DataFrame, n_groups: int, levels: int, scratch: Scratch, reach: float) -> DataFrame:
    """Every different vector once, a file for each group: ``rep, key, id_, w, leaf, pos, f, x``, and ``gap0`` ... the distances to its nodes.

    This is the one time that vectors are sent.  Of a leaf the first rows are its fine centres, by ``pos``; ``f`` is the nearest of them.
    """
    root = scratch.root
    far = [f"gap{level}" for level in range(levels + 1)]
    sent = "g string, leaf long, dim int, key binary, id_ long, w long, x binary, " + ", ".join(f"{c} double" for c in far)

    def assign(batches):
        tree = Descent(root, levels)
        t = read_in_task(f"{root}/leaves", ["leaf", "node", "part", "parts", "g"]).to_pandas()
        number = {(node, part): (leaf, g) for node, part, leaf, g in zip(t["node"], t["part"], t["leaf"], t["g"], strict=True)}
        parts = dict(zip(t["node"], t["parts"], strict=True))
        for t, x in _slices(batches):
            nodes, gaps = tree.places(x)
            keys = t["key"].to_pylist()
            own = [number[node, int.from_bytes(key[8:], "little") % parts[node]] for node, key in zip(nodes, keys, strict=True)]
            ids = pd.DataFrame({"key": keys, "leaf": [k for k, _ in own], "id_": t["vec_id"].to_numpy()}).reset_index(names="i")
            ids = ids.groupby(["key", "leaf"], sort=False).agg(i=("i", "first"), id_=("id_", "min"), w=("i", "size"))
            i = ids["i"].to_numpy()
            gaps += [np.full(len(x), np.nan)] * (len(far) - len(gaps))
            cols = [pa.array([own[k][1] for k in i], pa.string()), pa.array([own[k][0] for k in i], pa.int64()), *[t[c].take(pa.array(i)).combine_chunks() for c in ("dim", "key")], pa.array(ids["id_"].to_numpy(np.int64)), pa.array(ids["w"].to_numpy(np.int64)), t["x"].take(pa.array(i)).combine_chunks()]
            yield pa.RecordBatch.from_arrays([*cols, *[pa.array(gap[i], mask=np.isnan(gap[i])) for gap in gaps]], names=["g", "leaf", "dim", "key", "id_", "w", "x", *far])

    def divide(batches):
        """Rows sorted by leaf and key: one for each vector, in the order of the leaf's fine centres."""

        def done(held):
            pdf = pd.concat(held, ignore_index=True)
            same = pdf.groupby("key", sort=False)
            pdf = pdf.drop_duplicates("key").assign(id_=same["id_"].min().to_numpy(), w=same["w"].sum().to_numpy())
            x = _units(pdf["x"], int(pdf["dim"].iloc[0]))
            order, insertion = farthest_prefix(x, FINE)
            m = max(1, int((insertion > reach).sum()))
            x = x[order]
            return pdf.iloc[order].assign(pos=np.arange(len(x)), f=(x @ x[:m].T).argmax(1)).drop(columns="dim")

        leaf, held = None, []
        for pdf in batches:
            same = pdf.groupby(["leaf", "key"], sort=False)
            pdf = pdf.drop_duplicates(["leaf", "key"]).assign(id_=same["id_"].min().to_numpy(), w=same["w"].sum().to_numpy())  # copies never pile up
            for k, g in pdf.groupby("leaf", sort=False):
                if k != leaf and held:
                    yield done(held)
                    held = []
                leaf = k
                held.append(g)
        if held:
            yield done(held)

    moved = points.mapInArrow(assign, sent).repartition(max(1, min(n_groups, 20_000)), "g").sortWithinPartitions("g", "leaf", "key")
    kept = "g string, leaf long, key binary, id_ long, w long, x binary, " + ", ".join(f"{c} double" for c in far) + ", pos int, f int"
    return scratch.save(moved.mapInPandas(divide, kept).withColumn("rep", F.monotonically_increasing_id()), "blocks", "g")  # written, so the numbers stay


def _radii(blocks: DataFrame, leaves: DataFrame, levels: int) -> DataFrame:
    """``node, r`` by the rows as they were written: a row as near to two centres may go either way each time it is taken down."""
    per = blocks.groupBy("leaf").agg(*[F.max(f"gap{k}").alias(f"gap{k}") for k in range(levels + 1)]).join(leaves.select("leaf", "node"), "leaf")
    each = F.explode(F.array(*[F.struct(F.substring_index("node", "/", k + 1).alias("node"), F.col(f"gap{k}").alias("r")) for k in range(levels + 1)]))
    return per.select(each.alias("x")).select("x.*").filter("r is not null").groupBy("node").agg(F.max("r").alias("r"))


def _near_leaves(tree: DataFrame, leaves: DataFrame, scratch: Scratch, reach: float) -> tuple[DataFrame, int]:
    """Pairs of groups ``ga, gb`` with their pairs of leaves within reach, ``la, lb array<long>`` (of a leaf with itself too), and how many."""
    cols = ["node", "r", "c", "leaf"]
    side = lambda df, up, k: df.select(F.col("parent").alias(up), *[F.col(c).alias(f"{c}{k}") for c in cols])
    depth = tree.agg(F.max("level")).first()[0]
    pairs, ended = tree.filter("level = 0").select(F.col("node").alias("a"), F.col("node").alias("b")), None
    for level in range((depth or 0) + 1):
        # a node's heirs are its children, or itself if it is a leaf
        heirs = tree.filter((F.col("level") == level + 1)).select("parent", *cols).union(tree.filter((F.col("level") <= level) & (F.col("leaf") > 0)).select(F.col("node").alias("parent"), *cols))
        got = pairs.join(side(heirs, "a", 1), "a").join(side(heirs, "b", 2), "b")
        dot = F.aggregate(F.zip_with("c1", "c2", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        gap = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot))
        close = (F.col("node1") == F.col("node2")) | (gap <= F.col("r1") + F.col("r2") + reach)
        got = got.filter((F.col("a") != F.col("b")) | (F.col("node1") <= F.col("node2"))).filter(close)
        got = scratch.save(got.select(F.col("node1").alias("a"), F.col("node2").alias("b"), ((F.col("leaf1") > 0) & (F.col("leaf2") > 0)).alias("end")), f"pairs{level}")
        last = got.filter("end")
        ended = last if ended is None else ended.union(last)
        pairs = got.filter("not end").select("a", "b")
    own = lambda up, k: leaves.select(F.col("node").alias(up), F.struct("g", "leaf").alias(k))
    parts = ended.join(own("a", "p"), "a").join(own("b", "q"), "b").filter("a <> b or p.leaf <= q.leaf")
    parts = parts.select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"))
    met = parts.groupBy(F.col("p.g").alias("ga"), F.col("q.g").alias("gb")).agg(F.collect_list(F.struct(F.col("p.leaf").alias("a"), F.col("q.leaf").alias("b"))).alias("l"))  # at most 64 times 64
    met, told = scratch.save_and_tell(met.select("ga", "gb", F.col("l.a").alias("la"), F.col("l.b").alias("lb")), "pairs")
    return met, told["n"]


def _heads(x: np.ndarray) -> np.ndarray:
    """Unit vectors whose products bound those of ``x`` from above: ``HEAD`` coordinates of a fixed turn of ``x``, and the length of the rest."""
    dim = x.shape[1]
    if dim <= HEAD + 1:
        return x.astype(np.float32)
    turn, _ = np.linalg.qr(np.random.default_rng(11).normal(size=(dim, HEAD)))
    h = x @ turn
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", h, h)))
    return np.concatenate([h, rest[:, None]], 1).astype(np.float32)


class Group:
    """The leaves of a group, read by a task from its file."""

    def __init__(self, path: str, dim: int):
        t = read_in_task(path, ["leaf", "pos", "f", "rep", "w", "x"])
        t = t.take(pa.array(np.lexsort((t["pos"].to_numpy(), t["leaf"].to_numpy()))))
        self.x, self.f = _matrix(t["x"], dim), t["f"].to_numpy()
        self.ids, self.ws, self.head = t["rep"].to_numpy(), t["w"].to_numpy(), _heads(self.x)
        leaf, first = np.unique(t["leaf"].to_numpy(), return_index=True)
        self.leaves = {k: self._fine(a, b) for k, a, b in zip(leaf.tolist(), first, [*first[1:], len(t)], strict=True)}

    def _fine(self, a: int, b: int) -> tuple[int, int, np.ndarray]:
        """Where a leaf's rows are, and the radii of its fine centres, its first rows."""
        f = self.f[a:b]
        r = np.zeros(f.max() + 1)
        np.maximum.at(r, f, _gaps(np.einsum("ij,ij->i", self.x[a:b], self.x[a + f])))
        return a, b, r


def _links(p: Group, a: int, q: Group, b: int, threshold: float):
    """Pairs of rows of the leaves ``a`` of ``p`` and ``b`` of ``q`` with cosine >= threshold, in chunks.

    Rows whose fine nodes have no other within reach are left out; of the others the heads are compared, and what these leave open is worked out in full.
    """
    if a not in p.leaves or b not in q.leaves:  # no row has this hash
        return
    (a0, a1, ra), (b0, b1, rb) = p.leaves[a], q.leaves[b]
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    near = _gaps(p.x[a0 : a0 + len(ra)] @ q.x[b0 : b0 + len(rb)].T) <= ra[:, None] + rb[None, :] + reach
    rows, cols = a0 + np.flatnonzero(near.any(1)[p.f[a0:a1]]), b0 + np.flatnonzero(near.any(0)[q.f[b0:b1]])
    same, low = p is q and a == b, np.float32(threshold - 1e-5)
    for c in range(0, len(cols), TILE[1]):
        some = cols[c : c + TILE[1]]
        right = np.ascontiguousarray(q.head[some].T)
        for at in range(0, len(rows), TILE[0]):
            part = rows[at : at + TILE[0]]
            if same and part[0] >= some[-1]:
                continue
            dot = p.head[part] @ right
            hot = np.flatnonzero(dot.max(1) >= low)
            if not len(hot):
                continue
            i, j = np.nonzero(dot[hot] >= low)
            i, j = part[hot[i]], some[j]
            if len(i) > dot.size // 16:  # a crowd
                i, j = np.unique(i), np.unique(j)
                u, v = np.nonzero(p.x[i] @ q.x[j].T >= threshold)
                i, j = i[u], j[v]
            else:
                ok = np.einsum("ij,ij->i", p.x[i], q.x[j]) >= threshold
                i, j = i[ok], j[ok]
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j


def _linked(p: Group, q: Group, pairs, threshold: float) -> pd.DataFrame:
    """The linked rows of two groups (or of one with itself): how many rows each links to, and the smallest id of its forest."""
    ids, ws, shift = (p.ids, p.ws, 0) if p is q else (np.concatenate([p.ids, q.ids]), np.concatenate([p.ws, q.ws]), len(p.ids))
    degree, lab, rank = np.zeros(len(ids), np.int64), np.arange(len(ids)), np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[rank] = np.arange(len(ids))  # labels are ranks by id, so the smallest label is the smallest id
    edges, held = [], 0
    for a, b in pairs:
        for i, j in _links(p, a, q, b, threshold):
            j = j + shift
            np.add.at(degree, i, ws[j])
            np.add.at(degree, j, ws[i])
            edges.append((place[i], place[j]))
            held += len(i)
            if held >= EDGES:
                lab, edges, held = _labels(len(ids), *map(np.concatenate, zip(*edges, strict=True)), lab), [], 0
    if edges:
        lab = _labels(len(ids), *map(np.concatenate, zip(*edges, strict=True)), lab)
    hit = np.flatnonzero(degree)
    return pd.DataFrame({"rep": ids[hit], "n": degree[hit], "root": ids[rank[lab[place[hit]]]]})


def embedding_near_duplicates(embeddings: DataFrame, threshold: float = 0.95, block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per vector its number of links, its component and whether it is the component's smallest id.

    Returns ``vec_id, n_links long, component_id long, kept boolean``, a row for each input row.  Unusable vectors
    (null, zero, with a null or non-finite component) link with nothing; vectors of unlike lengths neither.  A null
    id gives 0 links and a null component; rows that repeat an id, with its vector or another, count as vectors of their own,
    each with its own links; ``kept`` is then true of each row whose id is its component's.
    Other columns are ignored.  Equal vectors are one tree point with a weight; of two groups of leaves only
    degrees and a spanning forest leave the task, so a dense group never becomes its list of pairs.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "covertree")
    root = scratch.root
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    good = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))

    def pack(batches):
        for pdf in batches:
            x = _pack(pdf["v"])
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "dim": [len(v) for v in pdf["v"]], "key": [hashlib.blake2b(b, digest_size=16).digest() for b in x], "x": x})

    points = scratch.save(good.mapInPandas(pack, "vec_id long, dim int, key binary, x binary"), "points")
    tree, levels = _grow(points, scratch, block, reach)
    leaves, n_groups = _leaves(tree, scratch)
    blocks = _blocks(points, leaves, n_groups, levels, scratch, reach)
    ends = leaves.groupBy("node").agg(F.first("parts").alias("parts"))
    tree = tree.drop("r", "leaf").join(_radii(blocks, leaves, levels), "node").join(ends, "node", "left").withColumn("leaf", F.coalesce("parts", F.lit(0)))
    pairs, n_pairs = _near_leaves(scratch.save(tree, "tree"), leaves, scratch, reach)

    def visit(batches):
        held = (None, None)
        for pdf in batches:
            for ga, gb, la, lb in zip(pdf["ga"], pdf["gb"], pdf["la"], pdf["lb"], strict=True):
                dim = int(ga.partition("-")[0])
                if held[0] != ga:
                    held = (ga, None)  # so that the last one goes first
                    held = (ga, Group(f"{root}/blocks/g={ga}", dim))
                yield _linked(held[1], held[1] if ga == gb else Group(f"{root}/blocks/g={gb}", dim), zip(la.tolist(), lb.tolist(), strict=True), threshold)

    met = pairs.repartition(max(1, min(n_pairs, 20_000)), "ga", "gb").sortWithinPartitions("ga", "gb")
    found = scratch.save(met.mapInPandas(visit, "rep long, n long, root long"), "found")
    comps = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
    classes = blocks.select("rep", "key", "id_", "w").join(found.groupBy("rep").agg(F.sum("n").alias("n")), "rep", "left").join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    classes = scratch.save(classes.withColumn("c", F.coalesce("component_id", "rep")).drop("component_id"), "linked")
    least = classes.groupBy("c").agg(F.min("id_").alias("component_id"))
    # copies that went to two leaves are linked, so each counts all of them
    known = classes.join(least, "c").groupBy("key").agg(F.max(F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.min("component_id").alias("component_id"))
    linked = points.select("vec_id", "key").join(known, "key", "left").select("vec_id", "n_links", "component_id")
    rest = rows.filter(~(F.col("vec_id").isNotNull() & usable(F.col("v")))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.union(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
