"""Connected components by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def _least(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges both ways, and the smallest neighbour of each node (itself included)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def _down(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both, least = _least(edges)
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """``edges(a long, b long)`` to ``(id, component_id)`` for every node with an edge to another.

    ``component_id`` is the smallest id that links reach.  Self loops, repeated edges and nulls are
    ignored.  Each round is written to the shared folder, so a lost executor repeats one round at most.
    Rounds stop when the star forest repeats (a number of rounds logarithmic in the longest path).
    """
    save = lambda df, k: scratch.save_and_tell(df, f"{name}{k}", F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark"))
    (now, was), k = save(_down(edges), 0), 0
    while was["n"]:
        k += 1
        new, is_ = save(_small_star(_large_star(now)), k)
        scratch.drop(f"{name}{k - 1}")
        now = new
        if is_ == was:
            break
        was = is_
    ids = now.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    return ids.union(ids.select("component_id", "component_id").distinct())
