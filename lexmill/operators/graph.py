"""Partial graphs of several pipelines merged into one: entities by shared names, values by confidence, everything traced to its source.

Input tables (other columns are ignored):

* ``entities``: ``pipeline, doc_id, id, type, name, aliases array<string>, confidence double``; an id names an entity within its
  pipeline and document;
* ``values``: ``pipeline, doc_id, id, attribute, value, confidence``;
* ``relations``: ``pipeline, doc_id, type, from_ref, to_ref, confidence``, the refs being ids of the same pipeline and document.

Entities of one type are the same if they share a name or alias once both are normalised, directly or through others.  No pair of
entities is listed: each name points to its first entity, and the stars are contracted to components.  What grows with a cluster
(aliases, sources) is a table of rows, never an array, so a name that a third of all entities share does not land in one task.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..scratch import Scratch
from .components import components

NODE = ("pipeline", "doc_id", "id")


def name_key(c: Column) -> Column:
    """A name for comparison: lower case, words of letters and digits only, in alphabetical order; null if nothing is left."""
    words = F.filter(F.split(F.regexp_replace(F.lower(c), "(?U)[^\\w]+|_+", " "), " "), lambda w: w != "")
    key = F.array_join(F.array_sort(words), " ")
    return F.when(key != "", key)


@dataclass(frozen=True)
class MergedGraph:
    """Tables of the merged graph; ``entity_id`` is the smallest ``pipeline/doc_id/id`` of a cluster."""

    members: DataFrame  # pipeline, doc_id, id, type, entity_id
    entities: DataFrame  # entity_id, type, name, confidence, n_members, n_pipelines
    aliases: DataFrame  # entity_id, type, alias
    values: DataFrame  # entity_id, attribute, value, confidence, n_sources, n_values, conflict
    relations: DataFrame  # type, from_id, to_id, confidence, n_sources
    sources: DataFrame  # kind (entity or relation), entity_id or type with from_id and to_id, pipeline, doc_id
    dangling: DataFrame  # pipeline, doc_id, type, from_ref, to_ref, problem
    scratch: Scratch


def node_key(prefix: str = "") -> Column:
    c = lambda n: F.coalesce(F.col(prefix + n).cast("string"), F.lit(""))
    return F.concat_ws("/", c("pipeline"), c("doc_id"), c("id"))


def resolve(entities: DataFrame, scratch: Scratch) -> DataFrame:
    """``pipeline, doc_id, id, type, name, aliases, confidence, node, entity_id``: each distinct entity row with its cluster.

    Rows with a null id are left out.  An id that occurs more than once in its document is one node of each type it has; a null name and no alias
    leave it alone.  The numbers that the contraction works on are arbitrary; ``entity_id`` is the smallest node key of a cluster whatever they are.
    """
    e = entities.select(*NODE, "type", "name", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)).alias("confidence"))
    e = e.filter("id is not null").distinct().withColumn("node", node_key())
    e = scratch.save(e.withColumn("type", F.coalesce("type", F.lit(""))), "nodes")
    nodes = scratch.save(e.select("node", "type").distinct().withColumn("n", F.monotonically_increasing_id()), "numbers")
    named = e.select("node", "type", F.explode(F.array_distinct(F.transform(F.concat(F.array("name"), "aliases"), name_key))).alias("key")).filter("key is not null").distinct()
    named = scratch.save(named.join(nodes, ["node", "type"]).select("n", "type", "key"), "named")
    first = named.groupBy("type", "key").agg(F.min("n").alias("b"))
    edges = named.join(first, ["type", "key"]).filter("n <> b").select(F.col("n").alias("a"), "b").distinct()
    found = components(edges, scratch)
    of = scratch.save(nodes.join(found, nodes["n"] == found["id"], "left").select("node", "type", F.coalesce("component_id", "n").alias("c")), "clusters")
    least = of.groupBy("c").agg(F.min("node").alias("entity_id"))
    return e.join(of.join(least, "c").select("node", "type", "entity_id"), ["node", "type"])


def merge_graphs(entities: DataFrame, values: DataFrame, relations: DataFrame, allowed: tuple[str, ...] = ()) -> MergedGraph:
    """Merge partial graphs.

    * An entity's name is that of its most confident member (ties: the smaller name), its confidence the largest.
    * An attribute's value is the one of the largest confidence; ties go to the value with more sources, then to the smaller one.
      ``conflict`` says whether other values were there.
    * Relations between the same entities are one, with the largest confidence and the number of its sources.
    * ``dangling``: relations with a ref that no entity of their document has (``no from``, ``no to``), a type not in
      ``allowed`` (if given; ``type``), or both ends in one entity (``loop``); they are in no relation.  Values of unknown ids fall out.

    Empty tables give empty tables.  Repeated rows count once.
    """
    scratch = Scratch(entities.sparkSession, "graph")
    e = scratch.save(resolve(entities, scratch), "resolved")
    members = e.select(*NODE, "type", "entity_id").distinct()
    best = F.min_by("name", F.struct(F.col("name").isNull(), -F.col("confidence"), "name"))
    merged = e.groupBy("entity_id", "type").agg(best.alias("name"), F.max("confidence").alias("confidence"), F.count_distinct("node").alias("n_members"), F.count_distinct("pipeline").alias("n_pipelines"))
    aliases = e.select("entity_id", "type", F.explode(F.concat(F.array("name"), "aliases")).alias("alias")).filter("alias is not null").distinct()

    ids = members.select(*NODE, "entity_id").distinct()
    v = values.select(*NODE, "attribute", F.col("value").cast("string").alias("value"), F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)).alias("confidence")).filter("attribute is not null and value is not null").distinct()
    v = v.join(ids, list(NODE)).groupBy("entity_id", "attribute", "value").agg(F.max("confidence").alias("confidence"), F.count_distinct(node_key()).alias("n_sources"))
    order = F.struct(-F.col("confidence"), -F.col("n_sources"), "value")
    chosen = v.groupBy("entity_id", "attribute").agg(F.min_by(F.struct("value", "confidence", "n_sources"), order).alias("x"), F.count(F.lit(1)).alias("n_values"))
    chosen = chosen.select("entity_id", "attribute", "x.*", "n_values", (F.col("n_values") > 1).alias("conflict"))

    r = relations.select("pipeline", "doc_id", "type", "from_ref", "to_ref", F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)).alias("confidence")).distinct()
    one = ids.groupBy(*NODE).agg(F.min("entity_id").alias("entity_id"))  # an id with two types is two entities; refs mean the first
    for end in ("from", "to"):
        r = r.join(one.select("pipeline", "doc_id", F.col("id").alias(f"{end}_ref"), F.col("entity_id").alias(f"{end}_id")), ["pipeline", "doc_id", f"{end}_ref"], "left")
    problem = F.when(F.col("from_id").isNull(), "no from").when(F.col("to_id").isNull(), "no to")
    if allowed:
        problem = problem.when(~F.coalesce(F.col("type").isin(*allowed), F.lit(False)), "type")
    r = scratch.save(r.withColumn("problem", problem.when(F.col("from_id") == F.col("to_id"), "loop")), "relations")
    good = r.filter("problem is null")
    joined = good.groupBy("type", "from_id", "to_id").agg(F.max("confidence").alias("confidence"), F.count_distinct("pipeline", F.col("doc_id").cast("string")).alias("n_sources"))
    none = F.lit(None).cast("string")
    traced = members.select(F.lit("entity").alias("kind"), "entity_id", none.alias("type"), none.alias("from_id"), none.alias("to_id"), "pipeline", "doc_id")
    traced = traced.unionByName(good.select(F.lit("relation").alias("kind"), none.alias("entity_id"), "type", "from_id", "to_id", "pipeline", "doc_id")).distinct()
    return MergedGraph(members, merged, aliases, chosen, joined, traced, r.filter("problem is not null").select("pipeline", "doc_id", "type", "from_ref", "to_ref", "problem"), scratch)
