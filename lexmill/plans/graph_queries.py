"""Queries of the graph merger and the same in DuckDB SQL.

Two pipelines give partial graphs: ``catalog``, from ``part`` (its documents are those of the manual-shaped corpus), and ``manual``,
from the section titles of that corpus.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import MergedGraph, merge_graphs
from ..schemas import RELATION_TYPES
from .queries import _SECTIONS, _once

#: The same text runs in Spark and DuckDB; ``array(...)`` is written per engine.
_PARTS = """select 'catalog' as pipeline, p_partkey % 50 as doc_id, concat('p', cast(p_partkey as varchar(20))) as id, 'Component' as type, concat(p_name, ' ', p_brand) as name,
    {aliases} as aliases, (p_partkey % 10) / 10.0 as confidence from part
  union all select distinct 'catalog', p_partkey % 50, concat('b', substring(p_brand, 7)), 'Product', p_brand, {none}, 0.9 from part"""
_VALUES = """select 'catalog' as pipeline, p_partkey % 50 as doc_id, concat('p', cast(p_partkey as varchar(20))) as id, 'size' as attribute, cast(p_size as varchar(20)) as value, (p_partkey % 10) / 10.0 as confidence from part
  union all select 'catalog', p_partkey % 50, concat('p', cast(p_partkey as varchar(20))), 'form', p_type, 0.5 from part
  union all select 'catalog', p_partkey % 50, concat('x', cast(p_partkey as varchar(20))), 'form', p_type, 0.5 from part where p_partkey % 9 = 0"""
_RELATIONS = """select 'catalog' as pipeline, p_partkey % 50 as doc_id, case when p_partkey % 13 = 0 then 'isLike' else 'belongsTo' end as type, concat(case when p_partkey % 17 = 0 then 'q' else 'p' end, cast(p_partkey as varchar(20))) as from_ref,
    case when p_partkey % 11 = 0 then 'b0' else concat('b', substring(p_brand, 7)) end as to_ref, (p_partkey % 4) / 4.0 as confidence from part
  union all select 'catalog', p_partkey % 50, 'precedes', concat('p', cast(p_partkey as varchar(20))), concat('p', cast(p_partkey + 50 as varchar(20))), 0.5 from part"""


def merged(spark: SparkSession, sf_dir: str) -> MergedGraph:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    sql = lambda q: spark.sql(q.replace(" from part", " from {part}"), part=part)
    none = F.array().cast("array<string>")
    entities = spark.sql(
        _PARTS.format(aliases="case when p_partkey % 7 = 0 then array(upper(p_name)) else array() end", none="array()").replace(" from part", " from {part}"), part=part
    )
    drafts = _once(spark, sf_dir).drafts.filter("level = 2")
    titles = F.regexp_replace("title", "^[0-9.]+ ", "")
    sections = drafts.select(F.lit("manual").alias("pipeline"), "doc_id", F.col("section_id").alias("id"), F.lit("Component").alias("type"), titles.alias("name"), none.alias("aliases"), F.lit(0.5).alias("confidence"))
    both = entities.withColumn("confidence", F.col("confidence").cast("double")).withColumn("aliases", F.col("aliases").cast("array<string>")).unionByName(sections)
    return merge_graphs(both, sql(_VALUES), sql(_RELATIONS), RELATION_TYPES)


def _strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("long").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes])


def graph_members(spark, d):
    return _strings(merged(spark, d).members)


def graph_entities(spark, d):
    return merged(spark, d).entities


def graph_aliases(spark, d):
    return merged(spark, d).aliases


def graph_values(spark, d):
    return merged(spark, d).values


def graph_relations(spark, d):
    return merged(spark, d).relations


def graph_sources(spark, d):
    """Distinct documents of each pipeline behind each entity and relation."""
    return merged(spark, d).sources.groupBy("kind", "pipeline", "entity_id", "type", "from_id", "to_id").agg(F.count_distinct("doc_id").alias("n_documents"))


def graph_dangling(spark, d):
    return merged(spark, d).dangling


NAMES = (graph_members, graph_entities, graph_aliases, graph_values, graph_relations, graph_sources, graph_dangling)

_KEY = "array_to_string(list_sort(list_filter(regexp_split_to_array(regexp_replace(lower({0}), '[^0-9a-z]+', ' ', 'g'), ' '), lambda w: w <> '')), ' ')"
_ALLOWED = ", ".join(f"'{t}'" for t in RELATION_TYPES)
_MERGED = f"""{_SECTIONS.replace("with pages_", "with recursive pages_", 1)},
parts as ({_PARTS.format(aliases="case when p_partkey % 7 = 0 then [upper(p_name)] else cast([] as varchar[]) end", none="cast([] as varchar[])")}),
ents as (select distinct pipeline, doc_id, id, type, name, aliases, cast(confidence as double) as confidence from parts
  union all select 'manual', doc_id, section_id, 'Component', regexp_replace(title, '^[0-9.]+ ', ''), cast([] as varchar[]), 0.5 from drafts where level = 2),
noded as (select *, pipeline || '/' || doc_id || '/' || id as node from ents),
keyed as (select distinct node, type, key from (select node, type, {_KEY.format("unnest(list_prepend(name, aliases))")} as key from noded) where key <> ''),
stars as (select distinct k.node as a, f.b, k.type from keyed k join (select type, key, min(node) as b from keyed group by type, key) f on k.type = f.type and k.key = f.key),
walk as (select distinct node as a, node as b, type from noded union select w.a, s.b, w.type from walk w join (select a, b, type from stars union select b, a, type from stars) s on w.b = s.a and w.type = s.type),
clusters as (select a as node, type, min(b) as entity_id from walk group by a, type),
found as (select n.*, c.entity_id from noded n join clusters c using (node, type)),
mems as (select distinct pipeline, doc_id, id, type, entity_id, node from found),
vals as (select distinct pipeline, doc_id, id, attribute, value, cast(confidence as double) as confidence from ({_VALUES})),
valued as (select entity_id, attribute, value, max(confidence) as confidence, count(distinct node) as n_sources from vals join mems using (pipeline, doc_id, id) group by 1, 2, 3),
rels as (select distinct pipeline, doc_id, type, from_ref, to_ref, cast(confidence as double) as confidence from ({_RELATIONS})),
ends_ as (select r.*, f.entity_id as from_id, t.entity_id as to_id from rels r left join mems f on r.pipeline = f.pipeline and r.doc_id = f.doc_id and r.from_ref = f.id left join mems t on r.pipeline = t.pipeline and r.doc_id = t.doc_id and r.to_ref = t.id),
judged as (select *, case when from_id is null then 'no from' when to_id is null then 'no to' when type not in ({_ALLOWED}) then 'type' when from_id = to_id then 'loop' end as problem from ends_)"""


def oracle_sql() -> dict[str, str]:
    return {
        "graph_members": f"{_MERGED} select pipeline, doc_id, id, type, entity_id from mems",
        "graph_entities": f"{_MERGED} select entity_id, type, arg_min(name, (-confidence, name)) as name, max(confidence) as confidence, count(distinct node) as n_members, count(distinct pipeline) as n_pipelines from found group by 1, 2",
        "graph_aliases": f"{_MERGED} select distinct entity_id, type, unnest(list_prepend(name, aliases)) as alias from found",
        "graph_values": f"{_MERGED} select entity_id, attribute, value, confidence, n_sources, count(*) over w as n_values, count(*) over w > 1 as conflict from valued window w as (partition by entity_id, attribute) qualify row_number() over (partition by entity_id, attribute order by confidence desc, n_sources desc, value) = 1",
        "graph_relations": f"{_MERGED} select type, from_id, to_id, max(confidence) as confidence, count(distinct (pipeline, doc_id)) as n_sources from judged where problem is null group by 1, 2, 3",
        "graph_sources": f"""{_MERGED} select 'entity' as kind, pipeline, entity_id, cast(null as varchar) as type, cast(null as varchar) as from_id, cast(null as varchar) as to_id, count(distinct doc_id) as n_documents from mems group by pipeline, entity_id
          union all select 'relation', pipeline, null, type, from_id, to_id, count(distinct doc_id) from judged where problem is null group by pipeline, type, from_id, to_id""",
        "graph_dangling": f"{_MERGED} select pipeline, doc_id, type, from_ref, to_ref, problem from judged where problem is not null",
    }
