"""The queries of this package and their SQL, for the driver's entry module."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_automaton, cover_tree, funnel, language_id, license_scan, mixing, phrase_index, quality, shingle_join, token_counts, token_store, topk_search, voronoi_join
from .parameters import BYTE_BPE, FUNNELS, PIECES, TARGETS, WORD_BPE, domains


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: F.Column) -> F.Column:
    """Documents whose language is never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_to_targets(_table(spark, sf_dir, "documents"), domains(spark, sf_dir), TARGETS)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.embedding_near_duplicates(_table(spark, sf_dir, "embeddings"), 0.95)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    got = language_id.identify_language(docs, docs.filter(~held_out(F.col("doc_id"))))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.ngram_jaccard_join(_table(spark, sf_dir, "documents"), 4, 85)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.bpe_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk_search.exact_topk(vectors, vectors.filter("vec_id % 20 = 0"), 20, 64.0)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), 0)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_ordered_funnels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.ordered_funnels(_table(spark, sf_dir, "clicks"), FUNNELS)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = vectors.withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return voronoi_join.mine_hard_negatives(moved, "vec_id % 100 = 0")


def queries() -> dict:
    ops = (
        op1_mixing, op2_embedding_dedup, op3_license_scan, op4_language_id, op5_ngram_jaccard, op6_bpe, op7_quality, op8_topk, op9_token_counts, op10_token_files,
        op11_decontamination, op12_ordered_funnels, op13_hard_negatives,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    topk = """with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e from embeddings
        where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
      s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
        from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
      r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
      select query_id, rank, vec_id, score from r where rank <= 20"""
    return {"op3_license_scan": license_scan.oracle_sql(), "op8_topk": topk, "op11_decontamination": phrase_index.ORACLE_SQL, "op12_ordered_funnels": funnel.oracle_sql(FUNNELS), "op13_hard_negatives": voronoi_join.ORACLE_SQL}
