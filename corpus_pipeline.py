"""A document pipeline: quality, language, near duplicates, mixing, token ids."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import bpe_automaton, language_id, mixing, quality, shingle_join
from lexmill.llm.parameters import TARGETS, WORD_BPE, domains
from lexmill.llm.scratch import Scratch

COLUMNS = ("text", "lang", "source", "n_chars")
#: A text has a clear language if that language's regression value is nearer to that of its own texts than to that of others, or,
#: as a short text is like no landmark, if the language's landmarks hold nearly all its n-grams.  Neither depends on the other languages.
LEAST_MARGIN, LEAST_KNOWN = 0.0, 0.9


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer trained on weak labels keeps; null and wordless texts go, null and repeated ids make no difference."""
    return quality.score_quality(docs, list(COLUMNS)).filter("kept").select("doc_id", *COLUMNS)


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the table names; texts without a letter go, rows are judged by their text alone."""
    got = language_id.identify_language(docs, docs, list(COLUMNS), margins=True)
    clear = (F.col("margin") >= LEAST_MARGIN) | (F.col("known") >= LEAST_KNOWN)
    return got.filter((F.col("lang_pred") != language_id.UNKNOWN) & clear).select("doc_id", *COLUMNS)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8), that of the smallest id; rows that repeat an id or have none are copies like others."""
    return shingle_join.one_of_each(docs.select("doc_id", *COLUMNS), 5, 80)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says; the fraction is drawn by a hash of id and text, so rows without an id are drawn apart."""
    rates = mixing.mix_to_targets(docs, domains(spark, sf_dir), TARGETS, carry=COLUMNS).select("doc_id", *COLUMNS, "rate")
    rates = Scratch(spark, "pipeline").save(rates, "rates")  # else the filter below would work out every rate again
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    times = F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")
    taken = rates.withColumn("times", times).filter("times > 0")
    return taken.withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("doc_id", *COLUMNS)


def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with their number and the hashes of ids and decoded text; a null text has none."""
    return bpe_automaton.bpe_round_trip(docs, public_tokenizers.path(WORD_BPE), keep_ids=True)


STAGES = [("quality", _quality), ("language", _language), ("near duplicates", _near_duplicates), ("mixing", _mixing), ("bpe", _encode)]

ORACLE_SQL = None  # trained models, graph components and tokenizer automata are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; a stage's table goes once the next one's is written.

    Null texts, repeated rows and rows without an id are treated as the stages say: null and wordless texts go with the first, exact
    copies leave one row, and nothing depends on an id being there.  An empty table gives an empty result.
    """
    scratch = Scratch(spark, "stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), str(k))
        if k:
            scratch.drop(str(k - 1))
    return docs
