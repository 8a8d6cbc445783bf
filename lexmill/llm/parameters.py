"""Parameters that the queries and the pipeline share."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .funnel import Funnel

#: Vocabulary files, by their names in the tokenizers' folder.
WORD_BPE, BYTE_BPE, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Target weights of the domains that ``labels`` names; domains without documents fall out.
TARGETS = {"good": 0.90, "toxic": 0.04, "low": 0.06}

#: Ordered kinds of ``clicks``, and the kind that ends an attempt.
FUNNELS = (
    Funnel("A", ("view", "click", "view", "purchase"), "error"),
    Funnel("B", ("signup", "view", "click", "purchase"), "error"),
    Funnel("C", ("click", "click", "purchase", "view"), "signup"),
)


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` as (doc_id, domain)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.select("doc_id", F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").alias("domain"))
