"""Documents as they arrive: an extension of the batch plan, labelled as such."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import RuleConfig
from ..plans.pipeline import SymbolicPlan


def structure_stream(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, cfg: RuleConfig | None = None, to_pages: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Structure new Parquet files of whole documents, batch by batch, into a table of sections under ``out``.

    A document must arrive whole, so no state crosses batches; a batch that is run again overwrites its own folder.
    """
    def batch(df: DataFrame, number: int) -> None:
        plan = SymbolicPlan(to_pages(df), cfg or RuleConfig())
        plan.sections.write.mode("overwrite").parquet(f"{out}/batch={number}")
        plan.release()

    return spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
