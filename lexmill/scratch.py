"""Tables written in the folder that the driver and all executors share."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where that is unset and all runs on this machine (tests)."""
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        set_to = tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", set_to)
    return set_to


def read_in_task(path: str, columns: list[str]):
    """A written table, or the folder of one of its partitions, as Arrow, read by a task itself."""
    import pyarrow as pa
    from pyarrow import fs, parquet

    system, inner = fs.FileSystem.from_uri(path) if ":" in path.partition("/")[0] else (fs.LocalFileSystem(), path)
    files = sorted(f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.base_name.endswith(".parquet"))
    return pa.concat_tables([parquet.ParquetFile(system.open_input_file(f)).read(columns, use_threads=False) for f in files])


class Scratch:
    """Writes intermediate tables to the shared folder, which also cuts their lineage.

    Later reads of a result still need its tables, so they go when the driver's JVM ends, unless they are dropped before.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root, self.marked = f"{shared_dir(spark)}/lexmill/{name}-{uuid.uuid4().hex[:12]}", False

    def save(self, df: DataFrame, name: str, *parts: str) -> DataFrame:
        """Write ``df`` and read it back; with ``parts`` each value of these columns has a folder."""
        path = f"{self.root}/{name}"
        df.write.partitionBy(*parts).parquet(path)
        return self._read(df, path)

    def save_and_tell(self, df: DataFrame, name: str, *facts: Column) -> tuple[DataFrame, dict]:
        """As ``save``, with the number of rows as ``n`` and other sums over them, observed while they are written."""
        seen = Observation()
        path = f"{self.root}/{name}"
        df.observe(seen, F.count(F.lit(1)).alias("n"), *facts).write.parquet(path)
        return self._read(df, path), seen.get

    def _read(self, df: DataFrame, path: str) -> DataFrame:
        if not self.marked:  # once there is something to delete
            system, root = self._found(self.root)
            self.marked = system.deleteOnExit(root)
        return self.spark.read.schema(df.schema).parquet(path)

    def _found(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def drop(self, name: str) -> None:
        """Delete a table that no later read needs."""
        system, path = self._found(f"{self.root}/{name}")
        system.delete(path, True)
