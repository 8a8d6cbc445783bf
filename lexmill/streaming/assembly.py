"""Documents from pages that arrive apart: an extension, labelled as such.

A stateful operator holds the pages of each document until all are there.  A document that stays incomplete too long is given up by
a timer on event time, and what still comes for a closed document goes out marked, so that it can be kept in a table of its own.
"""

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "doc_id string, page_no long, text string, status string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Assembler(StatefulProcessor):
    """State of a document: its pages by number, and ``n_pages, seen, closed, timer``."""

    def __init__(self, wait_ms: int, keep_ms: int):
        self.wait, self.keep = wait_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "page_no long", "text string")
        self.facts = handle.getValueState("facts", "n_pages long, seen long, closed boolean, timer long")

    def _out(self, key, rows: list[tuple[int, str, str]]) -> pd.DataFrame:
        text = lambda xs: pd.Series(xs, dtype=object)
        return pd.DataFrame({"doc_id": text([str(key[0])] * len(rows)), "page_no": pd.Series([r[0] for r in rows], dtype="int64"), "text": text([r[1] for r in rows]), "status": text([r[2] for r in rows])})

    def _all(self, status: str) -> list[tuple[int, str, str]]:
        out = sorted((k[0], v[0], status) for k, v in self.pages.iterator())
        self.pages.clear()
        return out

    def _timer(self, old: int, new: int) -> int:
        if old >= 0 and old != new:
            self.handle.deleteTimer(old)
        if old != new:
            self.handle.registerTimer(new)
        return new

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, seen, closed, timer = self.facts.get() if self.facts.exists() else (0, 0, False, -1)
        out: list[tuple[int, str, str]] = []
        latest = 0
        for pdf in rows:
            for page, text, total, at in zip(pdf["page_no"], pdf["text"], pdf["n_pages"], pdf["at_ms"], strict=True):
                latest, n = max(latest, int(at)), max(n, int(total))
                if closed:
                    out.append((int(page), text, "late"))
                elif self.pages.containsKey((int(page),)):
                    out.append((int(page), text, "repeated"))
                else:
                    self.pages.updateValue((int(page),), (text,))
                    seen += 1
        now = max(latest, timerValues.getCurrentWatermarkInMs())
        if not closed and seen >= n:
            out += self._all("whole")
            closed = True
        timer = self._timer(timer, now + (self.keep if closed else self.wait))
        self.facts.update((n, seen, closed, timer))
        yield self._out(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.facts.exists():
            return
        n, seen, closed, _ = self.facts.get()
        if closed:
            self.facts.clear()
            self.pages.clear()
            return
        out = self._all("incomplete")
        self.facts.update((n, seen, True, self._timer(-1, timerValues.getCurrentWatermarkInMs() + self.keep)))
        yield self._out(key, out)


def assemble(pages: DataFrame, *, wait_s: int = 3600, keep_s: int = 86_400, disorder: str = "10 minutes") -> DataFrame:
    """``doc_id string, page_no, text, status`` of a stream ``doc_id, page_no, n_pages, text, arrived_at timestamp``.

    * ``whole``: all ``n_pages`` pages of a document are there; they go out together;
    * ``incomplete``: none came for ``wait_s`` seconds and some are missing; those that are there go out and the document is closed;
    * ``late``: a page of a document that was closed in the last ``keep_s`` seconds; after that its pages start a document anew;
    * ``repeated``: a second page of one number while the document is open; the first one counts.

    Time is that of ``arrived_at``; rows later than ``disorder`` are dropped by Spark and counted in the query's progress.  Rows without a document,
    number or count are left out.  Needs the RocksDB state store (``rocks_state``).
    """
    rows = pages.filter("doc_id is not null and page_no is not null and n_pages is not null and arrived_at is not null").withWatermark("arrived_at", disorder)
    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page_no").cast("long").alias("page_no"), F.col("n_pages").cast("long").alias("n_pages"), F.coalesce("text", F.lit("")).alias("text"), "arrived_at", F.unix_millis("arrived_at").alias("at_ms"))
    return rows.groupBy("doc_id").transformWithStateInPandas(Assembler(1000 * wait_s, 1000 * keep_s), OUT, "append", "eventTime")


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """The state store that the operator needs, set while a query is started and put back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def run_assembly(pages: DataFrame, out: str, checkpoint: str, **options) -> DataFrame:
    """Run over what is there now, adding to the Parquet table ``out``; a run on the same checkpoint goes on where the last one stopped."""
    spark = pages.sparkSession
    with rocks_state(spark):
        query = assemble(pages, **options).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)
        query.awaitTermination()
    return spark.read.schema(OUT).parquet(out)
