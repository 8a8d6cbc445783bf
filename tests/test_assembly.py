"""Pages that arrive apart, out of order, twice, late or never."""

import random
from datetime import datetime, timedelta

from lexmill.config import RuleConfig
from lexmill.plans.pipeline import SymbolicPlan
from lexmill.streaming.assembly import PROVIDER, run_assembly

SCHEMA = "doc_id long, page_no long, n_pages long, text string, arrived_at timestamp"
HOUR = timedelta(hours=1)


def arrive(spark, folder, n, rows):
    at = datetime(2024, 1, 1) + n * HOUR
    spark.createDataFrame([(*r, at) for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_pages_that_arrive_apart(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rng = random.Random(2)
    docs = {d: [f"{p} ALPHA\n{d}.{p} Beta\ntext of {d}\n" for p in range(1, rng.randrange(2, 6))] for d in range(12)}
    pages = [(d, p, len(ts), t) for d, ts in docs.items() for p, t in enumerate(ts, 1)]
    held = [r for r in pages if r[0] == 3 and r[1] == 2]
    first = [r for r in pages if r not in held]
    rng.shuffle(first)
    again = next(r for r in first if r[0] == 3)

    def run():
        df = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        return sorted((r.doc_id, r.page_no, r.text, r.status) for r in run_assembly(df, out, check, wait_s=7200, keep_s=360_000).collect())

    for k in range(3):
        arrive(spark, folder, k, first[k::3])
    arrive(spark, folder, 3, [again, (None, 1, 1, "x"), (50, None, 1, "x")])
    run()
    for k, (n, rows) in enumerate(((20, [(100, 1, 1, "a")]), (30, [(101, 1, 1, None)]), (40, held), (50, [(102, 1, 2, "open")]))):
        arrive(spark, folder, n, rows)
        if k == 1:
            run()  # the state outlives the query
    got = run()
    want = [(str(d), p, t, "incomplete" if d == 3 else "whole") for d, p, _, t in first] + [("3", 2, held[0][3], "late"), ("3", again[1], again[3], "repeated")]
    assert got == sorted([*want, ("100", 1, "a", "whole"), ("101", 1, "", "whole")])

    cfg = RuleConfig(skip_start_pages=0, skip_end_pages=0)
    key = lambda df: sorted(str(r.asDict(True)) for r in df.collect())
    arrived = SymbolicPlan(spark.read.parquet(out).filter("status = 'whole' and doc_id < 100").drop("status"), cfg)
    batch = SymbolicPlan(spark.createDataFrame([(str(d), p, t) for d, p, _, t in pages if d != 3], "doc_id string, page_no long, text string"), cfg)
    assert key(arrived.sections) == key(batch.sections)
    assert spark.conf.get(PROVIDER, "").endswith("HDFSBackedStateStoreProvider") or not spark.conf.get(PROVIDER, "")
