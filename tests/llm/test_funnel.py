"""Ordered funnels against a direct version, and odd rows."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pyarrow as pa

from lexmill.llm import funnel
from lexmill.llm.funnel import Funnel
from lexmill.llm.parameters import FUNNELS

SCHEMA = "client_id long, kind string, arrived_at timestamp_ntz, funnel string, n long, step int, took long, block long"


def brute(rows, funnels):
    by = defaultdict(lambda: defaultdict(set))
    for c, k, t in rows:
        if None not in (c, k, t):
            by[c][k].add((t - datetime(1970, 1, 1)) // timedelta(microseconds=1))
    out = {}
    for f in funnels:
        for c, kinds in by.items():
            counts, times = [0] * len(f.steps), [[] for _ in f.steps]
            for t1 in kinds[f.steps[0]]:
                counts[0] += 1
                now = t1
                for k, kind in enumerate(f.steps[1:], 1):
                    ahead = min((t for t in kinds[kind] if t > now), default=None)
                    if ahead is None or ahead - t1 > 1_800_000_000 or any(now < x <= ahead for x in kinds[f.excluded]):
                        break
                    counts[k] += 1
                    times[k].append(ahead - now)
                    now = ahead
            if counts[0]:
                nth = [sorted(x)[-(-90 * len(x) // 100) - 1] if x else None for x in times[1:]]
                out[f.name, c] = (*counts, sum(n > 0 for n in counts), *nth)
    depth = defaultdict(int)
    for (name, _), v in out.items():
        depth[name, v[4]] += 1
    return {k: (*v, depth[k[0], v[4]]) for k, v in out.items()}


def check(spark, rows, funnels=FUNNELS):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], SCHEMA)
    got = funnel.ordered_funnels(df, funnels).collect()
    assert {(r.funnel, r.client_id): (r.n1, r.n2, r.n3, r.n4, r.deepest, r.t2, r.t3, r.t4, r.same_depth) for r in got} == brute(rows, funnels)
    return got


def test_random_clients_ranges_and_ties(spark):
    rng, rows = random.Random(3), []
    kinds = ["view"] * 5 + ["click"] * 5 + ["purchase"] * 3 + ["signup", "error", "other", None]
    for c, n, span in ((1, 900, 86_400), (2, 300, 15_000), (-5, 200, 300_000), (None, 20, 900), (7, 60, 1)):
        for _ in range(n):
            t = datetime(2024, 3, 1, 3) + timedelta(microseconds=rng.randrange(span) * 1_000_000 + rng.choice((0, 0, 1, 65_536)))
            rows.append((c, rng.choice(kinds), None if rng.random() < 0.02 else t))
    got = check(spark, rows + rows[:300])
    assert max(r.deepest for r in got) == 4


def test_edges_of_steps_and_ranges(spark):
    day, at = datetime(1969, 12, 31, 23, 59, 59, 999_999), lambda s: datetime(1970, 1, 1) + timedelta(seconds=s)
    rows = [(1, "view", day), (1, "click", at(0)), (1, "view", at(1)), (1, "purchase", at(1)), (1, "purchase", at(1799.999999))]  # exactly 30 minutes, over the edge of a range
    rows += [(2, "view", at(0)), (2, "click", at(0)), (2, "click", at(5)), (2, "error", at(5))]  # excluded at the same time as the next step
    rows += [(3, "view", at(0)), (3, "error", at(0)), (3, "click", at(5)), (3, "error", at(5.000001)), (3, "view", at(9))]
    rows += [(4, "view", at(0)), (4, "click", at(1800.000001))]
    rows += [(5, "view", at(14_400 - 1)), (5, "view", at(14_400)), (5, "click", at(14_400)), (5, "click", at(14_401))]
    got = {(r.funnel, r.client_id): r for r in check(spark, rows)}
    assert got["A", 1].deepest == 4 and got["A", 2].deepest == 1 and got["A", 3].deepest == 2 and got["A", 4].deepest == 1 and got["A", 5].n2 == 2


def test_empty_and_shorter_funnels(spark):
    assert not check(spark, [])
    df = spark.createDataFrame([(1, "a'b", datetime(2024, 1, 1)), (1, "c", datetime(2024, 1, 1, 0, 1))], "client_id long, kind string, arrived_at timestamp")
    got = funnel.ordered_funnels(df, [Funnel("o'x", ("a'b", "c")), Funnel("y", ("c", "c", "c"), "a'b")]).collect()
    assert {(r.funnel, r.n1, r.n2, r.n3, r.deepest, r.t2, r.t3, r.same_depth) for r in got} == {("o'x", 1, 1, 0, 2, 60_000_000, None, 1), ("y", 1, 0, 0, 1, None, None, 1)}


def test_ranges_are_not_cut():
    keys = [(c, b) for c in range(5) for b in range(3) for _ in range(c * 7 + 1)]
    batches = [pa.RecordBatch.from_pydict({"client": [k[0] for k in keys[i : i + 4]], "block": [k[1] for k in keys[i : i + 4]]}) for i in range(0, len(keys), 4)]
    tables = [list(zip(t["client"].to_pylist(), t["block"].to_pylist(), strict=True)) for t in funnel.whole_ranges(iter(batches), 10)]
    assert [k for t in tables for k in t] == keys and len(tables) > 5
    assert all(len({*map(tuple, a)} & {*map(tuple, b)}) == 0 for a, b in zip(tables, tables[1:], strict=False))
