"""Hard negatives against all products, with several cells, groups and slices, and odd vectors."""

import math

import numpy as np
import pytest

from lexmill.llm import voronoi_join

SCHEMA = "vec_id long, embedding array<double>, label int, row int, dim string, v double, id string, anchor int"


def brute(rows, positives=5, negatives=10, low=30, high=90, scale=256):
    use = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) or not math.isfinite(c * scale) for c in v):
            continue
        use.append((i, [math.floor(c * scale) for c in v], label))
    out = []
    for a, (i, v, label) in enumerate(use):
        if i % 100:
            continue
        others = [(sum(x * y for x, y in zip(v, w, strict=True)), j, m) for b, (j, w, m) in enumerate(use) if b != a and len(w) == len(v)]
        others.sort(key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in others if s[2] == label][:positives]:
            fit = [s for s in others if s[2] != label and low * ps <= 100 * s[0] <= high * ps][:negatives]
            out += [(i, p, k, n, ps, ns) for k, (ns, n, _) in enumerate(fit, 1)]
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "d", 2.0, "x", 3) for r in rows], SCHEMA)
    got = voronoi_join.mine_hard_negatives(df, "vec_id % 100 = 0").collect()
    want = brute(rows)
    assert sorted(map(tuple, got)) == want
    return want


def clustered(n, dim, seed, centres=12):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    v = c[rng.integers(centres, size=n)] + 0.4 * rng.normal(size=(n, dim)) * rng.choice([0.5, 1, 3], size=(n, 1))
    return v / np.linalg.norm(v, axis=1, keepdims=True).mean()


@pytest.fixture
def small(monkeypatch):
    for name, n in (("GROUP", 4), ("SLICE", 64), ("LEAST_SLICE", 16), ("AT_ONCE", 3), ("PIVOTS", 7), ("SEEDS", 100)):
        monkeypatch.setattr(voronoi_join, name, n)


def test_cells_groups_and_slices(spark, small):
    v = clustered(1500, 8, 1)
    rows = [(i * 5, x.tolist(), 0 if i % 3 == 0 else i % 11) for i, x in enumerate(v)]  # one label holds a third
    assert len(check(spark, rows)) > 1000


def test_production_sizes(spark):
    v = clustered(900, 16, 2)
    assert check(spark, [(i * 10, x.tolist(), i % 4) for i, x in enumerate(v)])


def test_odd_vectors(spark, small):
    v = clustered(60, 4, 3)
    rows = [(i * 20, x.tolist(), i % 2) for i, x in enumerate(v)]
    rows += [(0, v[0].tolist(), 0), (0, v[1].tolist(), 0), (100, v[5].tolist(), 1), (7, v[7].tolist(), 1), (7, v[7].tolist(), 1)]  # repeated ids, also with one vector
    rows += [(200, None, 1), (300, [1.0, None, 1.0, 1.0], 1), (400, [1.0, math.nan, 0.0, 0.0], 1), (500, [math.inf, 0.0, 0.0, 0.0], 0), (None, v[3].tolist(), 0), (600, v[3].tolist(), None)]
    rows += [(700, [0.0] * 4, 0), (701, [0.0] * 4, 1), (800, [], 0), (801, [], 0), (802, [], 1), (900, [0.5], 0), (901, [0.25], 0), (902, [0.2], 1), (1000, [1e308] * 4, 0)]
    assert check(spark, rows)


def test_large_components_are_exact(spark, small):
    rng = np.random.default_rng(4)
    rows = [(i * 10, [float(x) for x in rng.integers(-(2**22), 2**22, 3)], i % 2) for i in range(60)]
    assert check(spark, rows)


def test_empty(spark):
    assert not check(spark, [])
    assert not check(spark, [(1, [1.0], 1), (2, [1.0], 2)])
    assert not check(spark, [(100, [1.0], 1)])
