"""op2 on vectors that no covering radius separates."""

import numpy as np

from lexmill.llm import cover_tree


def test_no_row_is_sent_to_the_leaves_it_meets(spark, monkeypatch):
    """op2 (F1): vectors of no structure meet nearly every leaf; what is written stays in proportion to the rows."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 24))
    x = np.concatenate([x, x[:40] + rng.normal(size=(40, 24)) * 0.05, x[:5]]).astype(np.float32)
    monkeypatch.setattr(cover_tree, "FINE", 3)  # few of a leaf's 32 rows, as 256 are of 4,096
    written, save = {}, cover_tree.Scratch.save

    def spy(self, df, name, *parts):
        out = save(self, df, name, *parts)
        written[name] = out.count()
        return out

    monkeypatch.setattr(cover_tree.Scratch, "save", spy)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in cover_tree.embedding_near_duplicates(df, block=32).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    assert got == dict(enumerate(((u @ u.T >= 0.95).sum(1) - 1).tolist())) and sum(got.values()) >= 80
    assert max(n for name, n in written.items() if not name.startswith("pairs")) <= len(x)


def test_crowded_leaves_in_files(spark):
    """op2 (F1): leaves of near copies, whose heads rule nothing out, against all products; vectors of two lengths and of two precisions."""
    rng = np.random.default_rng(9)
    x = np.repeat(rng.normal(size=(6, 40)), 60, 0) + rng.normal(size=(360, 40)) * 0.22
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*x.tolist(), *x[:50, :30].tolist()])], "vec_id long, embedding array<double>")
    unit = lambda v: v / np.linalg.norm(v, axis=1)[:, None]
    want = np.concatenate([(unit(v) @ unit(v).T >= 0.95).sum(1) - 1 for v in (x, x[:50, :30])])
    assert {r.vec_id: r.n_links for r in cover_tree.embedding_near_duplicates(df, block=20).collect()} == dict(enumerate(want.tolist())) and 0 < want.sum() < 360 * 59
