"""Quality scores from weak labels: EM over overlapping heuristic labellers, then a hashed linear scorer."""

from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import bounded_batches, slices, tidied

WIDTH = 1 << 12  # hashed features
SAMPLE = 4096  # documents that train the scorer: the bound of its training sample
GOOD, BAD, ABSTAIN = "g", "b", "-"
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_PLAIN = np.isin(_BYTES, [33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63])
_SYMBOL = ~(_LETTER | _SPACE | _PLAIN) & ((_BYTES < 48) | (_BYTES > 57))


def measures(text: str) -> dict[str, float]:
    """Shares that the labellers judge; 0 where there is nothing to measure."""
    n = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    words = text.split()
    full, letters, w = max(1, n[~_SPACE].sum()), max(1, n[_LETTER].sum()), max(1, len(words))
    return {
        "words": len(words), "symbols": n[_SYMBOL].sum() / full, "upper": n[_UPPER].sum() / letters, "shouts": n[33] / w, "bars": n[124] / w,
        "repeats": sum(map(eq, words, islice(words, 1, None))) / w, "distinct": len(set(words)) / w, "letters": n[_LETTER].sum() / full, "length": full / w,
    }


#: name, measure, votes bad at or above / below, votes good at or below / above; sign -1: small values are bad.
LABELLERS = [
    ("symbols", "symbols", 0.08, 0.02, 1), ("capitals", "upper", 0.40, 0.15, 1), ("shouting", "shouts", 0.30, 0.05, 1), ("tables", "bars", 0.25, 0.05, 1),
    ("stutter", "repeats", 0.20, 0.03, 1), ("vocabulary", "distinct", 0.10, 0.20, -1), ("letters", "letters", 0.80, 0.90, -1), ("long words", "length", 25.0, 12.0, 1), ("empty", "words", 0.5, 1e9, -1),
]


def votes(m: dict[str, float]) -> str:
    out = []
    for _, key, bad, good, sign in LABELLERS:
        x = m[key] * sign
        out.append(BAD if x >= bad * sign and (sign > 0 or m[key] < bad) else GOOD if x <= good * sign else ABSTAIN)
    return "".join(out)


def fit_label_model(counts: dict[str, int], rounds: int = 50, prior: float = 0.85, strength: float = 10.0) -> dict[str, float]:
    """EM for P(vote | class) of every labeller and the class share; returns P(good) for each pattern of votes.

    The starting point and the pseudo-counts say that labellers rarely call a good document bad.
    """
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    kinds = np.array([[(GOOD, BAD, ABSTAIN).index(v) for v in p] for p in patterns]).reshape(len(patterns), -1)
    one = np.eye(3)[kinds]  # pattern, labeller, vote
    guess = np.array([0.05 if BAD in p else 0.95 for p in patterns])
    start = np.array([[0.70, 0.01, 0.29], [0.45, 0.25, 0.30]])  # P(vote | good), P(vote | bad)
    for _ in range(rounds):
        share = (prior * strength + (n * guess).sum()) / (strength + n.sum())
        logit = np.full(len(patterns), np.log(share / (1 - share)))
        for c, g in ((0, guess), (1, 1 - guess)):
            p = strength * start[c] + np.einsum("i,ijk->jk", n * g, one)
            p /= p.sum(1, keepdims=True)
            logit += (1 - 2 * c) * np.einsum("ijk,jk->i", one, np.log(p))
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - guess).max() < 1e-9:
            break
        guess = new
    return dict(zip(patterns, guess.tolist(), strict=True))


def features(text: str, m: dict[str, float]) -> np.ndarray:
    """Hashed features: shares of byte pairs, and one-hot steps of the measures."""
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(b) > 1:
        pair = ((b[:-1] * np.uint32(256) + b[1:]) * np.uint32(0x9E3779B1)) >> np.uint32(20)
        x = np.sqrt(np.bincount(pair, minlength=WIDTH) / len(pair)).astype(np.float32)
    else:
        x = np.zeros(WIDTH, np.float32)
    for i, (_, key, bad, good, sign) in enumerate(LABELLERS):
        mid = (bad + min(good, 2 * bad)) / 2
        step = sum(sign * m[key] >= sign * t for t in (good, mid, bad))
        x[((i * 4 + step) * 0x85EBCA6B % 2**32) >> 20] += 1
    return x


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 1.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes with the same total weight."""
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    pos, neg = max(y.sum(), 1e-6), max((1 - y).sum(), 1e-6)
    weight = (y / pos + (1 - y) / neg) / 2
    for _ in range(rounds):
        e = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) * weight
        w -= rate * (x.T @ e + decay * w)
        b -= rate * float(e.sum())
    return w.astype(np.float32), b


def _slices(batches):
    for batch in batches:
        yield from slices(batch, "text_")


def score_quality(documents: DataFrame, carry: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """Score every whole text by the scorer that the weak labels trained; labels of quality are never read.

    Returns ``doc_id, votes string, weak_label double`` (the EM posterior of being good), ``score double`` (0 to 1) and ``kept
    boolean`` (score >= threshold), and the columns in ``carry``; a row for each input row.  Null and wordless
    texts get score 0.  Rows with null ids, repeats and very long texts are scored like any others; without
    rows there is no model and no result.  The training sample is drawn by a hash of id, length and beginning, so that rows of one id do not come or go together.
    """
    carry = carry or []
    sc = documents.sparkSession.sparkContext
    bounded_batches(documents.sparkSession)
    texts = documents.select(F.col("text").cast("string").alias("text_"), "doc_id", *carry)

    def vote(batches):
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([votes(measures(t or "")) for t in batch.column("text_").to_pylist()], pa.string())], names=["votes"])

    counts = {r.votes: r["count"] for r in texts.select("text_").mapInArrow(tidied(vote), "votes string").groupBy("votes").count().collect()}  # at most 3 ** labellers rows
    label = sc.broadcast(fit_label_model(counts) if counts else {})

    def example(batches):
        for batch in _slices(batches):
            rows = [(t or "", measures(t or "")) for t in batch.column("text_").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([features(t, m).astype(np.float16).tobytes() for t, m in rows], pa.binary()), pa.array([votes(m) for _, m in rows])], names=["x", "votes"])

    share = min(1.0, SAMPLE / max(1, sum(counts.values())))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.substring("text_", 1, 64), F.length("text_"), F.lit(7)), F.lit(1_000_000))
    drawn = lambda df: df.select("text_").mapInArrow(tidied(example), "x binary, votes string").limit(2 * SAMPLE).collect()
    rows = drawn(texts.filter(draw < int(share * 1_000_000) + 1)) or drawn(texts.limit(SAMPLE))  # rows that are all alike may all be left out
    x = np.array([np.frombuffer(r.x, np.float16) for r in rows], np.float32).reshape(len(rows), WIDTH)
    model = sc.broadcast(_fit(x, np.array([label.value[r.votes] for r in rows], np.float32)))

    def score(batches):
        w, b = model.value
        for batch in _slices(batches):
            v, p, s = [], [], []
            for t in batch.column("text_").to_pylist():
                m = measures(t or "")
                v.append(votes(m))
                p.append(label.value[v[-1]])
                s.append(1 / (1 + np.exp(-float(np.clip(features(t, m) @ w + b, -30, 30)))) if m["words"] else 0.0)
            cols = [batch.column(c) for c in ("doc_id", *carry)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(v, pa.string()), pa.array(p, pa.float64()), pa.array(s, pa.float64())], names=["doc_id", *carry, "votes", "weak_label", "score"])

    schema = texts.drop("text_").schema.add("votes", "string").add("weak_label", "double").add("score", "double")
    return texts.mapInArrow(tidied(score), schema).withColumn("kept", F.col("score") >= threshold)
