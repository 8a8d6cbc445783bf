"""The mixture, document by document: naive Bayes and projected gradient written out."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import mixing


def clues(text):
    """(tokens, words and steps) of a text."""
    w = [x for x in re.split(r"[\s.,]+", (text or "").lower()) if x]
    n, words = len(w), set(w)
    symbols = len(re.findall(r"[*&%$#|!]", text or "")) / max(n, 1)
    step = lambda name, x, cuts: f" {name}{sum(x >= c for c in cuts)}"
    return n, words | {step("symbols", symbols, (0.05, 0.2, 0.6)), step("vocabulary", len(words) / max(n, 1), (0.1, 0.25, 0.5, 0.8)), step("length", n, (20, 100, 400, 2000))}


def direct(docs, labels, targets):
    """Rates and posteriors in the order of ``docs``."""
    first = {}
    for i, d in labels:
        if i is not None and d is not None:
            first[i] = min(d, first.get(i, d))
    sample = [(first[i], clues(t)[1]) for i, t in docs if i in first]
    shares = Counter(d for d, _ in sample)
    domains, total = sorted(shares), len(sample)
    counts = defaultdict(Counter)
    for d, cs in sample:
        for c in cs:
            counts[c][d] += 1
    chosen = set()
    for d in domains:
        gains = []
        for c, by in counts.items():
            if by[d] and not c.startswith(" "):
                inside, outside = (by[d] + 0.1) / (shares[d] + 0.2), (sum(by.values()) - by[d] + 0.1) / (total - shares[d] + 0.2)
                gain = (inside - outside) * math.log(inside / outside)
                gains += [(-gain, c)] if gain > 0 else []
        chosen |= {c for _, c in sorted(gains)[: mixing.WORDS]}
    prob = {c: np.array([(by[d] + 0.1) / (shares[d] + 0.2) for d in domains]) for c, by in counts.items() if c in chosen or c.startswith(" ")}
    n, p = [], []
    for _, t in docs:
        size, cs = clues(t)
        logit = np.log([shares[d] / total for d in domains])
        for c, q in prob.items():
            if c.startswith(" "):
                logit = logit + np.log(q) * (c in cs)
            else:
                logit = logit + (np.log(q) if c in cs else np.log(1 - np.minimum(q, 0.999)))
        e = np.exp(logit - logit.max())
        n.append(size)
        p.append(e / e.sum())
    n, p = np.array(n, float), np.array(p)
    have = (n[:, None] * p).sum(0) / n.sum()
    goal = np.array([targets.get(d, 0.0) for d in domains]) * (have > 1e-9)
    goal /= goal.sum()
    rate = np.ones(len(docs))
    for _ in range(mixing.ROUNDS):
        gap = (rate[:, None] * n[:, None] * p).sum(0) / n.sum() - goal
        if np.abs(gap).max() < mixing.CLOSE:
            break
        rate = np.maximum(0, rate - p @ (gap / np.maximum(have, 1e-9)))
    return domains, n, p, rate


def say(rng, kind):
    pools = {"good": "river stone walked slowly evening garden letters carried".split(), "low": "buy click now deal deal free".split() + ["!!!", "$$"], "toxic": "hate stupid awful rotten fool".split()}
    words = rng.choices(pools[kind], k=rng.randrange(3, 60)) + rng.choices("the of and a in".split(), k=rng.randrange(5, 30))
    rng.shuffle(words)
    return " ".join(words)


@pytest.mark.filterwarnings("ignore")
def test_rates_one_by_one(spark):
    rng = random.Random(6)
    kinds = rng.choices(("good", "low", "toxic"), (6, 3, 1), k=150)
    docs = [(i, say(rng, k)) for i, k in enumerate(kinds)]
    labels = [(i, k) for i, k in enumerate(kinds) if i % 2] + [(1, "toxic"), (None, "low"), (4, None), (9999, "good")]
    docs += [(3, docs[3][1]), (3, "another text of an id that is there"), (None, docs[5][1]), (None, None), (200, ""), (201, "long words of a story " * 20_000)]
    targets = {"good": 0.5, "low": 0.3, "toxic": 0.2}
    df = spark.createDataFrame([(i, t, "x", 1, 2.0, k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, domain string, p int, rate double, at long")
    got = mixing.mix_to_targets(df, spark.createDataFrame(labels, "doc_id long, domain string"), targets, carry=("at",)).orderBy("at").collect()
    domains, n, p, rate = direct(docs, labels, targets)
    assert [r.n_tokens for r in got] == n.tolist() and [r.doc_id for r in got] == [i for i, _ in docs]
    assert [r.domain for r in got] == [domains[k] for k in p.argmax(1)]
    np.testing.assert_allclose([r.p_domain for r in got], p.max(1), rtol=1e-9)
    np.testing.assert_allclose([r.rate for r in got], rate, rtol=1e-6, atol=1e-9)
    plain = mixing.mix_to_targets(df, spark.createDataFrame(labels, "doc_id long, domain string"), targets)
    key = lambda rows: sorted((str(r.doc_id), r.n_tokens, r.domain, round(r.rate, 9)) for r in rows)
    assert key(plain.collect()) == key(got)
    assert len({hashlib.md5(str(r.rate).encode()).hexdigest() for r in got}) > 20 and plain.filter(F.col("rate") < 0).count() == 0
