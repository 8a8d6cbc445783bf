"""Benchmark passages against a direct search of every window, and odd texts."""

import hashlib
import random
import re

import pytest

from lexmill.llm import phrase_index

DOCS = "doc_id long, text string, w string, row int, pos int, term string, item_id long"
ITEMS = "item_id long, text string, item int, doc_id long, n int"


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(texts, items, window=10):
    out = []
    for doc_id, text in texts:
        w, hit, ids = words(text), set(), set()
        for item_id, t in items:
            x = words(t)
            n = min(window, len(x))
            for s in range(len(x) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == x[s : s + n]:
                        hit.update(range(p, p + n))
                        ids.add(item_id)
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def check(spark, texts, items):
    docs = spark.createDataFrame([(*r, "w", 1, 2, "t", 3) for r in texts], DOCS)
    bench = spark.createDataFrame([(*r, 1, 2, 3) for r in items], ITEMS)
    got = phrase_index.contamination(docs, bench).collect()
    want = brute(texts, items)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    return want


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40)]
    say = lambda n: " ".join(rng.choices(vocab, [1 / (i + 1) for i in range(40)], k=n))
    items = [(i, say(n)) for i, n in enumerate((30, 12, 10, 9, 3, 1, 60))]
    texts = []
    for i in range(60):
        a, b = rng.choice(items)[1].split(), rng.choice(items)[1].split()
        cut = rng.randrange(len(a))
        texts.append((i, " ".join((say(rng.randrange(30)), *a[cut : cut + rng.randrange(25)], say(rng.randrange(3)), *b, say(5)))))
    return texts, items


def test_every_window(spark, corpus):
    texts, items = corpus
    want = check(spark, texts, items)
    assert 0 < sum(w[2] for w in want) < sum(w[1] for w in want)


def test_salted_joins_give_the_same(spark, corpus, monkeypatch):
    monkeypatch.setattr(phrase_index, "SMALL", 0)
    check(spark, corpus[0][:20], corpus[1])


def test_odd_rows(spark):
    ten = "One two, three-four FIVE six seven eight nine ten"
    items = [(1, ten), (1, ten), (1, "other " + ten), (None, "nobody names this"), (2, None), (3, " .. "), (4, "ÉTÉ chaud"), (12, "a a a a a a a a a a a a")]
    texts = [(None, ten), (5, None), (5, ""), (5, ten.upper() + "\n" + ten), (6, "x" * 200_000 + " " + ten), (7, "été chaud Été"), (8, "ÉTÉ CHAUD 😀"), (9, "a " * 500), (9, "a " * 9), (10, "Nobody\tnames this"), (11, "one two three four five six seven eight nine")]
    want = check(spark, texts, items)
    assert [w[2] for w in want] == [10, 0, 0, 20, 10, 0, 2, 500, 0, 3, 0]
    check(spark, texts, [])
    check(spark, [], items)


def test_proximity(spark, corpus):
    texts, items = corpus
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    index = phrase_index.build_index(docs, bench)
    counts = {r.word: r.n for r in index.terms.collect()}
    ranks = {r.word: r.term for r in index.terms.collect()}
    want = set()
    for item_id, t in items:
        rare = sorted(set(words(t)), key=lambda x: (counts.get(x, 0), ranks.get(x, 0)))[:3]
        for doc_id, text in texts:
            w = words(text)
            for p in (p for p, x in enumerate(w) if x == rare[0]):
                if all(r in w[max(0, p - 6) : p + 7] for r in rare[1:]):
                    want.add((doc_id, item_id, p))
    got = phrase_index.proximity_hits(index, 3, 6).join(index.documents, "row").select("doc_id", "item_id", "pos").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want and want


def test_only_dataframe_operations(spark, corpus):
    docs, bench = spark.createDataFrame(corpus[0], "doc_id long, text string"), spark.createDataFrame(corpus[1], "item_id long, text string")
    plan = phrase_index.contamination(docs, bench)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "NestedLoop"))
