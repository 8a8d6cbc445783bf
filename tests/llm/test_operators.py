"""Brute-force versions, round trips and edge cases of the training-data operators."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from lexmill.llm import bpe_automaton, chunks, cover_tree, language_id, license_scan, mixing, quality, queries, shingle_join, token_counts, token_store, topk_search
from lexmill.llm.scratch import Scratch

DIR = "/root/testdata/sf0.001"
ODD = ["", "  ", None, "\n\n x\n", "a", "  a  b ", "x" * 3000, "ΑΣ Σας İ é \x1c y", "<|startoftext|>hi<|endoftext|> <s> a<0x41>", "▁x 一丁😀 y z", "it's 3rd, don't!", "end  ", "tab\t \n q"]


def docs(spark, texts):
    """Documents with further columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, n string, score int")


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def smallest_reachable(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def check_join(df):
    rows = [(r.doc_id, shingles(r.text)) for r in df.collect()]
    links = [(a, b) for i, (a, x) in enumerate(rows) for b, y in rows[:i] if x and y and 100 * len(x & y) >= 85 * len(x | y)]
    want = smallest_reachable([a for a, _ in rows], links)
    got = shingle_join.ngram_jaccard_join(df).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {a: (len(x), want[a]) for a, x in rows}


def test_jaccard_join(spark, real):
    check_join(real)
    words = [f"w{i}" for i in range(200)]
    near = [" ".join(words[:k] + [f"u{k}"] + words[k + 1 :]) for k in range(0, 200, 9)]
    check_join(docs(spark, [*near, *near[:3], *ODD, "one two three", "ONE two\tthree"]))
    assert shingle_join.ngram_jaccard_join(docs(spark, ["a"]).limit(0)).count() == 0


def check_links(df):
    rows = [(r.doc_id, frozenset(shingles(r.text))) for r in df.collect()]
    alike = lambda x, y: bool(x and y) and 100 * len(x & y) >= 85 * len(x | y)
    want = sorted((a, sum(alike(x, y) for j, (b, y) in enumerate(rows) if j != i and a is not None and b is not None)) for i, (a, x) in enumerate(rows) if a is not None)
    assert sorted((r.doc_id, r.n_links) for r in shingle_join.ngram_jaccard_join(df).collect() if r.doc_id is not None) == want
    rep = {}
    for a, x in sorted((a, x) for a, x in rows if a is not None):
        rep.setdefault(x, a)
    pairs = [tuple(r) for r in shingle_join.ngram_jaccard_pairs(df).collect()]
    assert sorted(pairs) == sorted((max(a, b), min(a, b)) for x, a in rep.items() for y, b in rep.items() if a > b and alike(x, y))
    return len(pairs)


@pytest.mark.parametrize("cell", [1024, 3])
def test_jaccard_links(spark, real, monkeypatch, cell):
    monkeypatch.setattr(shingle_join, "CELL_SETS", cell)
    monkeypatch.setattr(shingle_join, "WIDTH", 2048 if cell > 3 else 7)
    words = [f"w{i}" for i in range(200)]
    near = [" ".join(words[:k] + [f"u{k}"] + words[k + 1 :]) for k in range(0, 200, 9)]
    chain = [" ".join(f"c{i}" for i in range(4 * k, 120 + 3 * k)) for k in range(12)]
    df = docs(spark, [*near, *near[:3], *chain, *ODD, "one two three", "ONE two\tthree"]).select("doc_id", "text")
    df = df.union(real.select(F.col("doc_id") + 1000, "text")).union(spark.createDataFrame([(None, near[0])], "doc_id long, text string"))
    assert check_links(df) > len(near) * (len(near) - 1) / 2
    assert shingle_join.ngram_jaccard_pairs(docs(spark, ["a"]).limit(0)).count() == 0


def test_jaccard_repeated_ids(spark):
    """Rows that repeat an id, with the same text or another, against brute force over rows, in any order."""
    words = [f"w{i}" for i in range(120)]
    near = [" ".join(words[:k] + [f"u{k}"] + words[k + 1 :]) for k in range(0, 120, 11)]
    rows = [(i % 5, t) for i, t in enumerate(near)] + [(1, near[0]), (1, near[0]), (7, "x y z q r"), (7, near[3]), (8, "x y z q r"), (3, "x y z q r"), (3, None), (3, ""), (9, ""), (9, "one two three four five " * 9000)]
    sets = [frozenset(shingles(t)) for _, t in rows]
    alike = lambda x, y: bool(x and y) and 100 * len(x & y) >= 85 * len(x | y)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if alike(sets[i], sets[j])]
    top = smallest_reachable(range(len(rows)), links)
    least = defaultdict(lambda: 99)
    for i, c in top.items():
        least[c] = min(least[c], rows[i][0])
    degree = [sum(i in pair for pair in links) for i in range(len(rows))]
    want = sorted((d, len(sets[i]), least[top[i]], degree[i]) for i, (d, _) in enumerate(rows))
    schema = "doc_id long, text string"
    for order in (rows, rows[::-1]):
        got = shingle_join.ngram_jaccard_join(spark.createDataFrame(order, schema).repartition(3)).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == want
    kept = shingle_join.one_of_each(spark.createDataFrame([*rows, (None, near[0]), (None, "only here one two three"), (None, "only here one two three")], schema), 4, 85).collect()
    assert len(kept) == len({top[i] for i in range(len(rows))}) + 1 and (None, "only here one two three") in [tuple(r) for r in kept]


def test_derived_links():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 1 << 40, 200))
    sets = [np.unique(np.concatenate([rng.choice(base, int(n), replace=False), rng.integers(0, 1 << 40, int(m))])) for n, m in zip(rng.integers(120, len(base), 40), rng.integers(0, 60, 40), strict=True)]
    for percent in (60, 85, 100):
        got = shingle_join._linked(sets[:25], sets[25:], percent)
        common = lambda x, y: len(np.intersect1d(x, y))
        assert got.tolist() == [[(100 + percent) * common(x, y) >= percent * (len(x) + len(y)) for y in sets[25:]] for x in sets[:25]]


def test_jaccard_hot_lists(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "HOT_DF", 2)
    words = [f"w{i}" for i in range(60)]
    check_join(docs(spark, [" ".join(words[:i] + ["z"] + words[i:]) for i in range(30)]))


def check_vectors(spark, vectors):
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, rep int")
    good = {i: np.array(v, float) for i, v in enumerate(vectors) if v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    good = {i: v / np.sqrt(v @ v) for i, v in good.items()}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.95]
    want, n = smallest_reachable(range(len(vectors)), links), defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.embedding_near_duplicates(df, block=16).collect()}
    assert got == {i: (n[i], want[i], want[i] == i) for i in range(len(vectors))}


def test_embedding_near_duplicates(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 8))
    near = [(b + rng.normal(size=8) * 0.12).astype(np.float32).tolist() for b in base for _ in range(9)]
    check_vectors(spark, [*near, near[0], near[0], None, [0.0] * 8, [None, *[1.0] * 7], [float("nan"), *[1.0] * 7], [1.0, 0.0], [1.0, 0.001], []])
    check_vectors(spark, [None])


def test_embedding_repeated_ids(spark):
    """Rows that repeat an id with another vector, null ids and no rows, against brute force over rows."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (3, [0.02, 1.0]), (4, [-1.0, 0.0]), (4, [-1.0, 0.0]), (None, [1.0, 0.0]), (None, None), (5, [0.0, 0.0])]
    cos = lambda x, y: np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y))
    good = [i for i, (d, v) in enumerate(rows) if d is not None and any(v)]
    links = [(i, j) for i in good for j in good if j < i and cos(rows[i][1], rows[j][1]) >= 0.95]
    top = smallest_reachable(range(len(rows)), links)
    least = {c: min(rows[i][0] for i in good if top[i] == c) for c in {top[i] for i in good}}
    want = [(d, sum(i in p for p in links), least[top[i]] if i in good else d) for i, (d, _) in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("component_id", F.lit("x"))
    key = lambda xs: sorted(xs, key=repr)
    for table in (df, df.orderBy(F.desc("vec_id")).repartition(3)):
        assert key((r.vec_id, r.n_links, r.component_id) for r in cover_tree.embedding_near_duplicates(table).collect()) == key(want)
    assert cover_tree.embedding_near_duplicates(df.limit(0)).count() == 0


def test_embedding_dense_nodes(spark, monkeypatch):
    """Nodes that no centre divides, levels of several centres, crowds of near leaves and salted visitors, against brute force."""
    for name, value in (("FANOUT", 4), ("SAMPLE", 12), ("FINE", 3), ("SLICES", 1), ("NEAR", 2)):
        monkeypatch.setattr(cover_tree, name, value)
    rng = np.random.default_rng(4)
    ball = [1.0, *[0.0] * 7] + rng.normal(size=(50, 8)) * 0.04  # all within the link distance of each other
    ring = [[np.cos(t), np.sin(t), *[0.0] * 6] for t in np.linspace(0, 3, 70)]  # a chain of links through many leaves
    vectors = np.array([*ball, *ring, *rng.normal(size=(40, 8)), *ball[:3]], np.float32)
    check_vectors(spark, [*vectors.tolist(), None])


def test_prefix_order():
    x = cover_tree._unit(np.random.default_rng(5).normal(size=(300, 12)))
    full, gaps = cover_tree.farthest_first(np.sqrt(np.maximum(0, 2 - 2 * x @ x.T)))
    order, part = cover_tree.farthest_prefix(x, 40)
    assert sorted(order) == list(range(300)) and (order[:40] == full[:40]).all() and np.allclose(part[1:40], gaps[1:40]) and not part[40:].any()
    same, none = cover_tree.farthest_prefix(np.repeat(x[:1], 5, 0), 3)
    assert same.tolist() == [0, 1, 2, 3, 4] and none[1:].max() < 1e-6
    tree = cover_tree.Tree(x[order], cover_tree.level_sizes(part, 0.05))
    got = {(i, j) for a, b in cover_tree.dual_links(tree, tree, 0.6) for i, j in zip(a, b, strict=True)}
    assert got == set(zip(*np.nonzero(tree.x @ tree.x.T >= 0.6), strict=True))


def test_packed_vectors():
    rows = [[1.0, 0.5], [0.1, 1e300], [1e-320, 0.0], [float(np.float32(0.1)), -2.0]]
    packed = cover_tree._pack(rows)
    assert [len(b) for b in packed] == [8, 16, 16, 8]
    assert np.allclose(cover_tree._units(packed, 2), cover_tree._unit(rows))


def test_tree_prunes_and_covers():
    rng = np.random.default_rng(2)
    x = cover_tree._unit(np.repeat(rng.normal(size=(20, 16)), 30, 0) + rng.normal(size=(600, 16)) * 0.05)
    order, insertion = cover_tree.farthest_first(np.sqrt(np.maximum(0, 2 - 2 * x @ x.T)))
    t = cover_tree.Tree(x[order], cover_tree.level_sizes(insertion, 0.05))
    assert len(t.sizes) > 2 and t.sizes[-1] == 600
    got = {(i, j) for a, b in cover_tree.dual_links(t, t, 0.95) for i, j in zip(a, b, strict=True)}
    assert got == set(zip(*np.nonzero(t.x @ t.x.T >= 0.95), strict=True))


def test_topk(spark):
    rng = np.random.default_rng(3)
    v = [rng.normal(size=6).astype(np.float32).tolist() for _ in range(240)]
    v[7] = v[8] = v[9]
    v += [None, [None, *[1.0] * 5], [float("inf"), *[1.0] * 5], [1.0]]
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, score int")
    got = topk_search.exact_topk(df, df.filter("vec_id % 20 = 0"), 20).collect()
    c = duckdb.connect()
    pdf = df.toPandas()
    c.register("embeddings_", pdf)
    e = {i: [int(np.floor(64 * float(c))) for c in x] for i, x in enumerate(v) if i < 240}
    want = []
    for q in range(0, 240, 20):
        best = sorted((-sum(a * b for a, b in zip(e[q], e[i], strict=True)), i) for i in e if i != q)[:20]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got if r.query_id < 240) == want
    assert topk_search.exact_topk(df.limit(0), df.limit(0)).count() == 0
    rows = [(20, [1.0, 0.5]), (20, [1.0, 0.5]), (20, [-1.0, 0.25]), *[(i, [float(i % 5), float(i % 3)]) for i in range(1, 60) if i % 20], (None, [9.0, 9.0])]
    again = spark.createDataFrame([(i, x, 1) for i, x in rows], "vec_id long, embedding array<double>, rank int")
    every = [(i, tuple(np.floor(64 * np.array(x)).tolist())) for i, x in rows if i is not None]  # twins are rows of their own
    want = []
    for k, (i, x) in enumerate(every):
        if i == 20:
            best = sorted((-int(np.dot(x, y)), j) for n, (j, y) in enumerate(every) if n != k)[:20]
            want += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in topk_search.exact_topk(again, again.filter("vec_id = 20"), 20).collect()) == sorted(want)
    x, y = rng.integers(-30, 30, (600, 5)).astype(float), rng.integers(-30, 30, (40, 5)).astype(float)
    ids, qids = np.array([(i, 0) for i in range(600)]), np.array([(i, 0) for i in range(40)])
    score = y @ x.T
    score[np.arange(40), np.arange(40)] = -np.inf
    kth = np.sort(score, axis=1)[:, -10]
    for known in (None, kth):  # with what is known from elsewhere, all that can matter is still found
        got = defaultdict(list)
        for a, b, s in topk_search.block_topk(x, ids, y, qids, 10, known):
            got[a].append((-s, b))
        assert all(sorted(got[a]) == sorted(zip(-score[a], range(600), strict=True))[:10] for a in range(40))
    assert topk_search.block_topk(x, ids, y, qids, 10, np.full(40, 1e9)) == []
    big = topk_search.block_topk(np.array([[2.0**40], [-(2.0**40)]]), np.array([[1, 0], [2, 0]]), np.array([[2.0**40]]), np.array([[0, 0]]), 2)
    assert [s for _, _, s in big] == [2**63 - 1, -(2**63)]


def test_bpe_round_trip(spark, real):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    df = docs(spark, ODD).select("doc_id", "text").union(real.select(F.col("doc_id") + 1000, "text"))
    got = {r.doc_id: r for r in bpe_automaton.bpe_round_trip(df, path, keep_ids=True, keep_text=True).collect()}
    for doc, text in df.collect():
        ids = tok.encode(text or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        r = got[doc]
        assert (r.ids, r.decoded, r.n_tokens) == (ids, back, len(ids)), text
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_automaton_against_merging():
    vocab = {t: i for i, t in enumerate(["a", "b", "ab", "aa", "aab", "aba", "abab", "ba"])}
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("ab", "a"), ("ab", "ab"), ("b", "a")]
    m = bpe_automaton.Automaton(bpe_automaton.compile_automaton(vocab, merges, ""))
    names = {i: t for t, i in vocab.items()}
    for n in range(1, 10):
        for bits in range(2**n):
            s = "".join("ab"[bits >> k & 1] for k in range(n))
            parts = list(s)
            for u, v in merges:
                i = 0
                while i < len(parts) - 1:
                    if parts[i] == u and parts[i + 1] == v:
                        parts[i : i + 2] = [u + v]
                    i += 1
            for raw in (m.read([s.encode(), b"ab", s.encode()], False)[2], m._alone(s.encode(), False)):
                assert [names[i] for i in np.frombuffer(raw, "<u4").tolist()] == parts, s


def test_long_and_odd_texts_of_tokenizers(spark):
    """Very long texts and words, wide white space and repeated, null ids, by the three tokenizer operators."""
    texts = [*ODD, "ab " * 40_000, "xyz" * 30_000, "a\u00a0b \u2003c\u2028d\x85e f", "x <|endoftext|> y.<|endoftext|>", "a\r\n\r\n b\t\tc  \n", "word,'s isn't \"it\"'ll (x)", "e\u0301 =\u0338"]
    df = spark.createDataFrame([(None if i % 3 == 0 else i % 4, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    word, byte, pieces = (public_tokenizers.path(p) for p in (queries.WORD_BPE, queries.BYTE_BPE, queries.PIECES))
    a, b = Tokenizer.from_file(word), Tokenizer.from_file(byte)
    u = Tokenizer(models.Unigram(token_counts.vocabulary(pieces), unk_id=0, byte_fallback=True))
    u.pre_tokenizer = pre_tokenizers.Metaspace("▁", prepend_scheme="always", split=True)
    key = lambda rows: sorted((-1 if d is None else d, *x) for d, *x in rows)
    ids = lambda tok, t: tok.encode(t or "", add_special_tokens=False).ids
    rows = df.select("doc_id", "text").collect()
    assert key((r.doc_id, r.ids) for r in bpe_automaton.bpe_round_trip(df, word, keep_ids=True).collect()) == key((d, ids(a, t)) for d, t in rows)
    assert key((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(df, pieces).collect()) == key((d, len(ids(u, t))) for d, t in rows)
    once = token_store.token_files(df, byte).orderBy("start").collect()
    assert key((r.doc_id, r.ids_crc32) for r in once) == key((d, zlib.crc32(np.array([*ids(b, t), 0], "<u4").tobytes())) for d, t in rows)
    again = token_store.token_files(spark.createDataFrame([tuple(r) for r in df.collect()][::-1], df.schema).repartition(3), byte).orderBy("start").collect()
    assert once == again  # the order of the input's rows does not matter
    for f in (lambda d: bpe_automaton.bpe_round_trip(d, word), lambda d: token_counts.count_tokens(d, pieces), lambda d: token_store.token_files(d, byte)):
        assert f(df.limit(0)).count() == 0


def test_chunks(monkeypatch):
    texts = ["".join(random.Random(i).choice("ab ',\n\t") for _ in range(i % 17)) for i in range(400)] + [None]
    for cut in (chunks.cut_at_blanks, chunks.cut_at_words):
        parts, at, bounds = chunks.chunks(pa.array(texts), cut)
        assert ["".join(parts[k] for k in at[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)] == [t or "" for t in texts]
    batch = pa.record_batch([pa.array(texts)], names=["t"])
    got = list(chunks.slices(batch, "t", 40))
    assert pa.Table.from_batches(got).column("t").to_pylist() == texts and max(sum(len(x or "") for x in g.column("t").to_pylist()) for g in got) <= 40
    table = chunks.Table(lambda asked: [c.encode() for c in asked], 4000)
    for i in range(50):
        asked = [f"w{j}" for j in range(i, i + 9)] + ["long" * 400]
        assert table(asked) == [c.encode() for c in asked]
    assert len(table.young) + len(table.old) < 60 and "long" * 400 not in table.young


def test_token_files(spark, real, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    df = docs(spark, ODD).select("doc_id", "text").union(real.select(F.col("doc_id") + 1000, "text"))
    rows, at = sorted((r.doc_id, r.text) for r in df.collect()), 0
    out = str(tmp_path / "tokens")
    token_store.write_shards(df, out, path)
    got = {r.doc_id: r for r in token_store.read_shards(spark, out, keep_ids=True).collect()}
    for doc, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        r = got[doc]
        assert (r.start, r.n_tokens, r.ids, r.ids_crc32) == (at, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes())), text
        at += len(ids)
    d = bytes(spark.read.parquet(f"{out}/dictionary").first().dictionary)
    shards = [token_store.Shard(bytes(r.shard), d) for r in spark.read.parquet(f"{out}/shards").collect()]
    assert [x.tolist() for x in (s.find(4) for s in shards) if x is not None] == [got[4].ids] and shards[0].find(-5) is None
    with pytest.raises(ValueError):
        token_store.Shard(bytes(spark.read.parquet(f"{out}/shards").first().shard), d + b"x")
    assert token_store.token_files(df.limit(0), path).count() == 0


def test_token_files_without_ids(spark, monkeypatch, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rows = [(None, "a b"), (7, "c d e"), (None, "x"), (None, None), (-3, "minus"), (0, "zero"), (0, "zero again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((d is not None, d or 0, [*tok.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in rows)
    for n, size in enumerate((4 << 20, 1)):  # all in one shard or each in one
        monkeypatch.setattr(token_store, "SHARD_BYTES", size)
        out = str(tmp_path / str(n))
        token_store.write_shards(df, out, path)
        got = token_store.read_shards(spark, out, keep_ids=True).orderBy("start").collect()
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == want
        assert [r.doc_id for r in got] == [None, None, None, -3, 0, 0, 7]
        assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
        d = bytes(spark.read.parquet(f"{out}/dictionary").first().dictionary)
        found = [token_store.Shard(bytes(r.shard), d).find(-3) for r in spark.read.parquet(f"{out}/shards").collect()]
        assert [x.tolist() for x in found if x is not None] == [[*tok.encode("minus", add_special_tokens=False).ids, 0]]


def test_token_counts(spark, real):
    path = public_tokenizers.path("piece_bpe_32k.model")
    tok = Tokenizer(models.Unigram(token_counts.vocabulary(path), unk_id=0, byte_fallback=True))
    tok.pre_tokenizer = pre_tokenizers.Metaspace("▁", prepend_scheme="always", split=True)
    df = docs(spark, ODD).select("doc_id", "text").union(real.select(F.col("doc_id") + 1000, "text"))
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, path).collect()}
    for doc, text in df.collect():
        assert got[doc] == len(tok.encode(text or "", add_special_tokens=False).ids), text


def test_licenses(spark, real):
    texts = [*ODD, "Licensed under the Apache License, Version 2.0.\nYou may obtain a copy of the License at http", "Released under the MIT License. Released under the MIT License.", "All rights reserved. Licensed under CC BY-NC 4.0."]
    df = docs(spark, texts).select("doc_id", "text").union(real.select(F.col("doc_id") + 1000, "text"))
    got = {r.doc_id: (r.n_sentences, r.licenses, r.rest) for r in license_scan.scan_licenses(df).collect()}
    n = len(ODD)
    assert [got[n + i] for i in range(3)] == [(1, "Apache-2.0", ""), (2, "MIT", ""), (2, "CC-BY-NC-4.0", "")]
    c = duckdb.connect()
    documents = df.toPandas()  # noqa: F841  DuckDB reads it by name
    c.register("documents", documents)
    assert {r[0]: r[1:] for r in c.sql(f"select doc_id, n_sentences, licenses, rest from ({license_scan.oracle_sql()})").fetchall()} == got


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
MIT = """MIT License

Copyright (c) 2020 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{0} Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

{1} Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

{2} Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def test_wrapped_licenses(spark):
    plain = [
        (APACHE, (3, "Apache-2.0", "")),
        (MIT, (3, "MIT", "")),
        (BSD.format("1.", "2.", "3."), (4, "BSD-3-Clause", "")),
        (BSD.format("*", "*", "*"), (4, "BSD-3-Clause", "")),
        (BSD.format("(a)", "b)", "(iii)"), (4, "BSD-3-Clause", "")),
        (GPL.format(";", ";", 2), (2, "GPL-2.0-or-later", "")),
        (GPL.format(":", ",", 3), (2, "GPL-3.0-or-later", "")),
        ("x y. Licensed under the Apache\nLicense, Version 2.0.", (1, "Apache-2.0", "")),
        ("Licensed under the Apache\n\nLicense, Version 2.0.", (0, "", "")),
        ("It is not licensed under the MIT License.", (0, "", "")),
        ("All rights reserved. Released under\nthe MIT License (see LICENSE).", (2, "MIT", "")),
    ]
    dress = [lambda t: t, lambda t: t.replace("\n", "\r\n"), *[lambda t, m=m: m + t.replace("\n", "\n" + m) for m in (" * ", "# ", "// ", "rem ")], lambda t: "words\n" + t + "\nwords"]
    texts = [d(t) for t, _ in plain for d in dress]
    got = {r.doc_id: (r.n_sentences, r.licenses, r.rest) for r in license_scan.scan_licenses(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [w for _, w in plain for _ in dress]


def test_more_licenses(spark):
    """Headers as their authors publish them, wrapped and behind comment marks."""
    free = "is free software; you can redistribute it and/or\n * modify it under the terms of the GNU "
    cases = [
        (" * This library " + free + "Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.\n *\n * This library is distributed in the hope that it will be useful,\n * but WITHOUT ANY WARRANTY; without even the implied warranty of\n * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", "LGPL-2.1-or-later"),
        ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Affero General Public License as published\n# by the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.", "AGPL-3.0-or-later"),
        (" * This program " + free + "General Public License version 2 as\n * published by the Free Software Foundation.", "GPL-2.0-only"),
        ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */", "MPL-2.0"),
        ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", "ISC"),
        ("This is free and unencumbered software released into the public domain.\n", "Unlicense"),
        ("// SPDX-License-Identifier: GPL-3.0-or-later\nint x;", "GPL-3.0-or-later"),
        ("# SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/", "Apache-2.0"),
        ("licensed to nobody, permission is a word", ""),
    ]
    got = {r.doc_id: r.licenses for r in license_scan.scan_licenses(docs(spark, [t for t, _ in cases])).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]
    assert license_scan.scan_licenses(docs(spark, ["x"]).limit(0)).count() == 0


def test_license_cues(spark):
    texts = ["All rights  reserved.", "All rights\treserved", "All rights-reserved", "# All rights\n# reserved."]
    assert {(r.n_sentences, r.licenses) for r in license_scan.scan_licenses(docs(spark, texts)).collect()} == {(1, "Proprietary")}
    assert all(any(c in s.split(" ")[i] for c in license_scan.WORDS.split("|") for i in range(len(s.split(" ")))) for s in license_scan.SENTENCES)


def test_language_id(spark, real):
    out = queries.op4_language_id(spark, DIR).join(real.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == real.count() and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    odd = language_id.identify_language(docs(spark, ODD), real).collect()
    assert {r.lang_pred for r in odd if r.doc_id in (0, 1, 2)} == {"und"} and all(0 <= r.score <= 1 for r in odd)
    assert {r.lang_pred for r in language_id.identify_language(real, real.limit(0)).collect()} == {"und"}
    rows = [(None, "½ ² ①"), (None, "the cat and the dog"), (7, "the cat and the dog"), (7, "the cat and the dog"), (7, None), (8, "12 %")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang_pred", F.lit("x"))
    got = sorted((r.doc_id or 0, r.lang_pred, round(r.score, 5)) for r in language_id.identify_language(df, real).collect())
    assert [g for _, g, _ in got].count("und") == 3 and len({x for _, g, x in got if g != "und"}) == 1  # numerals are no letters; ids do not matter
    assert language_id.identify_language(df.limit(0), real).count() == 0


def test_language_kernel(spark, real):
    """The hashed Nystroem model against the exact kernel over n-grams with all texts as landmarks."""
    rows = [r for r in real.orderBy("doc_id").collect() if r.text and r.lang]
    train, test = rows[:120], rows[120:]
    grams = lambda t: {t[i : i + n] for t in [t.lower()] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    a, b = [grams(r.text) for r in train], [grams(r.text) for r in test]
    k = lambda x, y: len(x & y) / np.sqrt(len(x) * len(y))
    langs = sorted({r.lang for r in train})
    y = np.array([[1.0 if r.lang == c else -1.0 for c in langs] for r in train])
    w = np.linalg.solve(np.array([[k(x, z) for z in a] for x in a]) + 0.1 * np.eye(len(a)), y)
    exact = [langs[int((np.array([k(x, z) for z in a]) @ w).argmax())] for x in b]
    model = language_id.Model([r.text for r in train], [r.lang for r in train])
    got = model.predict([r.text for r in test])[0]
    assert sum(x == z for x, z in zip(exact, got, strict=True)) >= 0.98 * len(test)


def test_quality(spark):
    d = "/root/testdata/sf0.01"
    real = spark.read.parquet(f"{d}/documents.parquet")
    out = quality.score_quality(real).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    good = [r for r in out if r.quality == 1]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in out if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in out)
    odd = quality.score_quality(docs(spark, ODD)).collect()
    assert len(odd) == len(ODD) and all(r.score == 0 and not r.kept for r in odd if r.doc_id in (0, 1, 2))
    assert quality.score_quality(real.limit(0)).count() == 0
    same = spark.createDataFrame([(5, "the cat sat on the mat and the dog ran away from it", 1.0)] * 30 + [(None, "$$$ ### !!! |||| $$$$ ###", 2.0)] * 20, "doc_id long, text string, score double")
    got = {(r.doc_id, r.kept) for r in quality.score_quality(same).collect()}
    assert got == {(5, True), (None, False)}


def test_label_model():
    p = quality.fit_label_model({"gg": 900, "bb": 80, "gb": 20, "g-": 100})
    assert p["gg"] > 0.9 > 0.5 > p["bb"] and p["g-"] > 0.5


def test_label_model_document_by_document(spark, real):
    """EM over documents one by one, against EM over patterns of votes."""
    seen = [quality.votes(quality.measures(r.text or "")) for r in real.collect()]
    counts = {v: seen.count(v) for v in set(seen)}
    kinds, start = [quality.GOOD, quality.BAD, quality.ABSTAIN], ((0.70, 0.01, 0.29), (0.45, 0.25, 0.30))
    guess = [0.05 if quality.BAD in v else 0.95 for v in seen]
    for _ in range(50):
        share = (8.5 + sum(guess)) / (10 + len(seen))
        table = []
        for c, weights in enumerate((guess, [1 - g for g in guess])):
            rows = [[10 * start[c][j] + sum(w for w, v in zip(weights, seen, strict=True) if v[i] == kinds[j]) for j in range(3)] for i in range(len(quality.LABELLERS))]
            table.append([[x / sum(row) for x in row] for row in rows])
        odds = [share / (1 - share) * np.prod([table[0][i][kinds.index(x)] / table[1][i][kinds.index(x)] for i, x in enumerate(v)]) for v in seen]
        new = [1 / (1 + np.exp(-np.clip(np.log(o), -30, 30))) for o in odds]
        done, guess = max(abs(a - b) for a, b in zip(new, guess, strict=True)) < 1e-9, new
        if done:
            break
    fitted = quality.fit_label_model(counts)
    assert np.allclose([fitted[v] for v in seen], guess, atol=1e-6)


def test_mixing(spark, real):
    labels = spark.read.parquet(f"{DIR}/labels.parquet").select("doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("domain"))
    base, domains = mixing.posteriors(real, labels)
    p = {r.doc_id: (r.n_tokens, r.p) for r in base.collect()}
    out = {r.doc_id: r.rate for r in mixing.mix_to_targets(real, labels, {"clean": 0.7, "toxic": 0.3}).collect()}
    assert len(out) == real.count() and min(out.values()) >= 0
    total = sum(n for n, _ in p.values())
    shares = [sum(out[d] * n * q[k] for d, (n, q) in p.items()) / total for k in range(2)]
    assert domains == ["clean", "toxic"] and np.allclose(shares, [0.7, 0.3], atol=1e-3)
    odd = mixing.mix_to_targets(docs(spark, ODD), labels.limit(0)).collect()
    assert len(odd) == len(ODD) and {r.rate for r in odd} == {1.0}
    assert mixing.mix_to_targets(real.limit(0), labels).count() == 0


def test_mixing_of_many_domains(spark):
    n, names = 20, [f"d{i:02}" for i in range(20)]
    df = docs(spark, [" ".join(f"w{d}x{j}" for j in range(30)) for d in range(n) for _ in range(6 if d < 10 else 3)])
    labels = spark.createDataFrame([(i, d) for i, d in enumerate(d for k, d in enumerate(names) for _ in range(6 if k < 10 else 3))], "doc_id long, domain string")
    targets = {d: 0.04 if k < 10 else 0.06 for k, d in enumerate(names)}
    base, domains = mixing.posteriors(df, labels)
    assert domains == names
    p = {r.doc_id: (r.n_tokens, r.p) for r in base.collect()}
    out = {r.doc_id: r.rate for r in mixing.mix_to_targets(df, labels, targets).collect()}
    total = sum(t for t, _ in p.values())
    assert np.allclose([sum(out[i] * t * q[k] for i, (t, q) in p.items()) / total for k in range(n)], [targets[d] for d in names], atol=1e-3)


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs_, n = spark.read.parquet(f"{d}/documents.parquet"), []
    scratch = Scratch(spark, "test")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs_ = scratch.save(stage(spark, docs_, d), str(k))
        n.append(docs_.count())
        if k < 4:
            assert docs_.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 200 > n[0] >= n[1] > n[2] > 0 and n[4] == n[3] > 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null and repeated ids, empty and long texts, repeated rows and a table without rows, through ``run``."""
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    real = spark.read.parquet(f"{d}/documents.parquet")
    some = real.filter("n_chars > 400").limit(3).collect()
    odd = [(None, some[0].text), (None, some[0].text), (some[1].doc_id, some[2].text), (some[1].doc_id, some[1].text), (None, None), (None, ""), (-1, (some[1].text + " ") * 60), (None, some[1].text.upper() * 2)]
    extra = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in odd], real.schema)
    for name, table in (("full", real.union(extra)), ("none", real.limit(0))):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.read.parquet(f"{d}/labels.parquet").write.parquet(str(tmp_path / name / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    out = corpus_pipeline.run(spark, str(tmp_path / "full")).collect()
    tok = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    texts = defaultdict(set)
    for r in real.union(extra).collect():
        texts[r.doc_id].add(tuple(tok.encode(r.text or "", add_special_tokens=False).ids))
    assert out and all(tuple(r.ids) in texts[r.doc_id] and r.n_tokens == len(r.ids) for r in out)
    kept = corpus_pipeline._near_duplicates(spark, real.union(extra), str(tmp_path / "full")).collect()
    assert [r.doc_id for r in kept].count(None) <= 3 and sum(r.text == some[0].text for r in kept) <= 1


FOREIGN = [
    "La biblioteca comunale rimane aperta ogni giorno fino alle otto di sera e gli studenti possono prendere in prestito i libri gratuitamente.",
    "Biblioteka miejska jest otwarta codziennie do godziny ósmej wieczorem, a studenci mogą bezpłatnie wypożyczać książki.",
    "Kaupunginkirjasto on avoinna joka päivä kello kahdeksaan asti illalla ja opiskelijat voivat lainata kirjoja maksutta.",
    "Городская библиотека открыта каждый день до восьми часов вечера, и студенты могут бесплатно брать книги.",
    "市图书馆每天开放到晚上八点，学生可以免费借阅图书。",
    "1234567890 987 65 4 a",
]


@pytest.mark.parametrize("langs", [("de", "en", "es", "fr"), ("de", "en", "es"), ("de", "en"), ("en",)])
def test_pipeline_language_rejects(spark, langs):
    import corpus_pipeline

    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", *corpus_pipeline.COLUMNS).filter(F.col("lang").isin(*langs))
    rng = np.random.default_rng(5)
    noise = ["".join(rng.choice(list("qwertyuiopasdfghjklzxcvbnm   "), n)) for n in (100, 1000, 5000)]
    texts = [*FOREIGN, *[t * 20 for t in FOREIGN], *noise]
    odd = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline._language(spark, real.select("doc_id", *corpus_pipeline.COLUMNS).union(odd.select("doc_id", *corpus_pipeline.COLUMNS)), "").select("doc_id").collect()}
    assert not {i for i in kept if i < 0}
    ids = {r.doc_id for r in real.select("doc_id").collect()}
    assert len(kept & ids) >= 0.99 * len(ids)


def test_shingle_sets_of_odd_texts(monkeypatch):
    texts = [None, "", " ", "a", "A b", "\t a\nB  c d ", "x\x0by\x0cz w v", "É a b c d e", "a b c d a b c d", "\x00 a", "\x1c a b c d ", "", "z" * 70_000 + " y"]
    for size in (5, 1 << 21):
        monkeypatch.setattr(shingle_join, "BLOCK_BYTES", size)
        for k in (2, 4):
            known = {}
            for text, got in zip(texts, shingle_join.shingle_sets(pa.array(texts), k), strict=True):
                words = (text or "").encode().lower().split()
                want = {tuple(words)} if 0 < len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
                assert len(want) == len(got)
                assert known.setdefault(frozenset(want), got.tobytes()) == got.tobytes()
            assert len(set(known.values())) == len(known)
