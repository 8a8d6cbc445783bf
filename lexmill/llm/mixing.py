"""Mixing to target weights with soft membership, in DataFrame functions only.

A naive Bayes classifier, fitted on a table of labelled documents, gives every document a posterior over
domains.  Nonnegative document rates are then fitted by distributed projected-gradient least squares, so
that the expected tokens of each domain, ``sum(rate * tokens * posterior)``, meet the targets.
"""

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

SAMPLE = 4000  # labelled documents that fit the classifier: the bound of its sample
WORDS = 32  # words kept for each domain: the classifier's features
ROUNDS, FOLD, CLOSE = 80, 10, 1e-7


def _clues(text: Column) -> Column:
    """A document's distinct words, and steps of its symbol share, vocabulary share and length as words of their own."""
    words = F.filter(F.split(F.lower(text), "[\\s.,]+"), lambda w: w != "")
    return F.struct(F.size(words).cast("long").alias("n"), F.array_distinct(words).alias("w"), F.regexp_count(text, F.lit("[*&%$#|!]")).alias("s"))


def _steps(c: Column) -> Column:
    n = F.greatest(c["n"], F.lit(1))
    sym, voc = c["s"] / n, F.size(c["w"]) / n
    step = lambda name, x, cuts: F.concat(F.lit(f" {name}"), sum(((x >= t).cast("int") for t in cuts), F.lit(0)).cast("string"))
    return F.array(step("symbols", sym, (0.05, 0.2, 0.6)), step("vocabulary", voc, (0.1, 0.25, 0.5, 0.8)), step("length", n, (20, 100, 400, 2000)))


def _read_clues(documents: DataFrame, *more: str) -> DataFrame:
    read = documents.select("doc_id", *more, _clues(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("c"))
    return read.select("doc_id", *more, "c.n", "c.w", _steps(F.col("c")).alias("steps"))


def _classifier(documents: DataFrame, labels: DataFrame, scratch: Scratch):
    """``(domains, prior, {clue: gain for each domain})`` from a bounded sample of labelled documents."""
    labels = labels.select(F.col("doc_id").alias("id_"), F.col("domain").cast("string").alias("domain")).filter("id_ is not null and domain is not null")
    key = F.xxhash64(F.col("id_").cast("string"))
    n = labels.count()
    if n > 4 * SAMPLE:  # keys below a cut, about four times as many rows as are wanted: what a task sends doesn't grow with the tasks
        below = labels.filter(key <= int(-(2**63) + 2**64 * 4 * SAMPLE / n))
        labels = below if below.limit(SAMPLE).count() == SAMPLE else labels
    drawn = labels.orderBy(key, "id_", "domain").limit(SAMPLE).groupBy("id_").agg(F.min("domain").alias("domain"))
    sample = documents.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("id_"))
    named = scratch.save(_read_clues(sample, "domain").select("domain", F.array_union("w", "steps").alias("f")), "sample")
    shares = {r.domain: r["count"] for r in named.groupBy("domain").count().collect()}
    domains = sorted(shares)
    if not domains:
        return [], [], {}
    counts = named.select("domain", F.explode("f").alias("clue")).groupBy("clue", "domain").count()
    total = sum(shares.values())
    size = F.create_map(*[F.lit(x) for d in domains for x in (d, float(shares[d]))])
    counts = counts.withColumn("all_", F.sum("count").over(Window.partitionBy("clue")))
    inside = (F.col("count") + 0.1) / (size[F.col("domain")] + 0.2)
    outside = (F.col("all_") - F.col("count") + 0.1) / (F.lit(float(total)) - size[F.col("domain")] + 0.2)
    best = counts.withColumn("gain", (inside - outside) * F.log(inside / outside)).filter("gain > 0")
    w = Window.partitionBy("domain").orderBy(F.desc("gain"), "clue")
    chosen = best.filter("clue not like ' %'").withColumn("r", F.row_number().over(w)).filter(F.col("r") <= WORDS).select("clue").distinct()
    rows = counts.join(F.broadcast(chosen), "clue").select("clue", "domain", "count").union(counts.filter("clue like ' %'").select("clue", "domain", "count")).collect()  # WORDS words a domain and 14 steps
    table = {}
    for r in rows:
        table.setdefault(r.clue, {})[r.domain] = r["count"]
    prior = np.log(np.array([shares[d] for d in domains]) / sum(shares.values()))
    gains = {}
    for clue, by in sorted(table.items()):
        p = np.array([(by.get(d, 0) + 0.1) / (shares[d] + 0.2) for d in domains])
        if clue.startswith(" "):
            gains[clue] = np.log(p)
        else:  # a word's presence counts against its absence
            gains[clue] = np.log(p) - np.log(1 - np.minimum(p, 0.999))
            prior = prior + np.log(1 - np.minimum(p, 0.999))
    return domains, prior.tolist(), {c: g.tolist() for c, g in gains.items()}


def _array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def posteriors(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """``doc_id, n_tokens long, p array<double>`` and the domains that ``p`` is over."""
    model = _classifier(documents, labels, Scratch(documents.sparkSession, "domains"))
    return _soft(documents, model), model[0] or ["all"]


def _soft(documents: DataFrame, model, carry: tuple[str, ...] = ()) -> DataFrame:
    """The posteriors by a fitted classifier, and the columns in ``carry``."""
    clues = _read_clues(documents, *carry)
    domains, prior, gains = model
    if not domains:
        return clues.select("doc_id", *carry, F.col("n").alias("n_tokens"), _array([1.0]).alias("p"))
    known = F.array(*[F.lit(c) for c in gains])
    gain = F.create_map(*[x for c, g in gains.items() for x in (F.lit(c), _array(g))])
    at = F.array_intersect(F.array_union("w", "steps"), known)
    logit = F.aggregate(at, _array(prior), lambda acc, c: F.zip_with(acc, gain[c], lambda a, b: a + b))
    shares = lambda l: _once(F.transform(l, lambda x: F.exp(x - F.array_max(l))), lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))
    return clues.select("doc_id", *carry, F.col("n").alias("n_tokens"), _once(logit, shares).alias("p"))


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once for each row, however often it is used."""
    return F.transform(F.array(value), then)[0]


def mix_to_targets(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Fit a nonnegative rate for every document so that expected domain tokens meet the targets.

    ``labels(doc_id, domain)`` names the domain of some documents; ``targets`` are domain weights (default: all
    equal), scaled to the corpus' tokens over the domains that have any.  Returns ``doc_id, n_tokens long, domain
    string`` (most likely), ``p_domain double, rate double``, a row for each input row.  A rate says how often a document
    should be read; rates are never negative.  Null and empty texts have 0 tokens.  Null ids, repeated rows and
    very long texts are treated like any others; without labels there is one domain and all rates are 1.  An id with several labels
    has the first domain by name.  If the targets cannot be met in ``ROUNDS`` rounds, a warning names the largest gap.  With
    ``carry``, further columns follow; then the rates' rule is applied to the documents themselves, without a join.
    """
    scratch = Scratch(documents.sparkSession, "mixing")
    model = _classifier(documents, labels, Scratch(documents.sparkSession, "domains"))
    domains, told = model[0] or ["all"], []
    base = scratch.save(_soft(documents, model), "posteriors")
    k = len(domains)
    mass = lambda i: F.col("n_tokens") * F.col("p")[i]
    row = base.agg(*[F.sum(mass(i)).alias(f"m{i}") for i in range(k)], F.sum("n_tokens").alias("all")).first()
    total = float(row["all"] or 0)
    goal = np.array([max(0.0, float((targets or {}).get(d, 0.0 if targets else 1.0))) for d in domains])
    rate = base.withColumn("rate", F.lit(1.0))
    if total and goal.sum():
        m = np.array([row[f"m{i}"] for i in range(k)]) / total
        goal = np.where(m > 1e-9, goal, 0)
        goal = goal / goal.sum() if goal.sum() else m
        # With u = rate * sqrt(tokens) and residuals weighted by s, a projected-gradient step on u is rate - step * p . (s r).
        # As posteriors sum to 1, the weighted matrix of domain overlaps has 1 as its largest eigenvalue, so the step is 1.
        s = 1 / np.maximum(m, 1e-9)
        rate, moves = scratch.save(rate, "rate0"), []
        for i in range(1, ROUNDS + 1):
            now = rate.withColumn("rate", _after(moves)) if moves else rate
            sums = now.agg(*[F.sum(F.col("rate") * mass(j)) for j in range(k)]).first()
            r = np.array([float(x or 0) for x in sums]) / total - goal
            if np.abs(r).max() < CLOSE:
                break
            moves.append((s * r).tolist())
            told.append(moves[-1])
            if len(moves) == FOLD:
                new = scratch.save(rate.withColumn("rate", _after(moves)), f"rate{i}")
                rate, moves = new, []
                scratch.drop(f"rate{i - FOLD}")
        else:
            if np.abs(r).max() > 1e-3:
                warnings.warn(f"the mixture misses a target by {np.abs(r).max():.2g} of all tokens after {ROUNDS} rounds", stacklevel=2)
        rate = rate.withColumn("rate", _after(moves)) if moves else rate
    names = _names(domains)
    said = lambda p, r: F.struct(names[(F.array_position(p, F.array_max(p)) - 1).cast("int")].alias("domain"), F.array_max(p).alias("p_domain"), r.alias("rate"))
    if carry:
        rate = _soft(documents, model, carry)
        out = _once(F.col("p"), lambda p: said(p, _after(told, p, F.lit(1.0)) if told else F.lit(1.0)))
    else:
        out = said(F.col("p"), F.col("rate"))
    return rate.select("doc_id", *carry, "n_tokens", out.alias("out_")).select("doc_id", *carry, "n_tokens", "out_.domain", "out_.p_domain", "out_.rate")


def _names(domains: list[str]) -> Column:
    return F.array(*[F.lit(d) for d in domains])


def _after(moves: list[list[float]], p: Column | None = None, rate: Column | None = None) -> Column:
    """The rate after a few projected-gradient moves."""
    p = F.col("p") if p is None else p

    def one(w: Column, g: Column) -> Column:
        return F.greatest(F.lit(0.0), w - F.aggregate(F.zip_with(p, g, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b))

    return F.aggregate(F.array(*[_array(g) for g in moves]), F.col("rate") if rate is None else rate, one)
