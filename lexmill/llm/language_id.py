"""Language ID by a string kernel with Nystroem landmarks and one-versus-rest kernel ridge regression."""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import bounded_batches, slices, tidied

GRAMS = 3  # the blended spectrum: character n-grams of 1 to GRAMS
WIDTH = 1 << 16  # hashed presence features
SAMPLE, LANDMARKS = 250, 16  # labelled documents and landmarks for each language: the bound of the training sample
LONG = 20_000  # longer texts enter the sample only where shorter ones do not fill it
RIDGE, SHARPNESS = 0.3, 4.0
BATCH = 128
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def presence(text: str, out: np.ndarray) -> None:
    """Set ``out`` at the hash of every n-gram of the lower-cased text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    h = np.zeros(len(c), np.uint32)
    for n in range(1, GRAMS + 1):
        if len(c) < n:
            break
        h = (h[: len(c) - n + 1] if n == 1 else h[:-1]) * np.uint32(0x01000193) + (c[n - 1 :] + np.uint32(n)) * np.uint32(0x9E3779B1)
        out[(h * np.uint32(0x85EBCA6B)) >> np.uint32(16)] = True


class Model:
    """Landmark presence (columns x landmarks), landmark norms and regression weights (landmarks x languages)."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        flags = np.zeros((len(texts), WIDTH), bool)
        for row, t in zip(flags, texts, strict=True):
            presence(t, row)
        seen, marks = {}, []
        for i, g in enumerate(langs):
            seen[g] = seen.get(g, 0) + 1
            if seen[g] <= LANDMARKS:
                marks.append(i)
        land = flags[marks]
        self.columns = np.flatnonzero(land.any(0))
        self.land = land[:, self.columns].T.astype(np.float32)
        self.norm = np.sqrt(np.maximum(1, land.sum(1))).astype(np.float32)
        of = np.array([langs[i] for i in marks])
        self.held = np.array([land[of == c][:, self.columns].any(0) for c in self.langs]).T.astype(np.float32)
        k = self.kernel(flags).astype(np.float64)
        val, vec = np.linalg.eigh(k[marks])
        keep = val > 1e-8 * val.max()
        root = vec[:, keep] / np.sqrt(val[keep])  # Nystroem: z = k(x, landmarks) K^-1/2
        z = np.hstack([k @ root, np.ones((len(k), 1))])
        y = np.array([[1.0 if g == c else -1.0 for c in self.langs] for g in langs])
        share = np.array([1 / langs.count(g) for g in langs])[:, None]
        w = np.linalg.solve(z.T @ (share * z) + RIDGE * 1e-2 * np.eye(z.shape[1]), z.T @ (share * y))
        # For the margin, without an offset: a text like no landmark gets -1 for every language, also where there are one or two.
        near = z[:, :-1]
        v = np.linalg.solve(near.T @ (share * near) + RIDGE * 1e-2 * np.eye(near.shape[1]), near.T @ (share * (y + 1)))
        self.own = (root @ v).astype(np.float32)
        self.weights, self.offset = (root @ w[:-1]).astype(np.float32), w[-1].astype(np.float32)

    def kernel(self, flags: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(1, flags.sum(1))).astype(np.float32)
        return flags[:, self.columns].astype(np.float32) @ self.land / size[:, None] / self.norm

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The language of each text, its score, its margin and the known share of the text's n-grams."""
        flags, some = np.zeros((min(BATCH, len(texts)), WIDTH), bool), []
        lang, score, margin, known = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), -1.0), np.zeros(len(texts))
        if not self.langs:
            return lang, score, margin, known
        for at in range(0, len(texts), BATCH):
            some = [i for i in range(at, min(at + BATCH, len(texts))) if texts[i] is not None and _LETTER.search(texts[i])]
            if not some:
                continue
            flags[:] = False
            for row, i in zip(flags, some, strict=False):
                presence(texts[i], row)
            k = self.kernel(flags[: len(some)])
            f, m = SHARPNESS * (k @ self.weights + self.offset).astype(np.float64), (k @ self.own - 1).astype(np.float64)
            p = np.exp(f - f.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            share = flags[: len(some), self.columns].astype(np.float32) @ self.held / np.maximum(1, flags[: len(some)].sum(1))[:, None]
            for j, i in enumerate(some):
                c = int(p[j].argmax())
                lang[i], score[i], margin[i], known[i] = self.langs[c], p[j].max(), m[j, c], share[j, c]
        return lang, score, margin, known


def train(labelled: DataFrame) -> Model:
    """Fit on at most SAMPLE documents of each language of ``labelled(doc_id, text, lang)``.

    The ids are drawn first, so that only the texts of the sample leave their tasks; of rows that repeat an id in one
    language the one with the smallest hash of its text counts.
    """
    labelled = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
    key, mark = F.xxhash64(F.col("doc_id").cast("string")), F.xxhash64("text")
    ids = labelled.select("lang", key.alias("key"), mark.alias("mark"), (F.length("text") > LONG).alias("long"))
    ids = _first_of_each(ids)
    if not ids:
        return Model([], [])
    wanted = documents_of(labelled, {(r.lang, r.key, r.mark) for r in ids})
    texts = {(x.lang, x.key, x.mark): x.text for x in wanted}
    got = [(r.lang, texts[r.lang, r.key, r.mark]) for r in sorted(ids, key=lambda r: (r.lang, r.r)) if (r.lang, r.key, r.mark) in texts]
    got = [(g, t) for g, t in got if _LETTER.search(t)]
    return Model([t for _, t in got], [g for g, _ in got])


def _first_of_each(ids: DataFrame) -> list:
    """The first SAMPLE rows of each language by length class, key and mark, with their rank as ``r``.

    Of a language with many short texts only keys below a cut are ranked, about four times as many as are wanted, so that what a task
    sends doesn't grow with the number of tasks; should the cut leave too few, the language is ranked whole.
    """
    w = Window.partitionBy("lang").orderBy("long", "key", "mark")
    short = {r.lang: r.n for r in ids.groupBy("lang").agg(F.sum((~F.col("long")).cast("long")).alias("n")).collect()}  # a row for each language
    cuts = {lang: int(-(2**63) + 2**64 * 4 * SAMPLE / n) for lang, n in short.items() if n > 4 * SAMPLE}
    ranked = lambda df: df.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= SAMPLE).collect()
    if not cuts:
        return ranked(ids)
    below = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])
    got = ranked(ids.filter(F.coalesce(F.col("key") <= F.try_element_at(below, F.col("lang")), F.lit(True))))
    few = [lang for lang in cuts if sum(r.lang == lang and not r.long for r in got) < SAMPLE]
    return got if not few else [r for r in got if r.lang not in few] + ranked(ids.filter(F.col("lang").isin(few)))


def documents_of(labelled: DataFrame, wanted: set[tuple[str, int, int]]) -> list:
    """The texts of a bounded set of (language, hash of id, hash of text), each once."""
    spark = labelled.sparkSession
    marks = F.broadcast(spark.createDataFrame(sorted(wanted), "lang string, key long, mark long"))
    rows = labelled.select("lang", F.xxhash64(F.col("doc_id").cast("string")).alias("key"), F.xxhash64("text").alias("mark"), "text")
    return rows.join(marks, ["lang", "key", "mark"]).dropDuplicates(["lang", "key", "mark"]).collect()


def identify_language(documents: DataFrame, labelled: DataFrame, carry: list[str] | None = None, margins: bool = False) -> DataFrame:
    """Predict the language of every whole text.

    Returns ``doc_id, lang_pred string, score double`` (0 to 1) and the columns named in ``carry``, a row for each input
    row.  ``und`` with score 0 for a null text, one without a letter, or if there is nothing to learn from.  Rows with
    null ids, repeated rows and very long texts are predicted like any others; further columns are ignored.

    ``score`` is relative to the learned languages.  With ``margins``, two columns that are not follow: ``margin double``,
    the language's own regression value (trained towards 1 for its texts and -1 for others; -1 without similarity), and ``known double``, the
    share of the text's n-grams that the language's landmarks hold; -1 and 0 for ``und``.
    """
    carry = carry or []
    model = documents.sparkSession.sparkContext.broadcast(train(labelled))
    kept = documents.select("doc_id", *carry, F.col("text").cast("string").alias("text_"))
    extra = ["margin", "known"] if margins else []
    schema = kept.drop("text_").schema.add("lang_pred", "string").add("score", "double")
    for c in extra:
        schema = schema.add(c, "double")

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "text_")):
            lang, *numbers = model.value.predict(batch.column("text_").to_pylist())
            cols = [batch.column(c) for c in ("doc_id", *carry)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lang, pa.string()), *[pa.array(x, pa.float64()) for x in numbers[: 1 + len(extra)]]], names=["doc_id", *carry, "lang_pred", "score", *extra])

    bounded_batches(documents.sparkSession)
    return kept.mapInArrow(tidied(run), schema)
