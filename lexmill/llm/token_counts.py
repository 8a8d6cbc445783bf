"""Token counts of a unigram vocabulary without building tokens.

Aho-Corasick enumerates the vocabulary's pieces at every end position; dynamic programming carries the best
score and its number of pieces.  Ties go to the piece that starts first, since a later candidate replaces an
earlier one only with a higher score.  A character that no piece of its own covers costs the lowest score less 10
and counts its UTF-8 bytes, each of which has a piece.
"""

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Table, bounded_batches, chunks, cut_at_blanks, held, slices, tidied

MARK = "▁"  # stands for a blank
PENALTY = 10.0
PARTS = 24 << 20  # bytes of a worker's table of parts of words, about


class UnigramCounter:
    """Counts for ``(piece, score)`` pairs; every blank starts a new word."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.auto = ahocorasick.Automaton()
        for p, s in pieces:
            if p and not self.auto.exists(p):
                self.auto.add_word(p, (len(p), float(s)))
        self.auto.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - PENALTY
        # With whole-number scores sums are exact, so a character of no piece may part a word without a change.
        self.parted = all(float(s).is_integer() for _, s in pieces) and not any("\n" in p for p, _ in pieces)
        self.parts = Table(lambda words: [self.viterbi(w) for w in words], PARTS)
        self.table = Table(lambda words: [self._word(MARK + w.removeprefix(" ")) for w in words])

    def viterbi(self, word: str) -> int:
        n = len(word)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for e, m in self.auto.iter(word):  # longest first
            ends[e].append(m)
        for e in range(n):
            top, k = None, 0
            for size, score in ends[e]:
                s = best[e + 1 - size] + score
                if top is None or s > top:
                    top, k = s, count[e + 1 - size] + 1
            if word[e] not in self.single:
                s = best[e] + self.unknown
                if top is None or s > top:
                    top, k = s, count[e] + len(word[e].encode("utf-8", "replace"))
            best[e + 1], count[e + 1] = top, k
        return count[n]

    def _word(self, word: str) -> int:
        if not self.parted or "\n" not in word:
            return self.viterbi(word)
        parts = [p for p in word.split("\n") if p]
        known = dict(zip(set(parts), self.parts(list(set(parts))), strict=True))
        return word.count("\n") + sum(map(known.__getitem__, parts))

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of pieces of each text; none of a null text."""
        if pc.any(pc.match_substring(texts, MARK)).as_py():
            texts = pc.replace_substring(texts, MARK, " ")
        words, at, bounds = chunks(texts, cut_at_blanks)
        sums = np.concatenate([[0], np.cumsum(np.array(self.table(words), np.int64)[at] if len(at) else [])]).astype(np.int64)
        return np.diff(sums[bounds])


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, read as a unigram vocabulary."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


def count_tokens(documents: DataFrame, model: str, carry: list[str] | None = None) -> DataFrame:
    """``doc_id, n_tokens long`` and the columns in ``carry``: the number of unigram pieces of every whole text.

    ``model`` is a path on the executors.  A row for each input row; null and empty texts have 0 tokens.  Null or
    repeated ids and very long texts are handled like any others; further columns are ignored.
    """
    carry = carry or []
    kept = documents.select("doc_id", *carry, F.col("text").cast("string").alias("text_"))

    def run(batches):
        counter = held(("unigram", model), lambda: UnigramCounter(vocabulary(model)))
        for batch in batches:
            for part in slices(batch, "text_"):
                n = counter.count(part.column("text_"))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("doc_id", *carry)], pa.array(n, pa.int64())], names=["doc_id", *carry, "n_tokens"])

    bounded_batches(documents.sparkSession)
    return kept.mapInArrow(tidied(run, keeps=True), kept.drop("text_").schema.add("n_tokens", "long"))
