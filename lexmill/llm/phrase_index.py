"""Benchmark passages in training texts, found by a distributed positional inverted index.

The index holds a posting (term, document row, position) for every training word that occurs in the benchmark, written as files
sorted by term.  A phrase of ten words is looked up by its rarest term; the lists of its next rarest terms, shifted by their offsets,
are intersected with what is left, and only survivors meet the lists of all their terms.  Everything is DataFrame operations.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

#: What a word consists of, once A-Z are lower case: digits, a-z, and all beyond ASCII.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
END = -1  # term of the posting that every document has, just behind its last word
SMALL = 500_000  # rows of a table made from the benchmark that is broadcast; larger ones are salted and shuffled
SALTS = 16
LISTS = 3  # lists intersected one after the other, the rarest first, before all terms are compared


@dataclass(frozen=True)
class PhraseIndex:
    """``postings(term, row, pos, doc_id)``, ``terms(word, term, n)`` with corpus counts, ``items(item, item_id, w)`` with their words."""

    postings: DataFrame
    terms: DataFrame
    items: DataFrame
    n_terms: int
    n_words: int
    scratch: Scratch

    @property
    def documents(self) -> DataFrame:
        return self.postings.filter(F.col("term") == END).select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))


def words(text: Column) -> Column:
    """The words of a text in order; none of a null."""
    text = F.coalesce(text, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))  # lower() alone would change É
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _meet(big: DataFrame, small: DataFrame, n: int, on: str, salt: Column) -> DataFrame:
    """Join to a table of ``n`` rows that comes from the benchmark, whatever share of ``big`` one key has."""
    if n <= SMALL:
        return big.join(F.broadcast(small), on)
    small = small.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("salt_", F.pmod(salt, F.lit(SALTS)).cast("int")).join(small, [on, "salt_"]).drop("salt_")


def build_index(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> PhraseIndex:
    """Index all words of whole ``docs`` that occur in ``benchmark``.

    Rows of ``docs`` that repeat an id, or have none, are documents of their own; a null or wordless text has no words.  Rows of
    ``benchmark`` that repeat an id and its words count once; items without words are left out; an item without an id can be hit but not named.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    items = benchmark.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("w")).filter(F.size("w") > 0).distinct()
    items, told = scratch.save_and_tell(items.withColumn("item", F.monotonically_increasing_id()), "items", F.sum(F.size("w")).alias("words"))
    terms = items.select(F.explode("w").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id())
    end = docs.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(END).cast("long").alias("term"))  # no word is empty
    terms, got = scratch.save_and_tell(terms.union(end), "terms")

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))
    tokens = rows.select("row", "doc_id", F.posexplode(F.array_append("w", F.lit(""))).alias("pos", "word"))
    postings = _meet(tokens, terms, got["n"], "word", F.col("pos"))
    postings = postings.select("term", "row", "pos", F.when(F.col("term") == END, F.col("doc_id")).alias("doc_id"))
    postings = scratch.save(postings.sortWithinPartitions("term", "row", "pos"), "postings")
    counts = postings.filter(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    terms = scratch.save(terms.join(counts, "term").select("word", "term", "n"), "counts")  # only terms that occur
    return PhraseIndex(postings, terms, items, got["n"], told["words"] or 0, scratch)


def _ordered(index: PhraseIndex, window: int) -> DataFrame:
    """Every window whose terms all occur: ``item, s, terms``, the terms as (n, term, at) with the rarest first."""
    at = index.items.select("item", F.size("w").alias("size"), F.posexplode("w").alias("at", "word")).join(index.terms, "word")
    known = at.groupBy("item", "size").agg(F.collect_list(F.struct("at", F.struct("n", "term", "at").alias("x"))).alias("xs"))
    known = known.withColumn("xs", F.map_from_entries("xs"))
    length = F.least(F.col("size"), F.lit(window))
    each = known.select("item", "xs", length.alias("len"), F.explode(F.sequence(F.lit(0), F.col("size") - length)).alias("s"))
    found = F.transform(F.sequence(F.col("s"), F.col("s") + F.col("len") - 1), lambda i: F.col("xs")[i])
    return each.select("item", "s", F.array_sort(found).alias("terms")).filter(F.forall("terms", lambda x: x.isNotNull()))


def phrase_hits(index: PhraseIndex, window: int = 10) -> DataFrame:
    """Where ``window`` consecutive item words (all words of a shorter item) occur, as the longest runs: ``row, item_id, first, last``.

    ``first`` and ``last`` are positions of document words.  Runs of different items, or of one item at different shifts, may overlap.
    """
    windows = index.scratch.save(_ordered(index, window), f"windows{window}")
    upto = lambda k: F.transform(F.slice("terms", 1, k), lambda x: x["at"])  # noqa: E731  the places of a window's k rarest terms
    nth = lambda k: F.get("terms", F.lit(k))

    def lists(terms: DataFrame) -> DataFrame:
        return _meet(index.postings.select("term", "row", "pos"), terms.distinct(), index.n_terms, "term", F.col("row"))

    first = windows.select("item", upto(1).alias("path"), nth(0)["term"].alias("term"), nth(0)["at"].alias("at")).distinct()
    alive = _meet(index.postings.select("term", "row", "pos"), first, index.n_words, "term", F.col("row"))
    alive = alive.select("row", F.struct("item", "path").alias("key"), (F.col("pos") - F.col("at")).alias("shift"))
    for k in range(1, LISTS):
        after = windows.select(F.struct("item", upto(k).alias("path")).alias("key"), F.struct("item", upto(k + 1).alias("path")).alias("next"), F.coalesce(nth(k)["term"], F.lit(END)).alias("term"), nth(k)["at"].alias("at"))
        step = _meet(alive, after.distinct(), index.n_words, "key", F.col("row")).withColumn("pos", F.col("shift") + F.col("at"))
        over = step.filter(F.col("term") == END)  # a short item with no further term
        met = step.filter(F.col("term") != END).join(lists(after.filter(F.col("term") != END).select("term")), ["row", "term", "pos"], "left_semi")
        alive = met.unionByName(over).select("row", F.col("next").alias("key"), "shift")
    alive = alive.select("row", F.col("key.item").alias("item"), "shift").distinct()
    alive, told = index.scratch.save_and_tell(alive, f"alive{window}")

    places = windows.select("item", F.explode("terms").alias("x")).select("item", "x.term", "x.at").distinct()
    each = places.groupBy("item").agg(F.collect_list(F.struct("term", "at")).alias("xs"))
    rest = _meet(alive, each, index.n_words, "item", F.col("row")).select("row", "item", "shift", F.inline("xs")).withColumn("pos", F.col("shift") + F.col("at"))
    rows = alive.select("row").distinct()
    postings = index.postings.filter(F.col("term") != END).select("row", "term", "pos").join(F.broadcast(rows) if told["n"] <= SMALL else rows, "row", "left_semi")
    met = rest.join(postings, ["row", "term", "pos"], "left_semi")
    run = F.col("at") - F.row_number().over(Window.partitionBy("row", "item", "shift").orderBy("at"))
    runs = met.withColumn("run", run).groupBy("row", "item", "shift", "run").agg(F.min("at").alias("a"), F.max("at").alias("b"))
    names = index.items.select("item", "item_id", F.least(F.size("w"), F.lit(window)).alias("len"))
    runs = _meet(runs, names, index.n_words, "item", F.col("row")).filter(F.col("b") - F.col("a") + 1 >= F.col("len"))
    return runs.select("row", "item_id", (F.col("shift") + F.col("a")).alias("first"), (F.col("shift") + F.col("b")).alias("last"))


def proximity_hits(index: PhraseIndex, terms: int = 3, within: int = 20) -> DataFrame:
    """Where an item's ``terms`` rarest different terms meet: ``row, item_id, pos``.

    ``pos`` is a place of the rarest one that has each of the others at most ``within`` words away, in any order.  An item with fewer
    different terms is looked up by all it has; one with a term that no document holds is nowhere.
    """
    used = index.items.select("item", "item_id", F.explode(F.array_distinct("w")).alias("word")).join(index.terms, "word", "left")
    used = used.groupBy("item", "item_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("all"))
    used = used.select("item", "item_id", F.slice("all", 1, terms).alias("rare")).filter(F.col("rare")[0]["n"] > 0)
    used = used.select("item", "item_id", F.col("rare")[0]["term"].alias("term"), F.slice("rare", 2, terms).alias("others"))
    postings = index.postings.select("term", "row", "pos").filter(F.col("term") != END)
    places = _meet(postings, used, index.n_words, "term", F.col("row")).select("row", "item", "item_id", "pos", "others")
    cell = lambda c: F.floor(c / (within + 1)).cast("int")
    asked = places.select("row", "item", F.col("pos").alias("at"), F.explode("others.term").alias("term")).withColumn("cell", F.explode(F.array(*[cell(F.col("at")) + k for k in (-1, 0, 1)])))
    others = _meet(postings, used.select(F.explode("others.term").alias("term")).distinct(), index.n_terms, "term", F.col("row"))
    near = asked.join(others.withColumn("cell", cell(F.col("pos"))), ["row", "term", "cell"]).filter(F.abs(F.col("pos") - F.col("at")) <= within)
    near = near.groupBy("row", "item", F.col("at").alias("pos")).agg(F.count_distinct("term").alias("met"))
    found = places.join(near, ["row", "item", "pos"], "left").filter(F.coalesce("met", F.lit(0)) == F.size("others"))
    return found.select("row", "item_id", "pos")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """One row for each document: ``doc_id, n_words, n_hit`` (words inside an occurring window), ``n_items`` (ids with occurring windows),
    ``items_sha256`` (of those ids, sorted as strings and joined by commas) and ``contaminated``.  Nulls and repeats as in ``build_index``."""
    index = build_index(docs, benchmark)
    before = F.max("last").over(Window.partitionBy("row").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first"), F.coalesce(before + 1, F.lit(0))) + 1)
    hits = phrase_hits(index, window).withColumn("new", new)
    hits = hits.groupBy("row").agg(F.sum("new").alias("n_hit"), F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return index.documents.join(hits, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ",").cast("binary"), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


#: The same in DuckDB: every window of an item as a list, met by equality with every window of the same length of a document.
ORACLE_SQL = """with docs as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') as w from documents),
  items as (select distinct item_id, regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') as w from benchmark),
  cut as (select item_id, w, least(len(w), 10) as n from items where len(w) > 0),
  wins as (select distinct item_id, n, list_slice(w, s + 1, s + n) as g from (select item_id, w, n, unnest(range(0, len(w) - n + 1)) as s from cut)),
  sizes as (select distinct n from wins),
  places as (select r, n, s, list_slice(w, s + 1, s + n) as g from (select r, w, n, unnest(range(0, len(w) - n + 1)) as s from docs, sizes where len(w) >= n)),
  met as (select r, item_id, s, wins.n from places join wins on places.n = wins.n and places.g = wins.g),
  spots as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from met) group by r),
  named as (select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from met group by r)
  select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
  from docs left join spots using (r) left join named using (r)"""
