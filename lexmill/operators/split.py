"""Long sections cut into pieces at sentence ends, with a budget of characters."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

#: Behind this a sentence ends: a stop with the white space after it, or a line end.
STOP = "[.!?][ \\t\\r\\n\\f]+|\\n[ \\t\\r\\n\\f]*"
WORD = "[ \\t\\r\\n\\f]*[^ \\t\\r\\n\\f]+[ \\t\\r\\n\\f]*|[ \\t\\r\\n\\f]+"


def sentences(text: Column) -> Column:
    """A text in order, cut behind every stop; what is left at the end, possibly empty, is the last one."""
    return F.zip_with(F.split(text, STOP, -1), F.regexp_extract_all(text, F.lit(STOP), F.lit(0)), lambda s, stop: F.concat(s, F.coalesce(stop, F.lit(""))))


def unit_sizes(text: Column, budget: int) -> Column:
    """Lengths of the parts that stay whole: sentences; the words of a sentence over budget; hard cuts of a word over budget."""
    hard = lambda n: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / budget)), lambda k: F.least(n - k * budget, F.lit(budget)).cast("int"))
    words = lambda s: F.flatten(F.transform(F.regexp_extract_all(s, F.lit(WORD), F.lit(0)), lambda w: F.when(F.length(w) <= budget, F.array(F.length(w))).otherwise(hard(F.length(w)))))
    return F.flatten(F.transform(sentences(text), lambda s: F.when(F.length(s) <= budget, F.array(F.length(s))).otherwise(words(s))))


def soft_split(sections: DataFrame, keys: list[str], budget: int, text_col: str = "text") -> DataFrame:
    """``keys, piece_no (from 1), piece_start, piece_end, text``: pieces of at most ``budget`` characters that join up to the text.

    Pieces take as many whole units as fit, from the left.  Texts within the budget are one piece; null and empty ones give none.  Each
    unit points to the first one that no longer fits behind it, by a window over a range of characters; a piece is a jump along these
    pointers, so the work follows the number of units and only the jumps of one text are made one after the other.  Rows with equal
    keys are texts of their own.  Null keys are kept; further columns are dropped.  Texts over the budget are written to the shared folder.
    """
    if budget < 1:
        raise ValueError("the budget must be positive")
    rows = sections.select(*keys, F.col(text_col).alias("text"))
    short = rows.filter(F.length("text").between(1, budget)).select(*keys, F.lit(1).alias("piece_no"), F.lit(0).alias("piece_start"), F.length("text").alias("piece_end"), "text")
    # Numbers that follow the partitions differ if they are worked out twice, so they are written once.
    long = Scratch(sections.sparkSession, "split").save(rows.filter(F.length("text") > budget).withColumn("row", F.monotonically_increasing_id()), "long")
    sizes = F.filter(unit_sizes(F.col("text"), budget), lambda n: n > 0)
    each = long.select("row", F.length("text").alias("n"), sizes.alias("sizes")).select("row", "n", F.posexplode_outer("sizes").alias("unit", "size"))  # the text isn't carried along
    w = Window.partitionBy("row").orderBy("unit")
    each = each.withColumn("start", F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    ahead = Window.partitionBy("row").orderBy("start").rangeBetween(0, budget)  # starts that a piece from here can reach
    each = each.withColumn("jump", F.when(F.col("n") - F.col("start") > budget, F.col("unit") + F.count(F.lit(1)).over(ahead) - 1).cast("int"))  # null: the rest fits
    path = each.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("unit", "start", "jump"))).alias("us"), F.first("n").alias("n"))
    most = F.floor(F.col("n") * 2 / budget).cast("int") + 2  # any two pieces in a row hold more than the budget
    at = lambda k: F.get("us", k)
    step = lambda a, _: F.when(at(a["unit"])["jump"].isNull(), a).otherwise(F.struct(at(a["unit"])["jump"].alias("unit"), F.array_append(a["cuts"], at(at(a["unit"])["jump"])["start"]).alias("cuts")))
    cuts = F.aggregate(F.sequence(F.lit(1), most), F.struct(F.lit(0).alias("unit"), F.array(F.lit(0)).alias("cuts")), step)["cuts"]
    path = path.select("row", cuts.alias("cuts"))
    end = lambda i: F.coalesce(F.get("cuts", i + 1), F.length("text"))
    parts = F.transform("cuts", lambda c, i: F.struct((i + 1).alias("piece_no"), c.alias("piece_start"), end(i).alias("piece_end"), F.substring("text", c + 1, end(i) - c).alias("text")))
    pieces = long.join(path, "row").select(*keys, parts.alias("parts")).select(*keys, F.inline("parts"))
    return short.unionByName(pieces)


def oracle_pieces(source: str, keys: str, budget: int) -> str:
    """DuckDB: the same for a query with ``keys`` and ``text``, following the cuts by recursion."""
    sent, word = f"(?s).*?(?:{STOP})|.+", WORD
    return f"""with recursive texts as (select row_number() over () as r, {keys}, "text" as t from ({source}) where length("text") > 0),
      sents as (select r, unnest(regexp_extract_all(t, '{sent}')) as s, generate_subscripts(regexp_extract_all(t, '{sent}'), 1) as i from texts where length(t) > {budget}),
      wordy as (select r, i, unnest(case when length(s) <= {budget} then [s] else regexp_extract_all(s, '{word}') end) as w,
        generate_subscripts(case when length(s) <= {budget} then [s] else regexp_extract_all(s, '{word}') end, 1) as j from sents),
      hard as (select r, i, j, w, unnest(range(0, length(w), {budget})) as k from wordy),
      sized as (select r, least(length(w) - k, {budget}) as n, i, j, k from hard),
      placed as (select r, n, coalesce(sum(n) over (partition by r order by i, j, k rows between unbounded preceding and 1 preceding), 0) as a from sized),
      cuts as (select r, cast(0 as bigint) as a, 1 as piece_no from texts union all
        select c.r, cast((select max(p.a) from placed p where p.r = c.r and p.a <= c.a + {budget}) as bigint), piece_no + 1 from cuts c join texts using (r) where length(t) - c.a > {budget}),
      ended as (select r, a, piece_no, lead(a) over (partition by r order by a) as b from cuts)
      select {keys}, cast(piece_no as bigint) as piece_no, cast(a as bigint) as piece_start, cast(coalesce(b, length(t)) as bigint) as piece_end, md5(substring(t, a + 1, coalesce(b, length(t)) - a)) as piece_md5 from ended join texts using (r)"""
