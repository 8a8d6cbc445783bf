"""Ordered funnels counted by strict as-of joins over short time ranges of each client.

A row goes to its client's time range and, as halo, to the ranges before it whose attempts may still reach it.  Ranges are sorted
within partitions, and DuckDB joins them a few at a time: one as-of join for each step and one for each exclusion.  Spark adds up
the ranges of a client and ranks the times; a client with a third of all rows is spread over as many tasks as it has ranges.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

SECOND = 1_000_000
RANGE = 4 * 3600 * SECOND  # microseconds of a range
ROWS = 200_000  # rows that DuckDB joins at once, unless one range has more
FINE = 1 << 16  # times are ranked by their quotient first, then by their remainder: at most 27,466 and 65,536 of them for 30 minutes
FOUND = "funnel string, client_id long, step int, took long, n long"


@dataclass(frozen=True)
class Funnel:
    """Ordered kinds, and a kind that ends an attempt if it lies between two steps."""

    name: str
    steps: tuple[str, ...]
    excluded: str | None = None


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp, of one without a zone whatever the session's zone is."""
    if dict(df.dtypes)[name] != "timestamp_ntz":
        return F.unix_micros(F.col(name).cast("timestamp"))
    second = (F.expr(f"extract(second from `{name}`)") * SECOND).cast("long")
    return ((F.unix_date(F.col(name).cast("date")).cast("long") * 24 + F.hour(name)) * 60 + F.minute(name)) * (60 * SECOND) + second


def attempts_sql(f: Funnel, within: int) -> str:
    """The steps that attempts reach in table ``r(client, block, kind, ts)``, by client, step and time taken."""
    kinds = [k.replace("'", "''") for k in f.steps]
    out = [f"s1 as (select client, block, ts as first, ts from r where kind = '{kinds[0]}' and ts >= block and ts < block + {RANGE})"]
    for k, kind in enumerate(kinds[1:], 2):
        ahead = f"select p.*, n.ts as next from s{k - 1} p asof join (select client, block, ts from r where kind = '{kind}') n on p.client = n.client and p.block = n.block and p.ts < n.ts"
        out.append(f"a{k} as ({ahead})")
        if f.excluded is not None:
            kind = f.excluded.replace("'", "''")
            out.append(f"x{k} as (select p.*, e.ts as bad from a{k} p asof left join (select client, block, ts from r where kind = '{kind}') e on p.client = e.client and p.block = e.block and p.ts < e.ts)")
            out.append(f"s{k} as (select client, block, first, next as ts, next - ts as took from x{k} where next - first <= {within} and (bad is null or bad > next))")
        else:
            out.append(f"s{k} as (select client, block, first, next as ts, next - ts as took from a{k} where next - first <= {within})")
    counted = ["select client, 1 as step, cast(null as bigint) as took, count(*) as n from s1 group by client"]
    counted += [f"select client, {k} as step, took, count(*) as n from s{k} group by client, took" for k in range(2, len(kinds) + 1)]
    name = f.name.replace("'", "''")
    return f"with {', '.join(out)} select '{name}' as funnel, client as client_id, cast(step as integer) as step, took, n from ({' union all '.join(counted)})"


def whole_ranges(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows of batches sorted by client and block, cut where a range ends."""
    held, n, need = [], 0, rows
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < need:
            continue
        t = pa.Table.from_batches(held)
        client, block = t["client"].to_numpy(), t["block"].to_numpy()
        last = int(((client != client[-1]) | (block != block[-1])).sum())  # the last range may go on; rows before it are sorted
        if last:
            yield t.slice(0, last)
        held, n = t.slice(last).combine_chunks().to_batches(), t.num_rows - last
        need = max(rows, 2 * n)  # one range larger than all grows before it is looked at again
    if held:
        yield pa.Table.from_batches(held)


def _joined(funnels: Sequence[Funnel], within: int):
    queries = [attempts_sql(f, within) for f in funnels]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        schema = pa.schema([("funnel", pa.string()), ("client_id", pa.int64()), ("step", pa.int32()), ("took", pa.int64()), ("n", pa.int64())])
        with duckdb.connect(config={"threads": 1, "memory_limit": "800MB", "temp_directory": ""}) as con:
            for t in whole_ranges(batches, ROWS):
                con.register("given", t)
                con.execute("create or replace temp table r as select * from given")
                con.unregister("given")
                for q in queries:
                    yield from con.sql(q).to_arrow_table().cast(schema).to_batches(max_chunksize=10_000)

    return run


def ranked_times(found: DataFrame, share: int) -> DataFrame:
    """The ``ceil(share * n / 100)``-th smallest time of each funnel, client and step, as (funnel, client_id, step, took).

    No task holds more than the quotients, or the remainders of one quotient, of a group: times beyond that are counts.
    """
    key = ["funnel", "client_id", "step"]
    fine = found.filter("step > 1").withColumn("high", F.floor(F.col("took") / FINE)).groupBy(*key, "high", "took").agg(F.sum("n").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy(*key).orderBy("high").rowsBetween(Window.unboundedPreceding, 0))
    high = fine.groupBy(*key, "high").agg(F.sum("n").alias("n")).withColumn("upto", so_far).withColumn("all", F.sum("n").over(Window.partitionBy(*key)))
    wanted = F.floor((F.col("all") * share + 99) / 100)
    high = high.withColumn("rest", wanted - F.col("upto") + F.col("n")).filter("rest > 0 and rest <= n").select(*key, "high", "rest")
    so_far = F.sum("n").over(Window.partitionBy(*key, "high").orderBy("took").rowsBetween(Window.unboundedPreceding, 0))
    low = fine.join(high, [*key, "high"]).withColumn("upto", so_far)
    return low.filter("rest <= upto and rest > upto - n").select(*key, "took")


def ordered_funnels(rows: DataFrame, funnels: Sequence[Funnel], *, client: str = "client_id", kind: str = "kind", at: str = "arrived_at", within_s: int = 1800, share: int = 90) -> DataFrame:
    """Attempts of each client that reach each step of each funnel.

    Rows that repeat a client, kind and time count once; a null in any of the three leaves the row out.  Each row of a funnel's first
    kind starts an attempt.  Its next step is the client's earliest row of the next kind *later* than the step before; the attempt
    ends if there is none, if it is over ``within_s`` seconds after the first, or if a row of the excluded kind lies after the step
    before and not after it.  Attempts may share rows.  An empty table gives no rows; other columns are ignored, whatever their names.

    Returns for each funnel and client with attempts ``funnel, client_id, n1.. (attempts that reach a step), deepest int, t2..
    (the ceil(share * n / 100)-th smallest of the step's microseconds from the step before, null if none), same_depth`` (clients of the
    same funnel and deepest step, itself included).  Funnels may differ in length; missing steps are 0 and null.
    """
    spark, within = rows.sparkSession, within_s * SECOND
    scratch = Scratch(spark, "funnel")
    kinds = sorted({k for f in funnels for k in (*f.steps, f.excluded) if k is not None})
    base = rows.select(F.col(client).cast("long").alias("client"), F.col(kind).cast("string").alias("kind"), micros(rows, at).alias("ts"))
    base = base.filter(F.col("client").isNotNull() & F.col("ts").isNotNull() & F.col("kind").isin(kinds)).distinct()
    start = lambda c: c - F.pmod(c, F.lit(RANGE))
    blocks = F.sequence(start(F.col("ts") - within), start(F.col("ts")), F.lit(RANGE))
    ranges = base.withColumn("block", F.explode(blocks)).repartition("client", "block").sortWithinPartitions("client", "block")
    found = scratch.save(ranges.mapInArrow(_joined(funnels, within), FOUND), "found")

    depth = max(len(f.steps) for f in funnels)
    steps = range(1, depth + 1)
    counts = found.groupBy("funnel", "client_id").agg(*[F.coalesce(F.sum(F.when(F.col("step") == k, F.col("n"))), F.lit(0)).alias(f"n{k}") for k in steps], F.max("step").alias("deepest"))
    times = ranked_times(found, share).groupBy("funnel", "client_id").agg(*[F.max(F.when(F.col("step") == k, F.col("took"))).alias(f"t{k}") for k in steps[1:]])
    clients = scratch.save(counts.join(times, ["funnel", "client_id"], "left"), "clients")
    same = clients.groupBy("funnel", "deepest").agg(F.count(F.lit(1)).alias("same_depth"))  # a row for each funnel and step at most
    return clients.join(F.broadcast(same), ["funnel", "deepest"]).select("funnel", "client_id", *[f"n{k}" for k in steps], "deepest", *[f"t{k}" for k in steps[1:]], "same_depth")


def oracle_sql(funnels: Sequence[Funnel]) -> str:
    """The same over the whole table ``clicks``, without ranges, as-of joins or ranks by digits."""
    parts = []
    for f in funnels:
        a, b, c, d = f.steps

        def step(k: int, kind: str, x: str = f.excluded) -> str:
            after = f"(select min(ts) from c n where n.client_id = p.client_id and n.kind = '{kind}' and n.ts > p.ts)"
            bad = f"(select min(ts) from c e where e.client_id = p.client_id and e.kind = '{x}' and e.ts > p.ts)"
            return f"s{k} as (select client_id, first, next as ts, epoch_us(next) - epoch_us(ts) as took from (select client_id, first, ts, {after} as next, {bad} as bad from s{k - 1} p) where epoch_us(next) - epoch_us(first) <= 1800000000 and (bad is null or bad > next))"

        inner = f"with s1 as (select client_id, ts as first, ts from c where kind = '{a}'), {step(2, b)}, {step(3, c)}, {step(4, d)}"
        rows = " union all ".join(f"select client_id, {k} as step, {'took' if k > 1 else 'cast(null as bigint) as took'} from s{k}" for k in range(1, 5))
        parts.append(f"select '{f.name}' as funnel, * from ({inner} {rows})")
    nth = ", ".join(f"list_sort(list(took) filter (where step = {k}))[cast(floor((90 * n{k} + 99) / 100) as bigint)] as t{k}" for k in (2, 3, 4))
    counts = ", ".join(f"count(*) filter (where step = {k}) as n{k}" for k in range(1, 5))
    return f"""with c as (select distinct client_id, kind, arrived_at as ts from clicks where client_id is not null and kind is not null and arrived_at is not null),
      every as ({' union all '.join(parts)}), counted as (select funnel, client_id, {counts}, max(step) as deepest from every group by funnel, client_id),
      timed as (select funnel, client_id, {nth} from every join counted using (funnel, client_id) group by funnel, client_id, n2, n3, n4)
      select funnel, client_id, n1, n2, n3, n4, cast(deepest as integer) as deepest, t2, t3, t4, count(*) over (partition by funnel, deepest) as same_depth from counted join timed using (funnel, client_id)"""
