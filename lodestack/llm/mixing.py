"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source is a queue in shuffled order (the MD5 of seed and id). The k-th pass over a document finishes at
virtual time (k * source tokens + cumulative tokens in the queue) / target. All (document, pass) entries are
range-sorted by finish time (repartitionByRange and a sort in each range) and cut where the total budget is reached.

A source may hold any share of the rows: a queue is dealt by ranges of the shuffle key into slices of about
``width`` rows, the slices' sums are partial aggregates, and only the slices' sums (not rows) meet in one
window per source. The cut is found from the sums of the sorted ranges and, in the one range where it lies, by a histogram:
each step sends one row to the driver, whatever the input's size.

Cases: a null text has size 0 and is taken 0 words; a null source is a source of its own, last in order;
repeated ids keep one place each (ties are broken by size and text hash); texts of any length are counted whole; an empty table
gives an empty result; other columns, whatever their names, are not read by mix() and pass through mixed().
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh, slices_of, small, table

WEIGHTS = (5.0, 2.0, 1.0)
#: A queue is passed at most this often.
PASSES = 2
LEVEL = 4096
#: Entries in a range of the global sort, and the most ranges.
RANGE, MOST_RANGES = 50_000, 10_000


def row_key(id_col: str, text_col: str, source_col: str):
    """128 bits of a row, by which rows that agree in id, source and text are found again."""
    key = F.col(id_col), F.col(source_col), F.col(text_col)
    return F.struct(F.xxhash64(*key).alias("a"), F.xxhash64(F.lit(7), *key).alias("b"))


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words.cast("long").alias("size"), key.alias("key"), row_key(id_col, text_col, source_col).alias("tie"))


def targets(per_source: DataFrame, share: float = 1.5, weights: tuple = WEIGHTS, most: float = float(PASSES)) -> DataFrame:
    """source, source_size, target: weights cycle over sources by code point, null last; excess over ``most`` times
    a source's size is reshared by weight. Sources in order of cap per weight fill up first, so one pass of running
    sums finds the level. per_source has one row per source."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    everything = Window.partitionBy()
    rows = per_source.select("source", "source_size", weight.alias("w"), (F.lit(float(most)) * F.col("source_size")).alias("cap"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("w"))
    before = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(everything)).alias("budget"),
        F.sum("w").over(everything).alias("all_w"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("caps"),
        F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("ws"),
    )
    rows = rows.withColumn("capped", F.col("ratio") * (F.col("all_w") - F.col("ws")) <= F.col("budget") - F.col("caps"))
    rows = rows.withColumn("full", F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0)))
    rows = rows.withColumn("full_w", F.coalesce(F.sum(F.when(F.col("capped"), F.col("w"))).over(everything), F.lit(0.0)))
    level = (F.col("budget") - F.col("full")) * F.col("w") / (F.col("all_w") - F.col("full_w"))
    return rows.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(level).alias("target"))


def queued(rows: DataFrame, n_rows: int, width: int) -> DataFrame:
    """Adds cum: tokens of the source up to and including this document, in shuffled order."""
    slices = slices_of(n_rows, width)
    part = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / (2.0**32 / slices)).cast("long")
    rows = rows.withColumn("part", part)
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = table(sums.select("source", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("offset")), "mix-offsets")
    inside = Window.partitionBy("source", "part").orderBy("key", F.col("doc_id").isNull(), "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("local", F.sum("size").over(inside))
    offsets = small(sums.select(F.col("source").alias("s"), F.col("part").alias("p"), "offset"))
    out = local.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")), "left")
    return out.select("doc_id", "source", "size", "tie", (F.col("offset") + F.col("local")).alias("cum"))


def in_order(entries: DataFrame) -> DataFrame:
    """The global queue: entries (size, vft) sorted by finish time, with the number of the range that each lies in."""
    ranges = max(1, min(MOST_RANGES, -(-entries.count() // RANGE)))
    line = entries.repartitionByRange(ranges, "vft").sortWithinPartitions("vft")
    return table(line.select("size", "vft", F.spark_partition_id().alias("range")), "mix-line")


def budget_cut(line: DataFrame, budget: float) -> float:
    """Finish time of the first entry of the sorted line that no longer fits: those before it are taken. Entries that finish
    at the same time are taken or left together.

    Sums by range (at most MOST_RANGES rows) show the range in which the budget ends; that range alone is looked at further."""
    sums = line.groupBy("range").agg(F.sum("size").alias("size"), F.min("vft").alias("first"))
    running = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    over = sums.withColumn("run", F.sum("size").over(running)).filter(F.col("run") > F.lit(budget)).orderBy("run").limit(1).collect()
    if not over:
        return float("inf")
    inside = line.filter(F.col("range") == over[0]["range"])
    return _cut_inside(inside, budget - (over[0]["run"] - over[0]["size"]))


def _cut_inside(entries: DataFrame, budget: float) -> float:
    """The same within one range, by histograms of finish times: each level sends one row to the driver."""
    low, high = entries.agg(F.min("vft"), F.max("vft")).first()
    high, spent = high * (1 + 2**-50), 0
    while True:
        step = (high - low) / LEVEL
        exact = step <= 1e-13 * high
        at = F.col("vft") if exact else F.floor((F.col("vft") - F.lit(low)) / F.lit(step))
        inside = entries.filter((F.col("vft") >= F.lit(low)) & (F.col("vft") < F.lit(high)))
        histogram = inside.groupBy(at.alias("at")).agg(F.sum("size").alias("size"), F.max("vft").alias("last"), F.min("vft").alias("first"))
        running = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        over = histogram.withColumn("run", F.sum("size").over(running)).filter(F.col("run") + F.lit(spent) > F.lit(budget))
        row = over.orderBy("at").limit(1).collect()[0]
        if exact or row["first"] == row["last"]:
            return row["first"]
        spent += row["run"] - row["size"]
        low, high = row["first"], row["last"] * (1 + 2**-50)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5, weights: tuple = WEIGHTS, seed: str = "mix-1:", width: int = 4_000) -> DataFrame:
    """Row per document: doc_id, source, size, source_size, target, taken, times and the row's key."""
    rows = table(sizes(docs, id_col, text_col, source_col, seed), "mix-sizes")
    per_source = table(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, weights), "mix-targets")
    n_rows = rows.count()
    line = queued(rows, n_rows, width)
    goal = small(per_source.select(F.col("source").alias("goal_source"), "source_size", "target"))
    line = line.join(goal, F.col("source").eqNullSafe(F.col("goal_source")), "left").drop("goal_source")
    line = table(line, "mix-queues")

    def finish(k: int):
        return F.when(F.col("target") > 0, (F.lit(k) * F.col("source_size") + F.col("cum")) / F.col("target")).otherwise(F.lit(0.0))

    entries = None
    for k in range(PASSES):
        one = line.filter("size > 0").select("size", finish(k).alias("vft"))
        entries = one if entries is None else entries.unionByName(one)
    budget = share * (per_source.agg(F.sum("source_size")).first()[0] or 0)
    cut = budget_cut(in_order(entries), budget)
    times = sum((F.when(finish(k) < F.lit(cut), 1).otherwise(0) for k in range(PASSES)), F.lit(0))
    times = F.when(F.col("size") > 0, times).otherwise(0)
    return line.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"), times.alias("times"), "tie")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of docs as often as it is taken, all columns as they came. Rows that agree in id,
    source and text are taken alike, as often as the one taken most. Documents without words are not taken."""
    taken = mix(docs, id_col, text_col, source_col, **options)
    tie, times, copy = (fresh(docs, x) for x in ("__tie", "__times", "__copy"))
    often = taken.filter("times > 0").groupBy("tie").agg(F.max("times").alias(times))
    often = small(table(often.select(F.col("tie.a").alias(tie + "a"), F.col("tie.b").alias(tie + "b"), times), "mix-taken"))
    key = row_key(id_col, text_col, source_col)
    rows = docs.join(often, (key["a"] == F.col(tie + "a")) & (key["b"] == F.col(tie + "b")))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[docs[c] for c in docs.columns])
