"""The reference workload's relational operators as DataFrame -> DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


# pick one per key
def pick(df: DataFrame, keys: list, order: list, *, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by order. An aggregate on a struct with partial aggregation, so a hot key is one
    row a task, instead of a window that sorts all of a key's rows in one task."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_cols(order))])
    row = F.struct(*[F.col(c) for c in df.columns])
    best = (F.max_by if last else F.min_by)(row, rank).alias("row")
    return df.groupBy(*[c.alias(f"k{i}") for i, c in enumerate(_cols(keys))]).agg(best).select("row.*")


def first_filled(value: Column, order: Column) -> Column:
    """First non-empty value by order."""
    return F.min_by(value, F.when(F.coalesce(value.cast("string"), F.lit("")) != "", order))


def distinct_in_order(value: Column, order: Column) -> Column:
    """Distinct values in order of first appearance."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_distinct(F.transform(pairs, lambda p: p["v"]))


# joins
def full_outer(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Key union with a flag for each side."""
    a, b = left.withColumn("in_left", F.lit(True)), right.withColumn("in_right", F.lit(True))
    return a.join(b, key, "full_outer").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_left", "in_right")})


def anti_keep_empty(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is unknown; rows with an empty key stay: the test sits in the join's condition."""
    k = known.select(F.col(key).alias("__k")).distinct()
    return df.join(k, (F.col(key) == F.col("__k")) & (F.col(key) != ""), "left_anti")


def double_anti(df: DataFrame, excluded: DataFrame, first: str, second: str) -> DataFrame:
    """Rows neither of whose two keys is excluded."""
    ids = excluded.toDF("__x").filter("__x is not null").distinct()
    once = df.join(ids, F.col(first) == F.col("__x"), "left_anti")
    return once.join(ids, F.col(second) == F.col("__x"), "left_anti")


def set_difference(listed: DataFrame, examined: DataFrame, key: str) -> DataFrame:
    """Two-way difference with its side."""
    return listed.select(key).distinct().join(examined.select(key).distinct(), key, "left_anti").withColumn("side", F.lit("listed_only")).unionByName(examined.select(key).distinct().join(listed.select(key).distinct(), key, "left_anti").withColumn("side", F.lit("examined_only")))


# aggregates
def top_and_other(df: DataFrame, label: str, n: int, other: str = "other") -> DataFrame:
    """Counts by label, the n largest by name and the rest as one."""
    counts = df.groupBy(label).count()
    ranked = counts.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("count"), label)))
    return ranked.groupBy(F.when(F.col("rn") <= n, F.col(label)).otherwise(other).alias("label")).agg(F.sum("count").alias("n"))


def weighted_score(scores: list[Column], weights: list[float], mode: str) -> Column:
    """strict: null unless all are present; renormalised: over those present; zero_fill: missing as 0. Half-even rounding."""
    pairs = list(zip(scores, weights))
    if mode == "strict":
        return F.bround(sum((s * w for s, w in pairs[1:]), pairs[0][0] * pairs[0][1]), 0)
    total = sum((F.coalesce(s, F.lit(0.0)) * w for s, w in pairs), F.lit(0.0))
    if mode == "zero_fill":
        return F.bround(total, 0)
    present = sum((F.when(s.isNotNull(), w).otherwise(0.0) for s, w in pairs), F.lit(0.0))
    return F.bround(total / F.nullif(present, F.lit(0.0)), 0)


# windows
def round_robin(df: DataFrame, group: str, order: list, n: int) -> DataFrame:
    """One row of each group in turn, groups by name. No group gives more than n rows, so only its first n leave a task."""
    rn = F.row_number().over(Window.partitionBy(group).orderBy(*_cols(order)))
    return df.withColumn("turn", rn).filter(F.col("turn") <= n).orderBy("turn", group).limit(n)


def balanced(df: DataFrame, group: str, positive: Column, order: str, n: int) -> DataFrame:
    """n // 2 positives, the rest negatives; within each, a pass takes one row a group, largest remaining group first.

    Sizes of groups are aggregated apart, so that only the first n rows of a group leave a task and are ranked."""
    side = df.withColumn("pos", positive.cast("int"))
    sizes = side.groupBy(F.col("pos").alias("of_pos"), F.col(group).alias("of_group")).agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("seen"))
    first = side.withColumn("turn", F.row_number().over(Window.partitionBy("pos", group).orderBy(order))).filter(F.col("turn") <= n)
    first = first.join(sizes, F.col("pos").eqNullSafe(F.col("of_pos")) & F.col(group).eqNullSafe(F.col("of_group")))
    rank = F.row_number().over(Window.partitionBy("pos").orderBy("turn", F.desc(F.col("size") - F.col("turn")), "seen"))
    share = F.when(F.col("pos") == 1, n // 2).otherwise(n - n // 2)
    return first.withColumn("place", rank).filter(F.col("place") <= share).drop("of_pos", "of_group", "size", "seen")


def topped_up(df: DataFrame, chosen: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The rows of df that chosen holds, and where those are fewer than n, the first others in order: key, added."""
    have = chosen.select(key).distinct()
    missing = n - have.count()
    kept = have.withColumn("added", F.lit(False))
    if missing <= 0:
        return kept
    others = df.join(have, key, "left_anti").groupBy(key).agg(F.min(order).alias("at")).orderBy("at", key).limit(missing)
    return kept.unionByName(others.select(key, F.lit(True).alias("added")))


def until_target(df: DataFrame, order: list, success: Column, target: int, within: list) -> DataFrame:
    """Rows in order up to and including the one that brings the target-th success, per group."""
    w = Window.partitionBy(*_cols(within)).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(success.cast("int")).over(w), F.lit(0))).filter(F.col("before") < target).drop("before")


def streaks(df: DataFrame, key: str, order: list, failed: Column) -> DataFrame:
    """Longest run of consecutive failures per key (gaps and islands)."""
    w = Window.partitionBy(key).orderBy(*_cols(order))
    marked = df.withColumn("bad", failed.cast("int")).withColumn("island", F.sum(1 - F.col("bad")).over(w))
    runs = marked.groupBy(key, "island").agg(F.sum("bad").alias("run"))
    return runs.groupBy(key).agg(F.max("run").alias("longest"))


def gaps(df: DataFrame, key: str, number: str) -> DataFrame:
    """Contiguity of 1..max per key: how many numbers are missing, and duplicates. Nothing is made for a missing number, however large max is."""
    n = F.col(number)
    g = df.groupBy(key).agg(F.max(number).alias("top"), F.count(number).alias("rows"), F.countDistinct(number).alias("distinct"), F.countDistinct(F.when(n >= 1, n)).alias("positive"))
    return g.select(key, (F.greatest(F.col("top").cast("long"), F.lit(0)) - F.col("positive")).alias("missing"), (F.col("rows") - F.col("distinct")).alias("duplicates"))


# geometry
def iou(a: str, b: str) -> Column:
    """Intersection over union of two boxes (x, y, w, h) given by column prefixes."""
    c = lambda p, n: F.col(f"{p}_{n}")
    wide = F.greatest(F.lit(0), F.least(c(a, "x") + c(a, "w"), c(b, "x") + c(b, "w")) - F.greatest(c(a, "x"), c(b, "x")))
    high = F.greatest(F.lit(0), F.least(c(a, "y") + c(a, "h"), c(b, "y") + c(b, "h")) - F.greatest(c(a, "y"), c(b, "y")))
    both = (wide * high).cast("double")
    return both / F.nullif(c(a, "w") * c(a, "h") + c(b, "w") * c(b, "h") - both, F.lit(0.0))
