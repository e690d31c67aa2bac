"""Numbers, groups and batches that are far larger than usual."""

import pandas as pd
from lodestack.operators import cases as C
from lodestack.operators import matching as M
from lodestack.operators import relational as R
from pyspark.sql import functions as F


def test_one_wild_number_makes_no_list(spark):
    good = "a compound of twenty letters and more"
    rows = [("a", n, "verified", good) for n in ("1", "3", "2000000000")] + [("b", n, "verified", good) for n in ("-5", "0")]
    got = {r.case_id: r.issues for r in C.claim_issues(spark.createDataFrame(rows, "case_id string, claim_number string, status string, text string")).collect()}
    assert got == {"a": ["claim numbers not contiguous, missing: 2,4-1999999999"], "b": ["claim 1 missing"]}
    gaps = R.gaps(spark.createDataFrame([("a", 1), ("a", 1), ("a", 2_000_000_000), ("b", 0), ("b", -3), ("c", None), ("d", 2), ("d", 1)], "k string, n int"), "k", "n")
    assert {r.k: (r.missing, r.duplicates) for r in gaps.collect()} == {"a": (1_999_999_998, 1), "b": (0, 0), "c": (0, 0), "d": (0, 0)}


def test_missing_numbers(spark):
    have = [[1, 2, 5], [], [3], [0, 1], [1, 1002], [1, 1003]]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in have], "x array<int>").select(C.missing_numbers(F.col("x"))).collect()]
    assert got[:4] == [["3", "4"], [], ["1", "2"], []] and got[4] == [str(k) for k in range(2, 1002)] and got[5] == ["2-1002"]


def test_pages_over_many_batches(spark):
    """Pages that begin, end and go on in any batch come whole and in order."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(p, b) for p in range(12) for b in range(p % 5 * 3)]
        one = lambda pdf: pd.DataFrame([(page, ",".join(map(str, rows["box"]))) for page, rows in pdf.groupby("page")], columns=["page", "boxes"])
        out = M.by_page(spark.createDataFrame(rows, "page long, box long").repartition(4), ["box"], one, "page long, boxes string", 2)
        assert sorted(map(tuple, out.collect())) == [(p, ",".join(map(str, range(p % 5 * 3)))) for p in range(12) if p % 5]
        assert M.by_page(spark.createDataFrame([], "page long, box long"), ["box"], one, "page long, boxes string").count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_topped_up_in_order(spark):
    df = spark.createDataFrame([(k, 100 - k) for k in range(10)] + [(9, 0)], "k int, at int")
    some = df.filter("k IN (1, 2)")
    got = lambda n: sorted((r.k, r.added) for r in R.topped_up(df, some, "k", "at", n).collect())
    assert got(2) == got(1) == [(1, False), (2, False)] and got(4) == [(1, False), (2, False), (8, True), (9, True)] and len(got(50)) == 10


def test_balanced_with_null_groups(spark):
    rows = [(k, None if k % 4 == 0 else "abc"[k % 3], k % 2 == 0) for k in range(60)]
    got = R.balanced(spark.createDataFrame(rows, "k int, g string, p boolean"), "g", F.col("p"), "k", 9).collect()
    assert sorted(r.place for r in got if r.pos) == [1, 2, 3, 4] and sorted(r.place for r in got if not r.pos) == [1, 2, 3, 4, 5]
    assert {r.g for r in got if r.pos} == {None, "a", "b", "c"}
