"""Outcomes of cases and citations of register pages against a plain reading of their rules."""

import random
import re

from lodestack.operators import outcomes as O
from pyspark.sql import functions as F

ROWS, DOCS, STATUS = "case_id string, place long, title string, date string", "case_id string, place long, name string, text string", "case_id string, register_status string"


def rank(name):
    if m := re.match(r"(?:\.\./)?(\d\d)-(\d\d)-(\d{4})", name):
        return int(m[3] + m[2] + m[1])
    if m := re.match(r"(?:\.\./)?(\d{4})-(\d\d)-(\d\d)", name):
        return int(m[1] + m[2] + m[3])
    return 0


def plain(rows, docs, status):
    items = [(t, d or "", t) for _, t, d in sorted(rows, key=lambda r: r[0]) if t]
    items += [(n or "", "", f"{n or ''} {' '.join((x or '')[:5000].split())}") for _, n, x in sorted(docs, key=lambda r: r[0])]
    for outcome, label, pattern in O.TOLD:
        told = [i for i in items if re.search(pattern, i[2], re.I)]
        if told:
            best = max(told, key=lambda i: rank(i[0]) or rank(i[1]))
            return outcome, label, best[0], best[1]
    for outcome, label, pattern in O.STATUS:
        if re.search(pattern, status or "", re.I):
            return outcome, label, "register_status", ""
    return None, None, None, None


def test_outcomes_against_the_rule(spark):
    rng = random.Random(4)
    titles = ["Decision to grant", "DECISION  TO REFUSE it", "2020-01-02 withdrawn", "../03-04-2021 decision_to_grant", "Letter", "", None, "is refused"]
    dates = ["01-02-2019", "2018-03-04", "03-05-2022", "", None]
    names = ["a.txt", "2017-01-01_decision_to_refuse.pdf", "09-09-2023_b.txt", None]
    texts = ["The patent is hereby\n\n granted", "withdrawn", "x" * 4995 + " is refused", "x" * 4980 + " is  refused", "nothing", "", None]
    status = ["No opposition filed", "application refused", "Deemed to be withdrawn", "Examination is in progress", "", None]
    cases = {}
    for k in range(250):
        rows = [(i, rng.choice(titles), rng.choice(dates)) for i in range(rng.randrange(3))]
        docs = [(i, rng.choice(names), rng.choice(texts)) for i in range(rng.randrange(3))]
        cases[f"c{k}" if k else None] = rows, docs, rng.choice(status)
    got = O.known_outcomes(
        spark.createDataFrame([(c, *r) for c, (rows, _, _) in cases.items() for r in rows] * 2, ROWS).withColumn("item", F.lit(1)).withColumn("granted", F.lit(1)).repartition(3),
        spark.createDataFrame([(c, *d) for c, (_, docs, _) in cases.items() for d in docs], DOCS).repartition(3),
        spark.createDataFrame([(c, s) for c, (_, _, s) in cases.items()], STATUS),
    )
    want = {c: plain(*case) for c, case in cases.items()}
    assert {r.case_id: tuple(r)[1:] for r in got.collect()} == want and got.count() == 250
    assert {w[0] for w in want.values()} == {"granted", "rejected", "withdrawn", "pending", None}


def test_query_reads_whole_texts(spark, monkeypatch):
    """The query's outcomes don't change when every document begins with a long part that tells nothing."""
    from lodestack.plans import case_queries, catalog  # noqa: F401 - the first adds to the second

    sf, operator = "/root/testdata/sf0.001", O.known_outcomes
    want = sorted(map(str, catalog.QUERIES["known_outcomes"](spark, sf).collect()))

    def behind(rows, documents, *others, **how):
        return operator(rows, documents.withColumn("text", F.concat(F.lit("x\n" * 40_000), "text")), *others, **how)

    monkeypatch.setattr(O, "known_outcomes", behind)
    assert sorted(map(str, catalog.QUERIES["known_outcomes"](spark, sf).collect())) == want


def test_whole_texts_against_the_rule(spark):
    parts = ["x" * 4990, "is ", " \n refused", "is\u2003hereby granted", "with", "drawn", " ", "\u00e9\U0001d538" * 3000, "decision", "\t to  grant"]
    rng = random.Random(6)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(200)] + [None, "x" * 3_000_000 + "\nis\nrefused"]
    got = O.known_outcomes(
        spark.createDataFrame([], ROWS), spark.createDataFrame([(str(k), 0, "a", x) for k, x in enumerate(texts)], DOCS), spark.createDataFrame([], STATUS), most=None
    )
    want = {str(k): next((o for o, _, p in O.TOLD if re.search(p, x or "", re.I)), None) for k, x in enumerate(texts)}
    assert {r.case_id: r.outcome for r in got.collect()} == want
    assert sum(want[str(k)] is not None and not any(re.search(p, (x or "")[: O.LOOKED_AT], re.I) for _, _, p in O.TOLD) for k, x in enumerate(texts)) > 20


def test_empty_inputs(spark):
    rows, docs, status = (spark.createDataFrame([], s) for s in (ROWS, DOCS, STATUS))
    assert O.known_outcomes(rows, docs, status).count() == 0
    one = O.known_outcomes(rows, docs, spark.createDataFrame([("a", None)], STATUS)).collect()
    assert [tuple(r) for r in one] == [("a", None, None, None, None)]


def block(html):
    start = html.find("Documents cited:")
    if start < 0:
        found = re.search(r">\s*Cited in\s*<", html, re.I)
        if not found:
            return ""
        start = html.rfind("<td", 0, found.start())
        start = found.start() if start < 0 else start
    tail = html[start:]
    ends = [tail.find(e) for e in O.ENDS] + [m.start() for m in re.finditer(r">\s*by applicant\s*<", tail, re.I)]
    return tail[: min([e for e in ends if e >= 0], default=len(tail))]


def test_citations_block(spark):
    rng = random.Random(5)
    parts = ["<td>", "<td a=\"b\">", "Documents cited:", "> cited in <", ">Cited in\n<", "> By Applicant <", "</body>", *O.ENDS, "D1 WO 1", "\n", "é𝔸", "cited in", "<tr>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(400)] + ["", "x" * 200_000 + "Documents cited:" + "y" * 200_000]
    got = spark.createDataFrame([(k, p) for k, p in enumerate(pages)] + [(-1, None)], "k int, html string").select("k", O.citations_block(F.col("html")).alias("b")).collect()
    assert {r.k: r.b for r in got} == {**{k: block(p) for k, p in enumerate(pages)}, -1: ""}
    assert sum(bool(block(p)) for p in pages) > 100
