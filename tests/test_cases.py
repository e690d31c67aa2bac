"""Cases of the case-file operators that the made-up inputs of the queries lack."""

import random

from lodestack.functions import rules
from lodestack.operators import cases as C
from pyspark.sql import functions as F


def values(spark, column, rows):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x string").select(column(F.col("x"))).collect()]


def test_priorities_and_kinds(spark):
    names = ["2019_Decision to Grant.pdf", "claims.pdf", "reclaims.pdf", "x_claims_2.txt", "amended_claims.pdf", "", None]
    assert values(spark, rules.document_priority, names) == [0, 8, 20, 8, 7, 20, 20]
    assert values(spark, lambda x: rules.authority(x, F.lit("granted")), ["text_intended_for_grant_clean_copy.pdf", "claims.pdf", "minutes.pdf"]) == [0, 2, 20]
    assert values(spark, lambda x: rules.authority(x, F.lit("refused")), ["text_intended_for_grant_clean_copy.pdf", "claims.pdf"]) == [2, 0]
    paths = ["_state/a", "EP1/original-application/x.ZIP", "EP1/docs/x", "EP1/a-benchmark-input.json", "EP1/a", "EP1-benchmark-input.json", "EP1-notes", "list.csv", "EP1/assets/x.gif", "EP1/else/x"]
    assert values(spark, rules.file_bucket, paths) == ["_state", "original_publication_fallback", "file_wrapper_misc", "case_other", "case_other", "case_benchmark_input", "case_root_misc", "root_status_or_audit", "local_asset_misc", "case_other"]


def test_noise(spark):
    cited = ["D1 shows a compound", "WO 2004/012345 A1", "EP 1 492 030 B1 according to", "EP10007106A1", "D4 US 2004/0012345", "nothing", ""]
    assert values(spark, lambda x: rules.is_noise_citation(x, F.lit("EP10007106")), cited) == [True, False, True, True, False, True, True]
    assert values(spark, rules.is_noise_line, ["7", "  8 → 9", "EP 10 007 106.5", "Claims", "1. A compound", "", "1000"]) == [True, True, True, True, False, True, False]
    assert values(spark, rules.is_blocked, ["RobotAbuse detected", "404", None]) == [True, False, False]


def test_profile_of_cases_without_files(spark):
    files = spark.createDataFrame([("a", "original-application/x.pdf", 1048576), ("a", "docs/y.txt", 0), ("b", "z.log", 5), ("c", "original-application/sub/x.pdf", 1)], "case_id string, path string, bytes long")
    cases = spark.createDataFrame([("a",), ("b",), ("d",)], "case_id string")
    got = {r.case_id: r for r in C.case_profile(files, cases).collect()}
    assert [got[c].primary_class for c in "abd"] == ["D_original_pdf_needs_text_extract", "H_misc_or_failed_artifacts", "I_empty_case_dir"]
    assert got["a"].total_mb == 1.0 and got["a"].has_docs_material and got["d"].total_files == 0
    stages = {r.case_id: r.overall_status for r in C.stages(C.case_profile(files, cases), F.when(F.col("case_id") == "b", "error")).collect()}
    assert stages == {"a": "partial_success", "b": "failed", "d": "not_started"}


def test_claim_issues(spark):
    good = "a compound of twenty letters and more"
    rows = [("ok", "1", "verified", good), ("ok", "2", "VERIFIED", good), ("bad", "2", None, good), ("bad", "2", "verified", "short"), ("bad", None, "verified", good), ("bad", "4", "verified", good)]
    got = {r.case_id: r.issues for r in C.claim_issues(spark.createDataFrame(rows, "case_id string, claim_number string, status string, text string")).collect()}
    assert got == {"bad": sorted(["claim 2 not verified", "claim 2 text too short", "claim_number invalid", "duplicate claim 2", "claim 1 missing", "claim numbers not contiguous, missing: 1,3"])}


def test_review_progress(spark):
    rows = [("a", "verified", False, False), ("a", None, True, False), ("b", "verified", False, True), ("c", "corrected_verified", False, True), ("c", "rejected", True, False)]
    got = {r.case_id: (r.completed, r.total, r.overall_status) for r in C.review_progress(spark.createDataFrame(rows, "case_id string, status string, auto_pass boolean, blocked boolean")).collect()}
    assert got == {"a": (2, 2, "success"), "b": (0, 1, "pending"), "c": (2, 2, "needs_correction")}


def test_merged_boxes(spark):
    rng = random.Random(5)
    rows = [(p, b, rng.randrange(300), rng.randrange(300), rng.randrange(1, 30), rng.randrange(1, 30)) for p in range(30) for b in range(14)]
    got = {tuple(r) for r in C.merged_boxes(spark.createDataFrame(rows, "page long, box long, x long, y long, w long, h long"), buckets=4).collect()}
    want = set()
    for p in range(30):
        united = []
        for _, _, x, y, w, h in (r for r in rows if r[0] == p):
            rect, again = [x - 8, y - 8, x + w + 8, y + h + 8], True
            while again:
                again = False
                for o in list(united):
                    if not (rect[2] < o[0] or o[2] < rect[0] or rect[3] < o[1] or o[3] < rect[1]):
                        united.remove(o)
                        rect, again = [min(rect[0], o[0]), min(rect[1], o[1]), max(rect[2], o[2]), max(rect[3], o[3])], True
            united.append(rect)
        want |= {(p, a, b, c - a, d - b) for a, b, c, d in united}
    assert got == want


def test_source_texts(spark):
    long = "meaningful letters " * 40
    docs = [("a", "2019-01-01_claims.pdf", long), ("a", "2020-01-01_claims.pdf", long + "newer"), ("a", "decision_to_grant.txt", "--- PAGE 1 ---\nSOURCE: x"), ("a", "annex_to_the_communication.txt", long), ("a", "minutes.txt", None), ("b", "minutes.txt", long), ("b", "minutes.txt", "x" * 90), ("c", "withdrawn.txt", "short")]
    df = spark.createDataFrame(docs, "case_id string, name string, text string")
    got = lambda *a: [(r.case_id, r.place, r.name, len(r.text)) for r in C.source_texts(df, *a).orderBy("case_id", "place").collect()]
    assert got(2, 10_000) == [("a", 1, "annex_to_the_communication.txt", 760), ("a", 2, "2020-01-01_claims.pdf", 765), ("b", 1, "minutes.txt", 760), ("b", 2, "minutes.txt", 90)]
    assert got(9, 200, 450) == [("a", 1, "annex_to_the_communication.txt", 200), ("a", 2, "2020-01-01_claims.pdf", 200), ("a", 3, "2019-01-01_claims.pdf", 50), ("b", 1, "minutes.txt", 200), ("b", 2, "minutes.txt", 90)]
    assert got(9, 200, 400)[:3] == [("a", 1, "annex_to_the_communication.txt", 200), ("a", 2, "2020-01-01_claims.pdf", 200), ("b", 1, "minutes.txt", 200)]
