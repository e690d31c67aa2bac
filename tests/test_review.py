"""Review items of a case and the state of its review; cases in a real folder tree."""

import hashlib
import json

import pytest
from lodestack.operators import review as R
from lodestack.operators.analysis import read
from lodestack.sources import discovery as D
from pyspark.sql import functions as F

ANALYSIS = {
    "meta": {"jurisdiction": "EP", "application_number": "EP12345678.0", "title": "Example", "applicant": "Applicant", "filing_date": "2020-01-01", "examination_date": "2024-01-01", "outcome": "granted"},
    "grant_label": "yes",
    "dimension_scores": {"novelty_score": 80, "novelty_disc": "novelty", "inventive_step_score": 70, "inventive_step_disc": "inventive", "support_score": 60, "support_disc": "support", "clarity_score": 90, "clarity_disc": "clarity", "eligibility_score": 100, "eligibility_disc": "eligible"},
    "aggregate_score": 80,
    "top_risk_reasons": [{"original_text": "risk", "source": "docs/risk.pdf"}],
    "recommended_actions": [{"original_text": "action"}],
    "evidence_trace": {"prior_art_documents": [{"citation": "D1"}], "affected_claims": [1], "specification_support": [{"source": "docs/support.pdf"}], "examination_material_evidence": [{"source": "docs/exam.pdf"}], "examination_rounds": 2},
    "risk_source_sentences": [{"original_text": "risk sentence"}],
    "action_basis_source_sentences": [{"original_text": "action sentence"}],
}
BENCHMARK = {"benchmark_input": {"drug_structure": {"markush_images": [{"image_path": "assets/m.png"}], "markush_candidate_images": [{"image_path": "assets/c.png"}, {"image_path": "assets/m.png"}]}, "claim_text": {"claim_1": "A compound..."}}}
CLAIMS = {"claims": [{"claim_number": 1, "text": "A compound..."}]}


def documents(spark, rows):
    return spark.createDataFrame([(k, *[None if x is None else x if isinstance(x, str) else json.dumps(x) for x in xs]) for k, *xs in rows], "case_id string, analysis string, benchmark string, claims string")


@pytest.fixture(scope="module")
def items(spark):
    return R.review_items(documents(spark, [("full", ANALYSIS, BENCHMARK, CLAIMS)])).cache()


def verdicts(items, **changes):
    """Progress of the review when every field is verified but for the changes."""
    status = F.lit("verified")
    for pointer, value in changes.items():
        status = F.when(F.col("id") == pointer, value).otherwise(status)
    return R.progress(items, items.select("case_id", "id", status.alias("status"))).first()


def test_every_section_has_items(items):
    rows = items.orderBy("place").collect()
    assert len(rows) > 25 and {"image", "claim"} <= {r.kind for r in rows} and "审查维度评分" in {r.section for r in rows}
    assert [r.place for r in rows] == list(range(len(rows))) and len({r.id for r in rows}) == len(rows)
    by_id = {r.id: r for r in rows}
    assert by_id["/top_risk_reasons/0"].evidence_paths == ["docs/risk.pdf"] and by_id["/top_risk_reasons/0"].label == "风险 1"
    assert by_id["/claims_verified/claims/0"].label == "权利要求 1" and not any(r.missing_required for r in rows)
    assert [r.id for r in rows if r.auto_pass] == [f"/meta/{k}" for k, _ in R.META] + ["/grant_label"]


def test_every_field_is_needed_for_success(items):
    new = R.progress(items, R.new_fields(items)).first()
    assert new.overall_status == "pending" and new.completed == 8
    done = verdicts(items)
    assert (done.overall_status, done.completed) == ("success", done.total)
    assert verdicts(items, **{"/aggregate_score": "pending"}).overall_status == "pending"


def test_missing_resource_needs_a_correction(spark, items):
    files = spark.createDataFrame([("full", p) for p in ("assets/m.png", "docs/risk.pdf", "docs/support.pdf")], "case_id string, path string")
    seen = R.with_resources(items, files)
    assert {(r.id, *r.missing_resources) for r in seen.collect() if r.missing_resources} == {("/evidence_trace/examination_material_evidence/0", "docs/exam.pdf")}
    assert verdicts(seen).overall_status == "pending"
    assert verdicts(seen, **{"/evidence_trace/examination_material_evidence/0": "corrected_verified"}).overall_status == "success"


def test_rejection_wins(items):
    assert verdicts(items, **{"/meta/jurisdiction": "rejected"}).overall_status == "needs_correction"


def test_empty_and_odd_documents(spark):
    odd = {"meta": [], "top_risk_reasons": "text", "evidence_trace": {"affected_claims": ["a.pdf", None, "", ["b.PDF", {"path": "c.txt", "source": [{"pdf": "d.htm"}, "c.txt"]}]]}, "dimension_scores": {"novelty_disc": None, "novelty_score": 0}}
    images = {"benchmark_input": {"drug_structure": {"markush_images": [{"image_path": ""}, "x.png", {"image_path": "y"}]}}}
    rows = R.review_items(documents(spark, [("none", None, None, None), ("broken", "{", "[]", '"x"'), ("odd", odd, images, {"claims": [{"text": "t"}, 5, {"claim_number": "7a"}]})])).collect()
    empty = [r for r in rows if r.case_id == "none"]
    assert len(empty) == 31 and sum(r.missing_required for r in empty) == 26 and all(r.value is None for r in empty)
    assert [r[1:] for r in rows if r.case_id == "broken"] == [r[1:] for r in empty]
    by_id = {r.id: r for r in rows if r.case_id == "odd"}
    found = [by_id[f"/evidence_trace/affected_claims/{k}"] for k in range(4)]
    assert [(r.evidence_paths, r.missing_required) for r in found] == [(["a.pdf"], False), ([], True), ([], True), (["b.PDF", "d.htm", "c.txt", "c.txt"], False)]
    assert [(by_id[f"/benchmark_input/drug_structure/markush_images/{k}"].evidence_paths, by_id[f"/benchmark_input/drug_structure/markush_images/{k}"].missing_required) for k in range(3)] == [([], True), ([], True), (["y"], False)]
    assert [by_id[f"/claims_verified/claims/{k}"].label for k in range(3)] == ["权利要求 1", "权利要求 2", "权利要求 7a"]
    assert not by_id["/dimension_scores/novelty_score"].missing_required and "/top_risk_reasons" in by_id


def test_bare_names_and_repeated_files(spark):
    items = spark.createDataFrame([("c", "/a", "text", ["x.pdf", ".\\docs\\y.pdf", "//z.PDF", "n.txt"], False, False), ("c", "/b", "image", ["p.png", ""], False, False)], "case_id string, id string, kind string, evidence_paths array<string>, missing_required boolean, auto_pass boolean")
    files = spark.createDataFrame([("c", "prior-art/x.pdf"), ("c", "prior-art/x.pdf"), ("c", "docs/y.pdf"), ("d", "z.PDF"), ("c", "assets/p.png")], "case_id string, path string")
    assert {r.id: r.missing_resources for r in R.with_resources(items, files).collect()} == {"/a": ["//z.PDF"], "/b": [""]}


def test_pictures_and_fingerprints(spark):
    df = spark.createDataFrame([(json.dumps(BENCHMARK), "a", None), ("{}", "a", "b")], "b string, x string, y string")
    got = df.select(R.picture_paths(read(F.col("b"))).alias("p"), R.fingerprint_matches(F.lit("a"), F.lit(None), F.col("x"), F.col("y")).alias("same")).collect()
    assert [tuple(r) for r in got] == [(["assets/m.png", "assets/c.png"], True), ([], False)]


TREE = ["group/EP10000001/EP10000001-analysis.json", "group/EP10000001/EP10000001-benchmark-input.json", "group/EP10000001/docs/a.pdf", "group/EP10000001/docs/inner-analysis.json", "group/EP10000001/register/x-main.html", "group/EP10000001/assets/big.png"]
TREE += ["EP10000002/EP10000002-analysis.json", "EP10000002/EP10000002-analysis.html", "EP10000002/b-analysis.json", "EP10000002/EP10000002-claims-verified.json", "EP10000002/sub dir/deep/EP10000003/q-analysis.json", "EP10000002/sub dir/deep/EP10000003/n.txt"]
TREE += ["loose.txt", "top-analysis.json", "_state/EP10000004/s.json", "ep10000005/register/ep10000005-main.html", "ep10000005/EP10000005-main.html", "ep10000005/z-main.html", "EPX/none.txt"]


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("cases")
    for path in TREE:
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(json.dumps({"path": path}), encoding="utf-8")
    (root / TREE[0]).write_text(json.dumps(ANALYSIS), encoding="utf-8")
    return root


def test_cases_in_a_folder_tree(spark, tree):
    files = D.listing(spark, str(tree)).select("path", "length")
    assert sorted(r.path for r in files.collect()) == sorted(p for p in TREE if not p.startswith("_"))
    assert "content" not in files._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    cases = {r.root: r.marker for r in D.roots(files).collect()}
    assert cases == {"group/EP10000001": "EP10000001-analysis.json", "group/EP10000001/docs": "inner-analysis.json", "EP10000002": "EP10000002-analysis.json", "EP10000002/sub dir/deep/EP10000003": "q-analysis.json"}
    outer = D.roots(files.filter("path <> 'top-analysis.json'"), nested=False)
    assert sorted(r.root for r in outer.collect()) == ["EP10000002", "group/EP10000001"]
    own = D.owned(files, D.roots(files))
    assert {(r.root, r.inside) for r in own.collect() if r.root.startswith("EP")} == {("EP10000002", p[11:]) for p in TREE if p.startswith("EP10000002/") and "deep" not in p} | {("EP10000002/sub dir/deep/EP10000003", x) for x in ("q-analysis.json", "n.txt")}
    assert {(r.root, r.inside) for r in D.owned(files, outer).collect() if r.root.startswith("group")} == {("group/EP10000001", p[17:]) for p in TREE if p.startswith("group")}


def test_cases_by_name_and_their_main_files(spark, tree):
    files = D.case_files(D.listing(spark, str(tree)).select("path"))
    got = {(r.case_dir, r.case_id, r.inside) for r in files.collect()}
    assert ("group/EP10000001", "EP10000001", "docs/a.pdf") in got and not any("assets" in x[2] or x[0].startswith("_") for x in got)
    assert ("EP10000002", "EP10000002", "sub dir/deep/EP10000003/n.txt") in got and ("ep10000005", "EP10000005", "z-main.html") in got and len(got) == 14
    assert {r.case_dir: r.file for r in D.main_files(files, "-main.html").collect()} == {"group/EP10000001": "register/x-main.html", "ep10000005": "EP10000005-main.html"}


def test_read_cases(spark, tree):
    got = {r.root: r for r in D.read_cases(spark, str(tree)).collect()}
    assert len(got) == 4
    full, second = got["group/EP10000001"], got["EP10000002"]
    assert (full.category, full.application, json.loads(full.analysis)) == ("group", "EP12345678", ANALYSIS)
    assert full.analysis_sha256 == hashlib.sha256((tree / TREE[0]).read_bytes()).hexdigest() and full.benchmark_sha256 and full.claims is None
    assert (second.category, second.application, second.html, second.benchmark, second.benchmark_sha256) == ("未分类", "EP10000002", "EP10000002-analysis.html", None, "") and second.claims
    made = R.review_items(D.read_cases(spark, str(tree)).withColumnRenamed("root", "case_id"))
    assert made.groupBy("case_id").count().count() == 4
