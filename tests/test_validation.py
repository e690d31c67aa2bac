"""Validation of whole cases: every issue has a fixture; a case in order passes."""

import hashlib
import json

import pytest
from lodestack.operators import validation as V

GOOD_DISC = {k: "x" for k in V.DISCUSSED}
SENTENCE = {k: "x" for k in V.SENTENCE}
ANALYSIS = {"meta": {k: "x" for k in V.META}, "grant_label": "yes", "aggregate_score": 0, "dimension_scores": {f"{d}_{k}": 5 if k == "score" else GOOD_DISC for d in V.DIMENSIONS for k in ("score", "disc")}, "top_risk_reasons": ["r", {"english": "e"}], "recommended_actions": [{"original_text": "a"}], "risk_source_sentences": [SENTENCE], "action_basis_source_sentences": [SENTENCE], "evidence_trace": {"affected_claims": [1], "examination_rounds": 1, "specification_support": [1], "examination_material_evidence": [1]}}
BENCHMARK = {"benchmark_input": {"claim_text": {"claim_1": "a compound " * 20}}}
HTML = " ".join(V.TOKENS)
PDF = b"%PDF-1.4 x"
CLAIMS = {"source_pdf": "docs/a.pdf", "source_pdf_sha256": hashlib.sha256(PDF).hexdigest(), "claims": [{"claim_number": 1, "status": "Verified", "text": "a compound of twenty letters"}, {"claim_number": "2", "status": "verified", "text": "another compound of twenty letters"}]}


def tree(app):
    found = {p.replace("{app}", app): b"content" for p in V.REQUIRED}
    return found | {"docs/download-index.csv": b"x", "original-application/download-index.csv": b"x", "docs/a.pdf": PDF, "docs/a.txt": b"text", "docs/01_claims.pdf": PDF, "docs/01_claims.txt": b"t", "docs/01_claims_ocr.txt": b"o" * 81, "original-application/o.pdf": PDF}


INDEX = [("docs", 1, "a.pdf"), ("docs", 2, "C:\\x\\01_claims.pdf"), ("original-application", 1, "docs/o.pdf")]


def run(spark, cases, require_claims=True):
    """cases: {id: (files, index, claims, benchmark, analysis, html)}."""
    rows, files, index = [], [], []
    for k, (found, listed, *texts) in cases.items():
        rows.append((k, *[x if x is None or isinstance(x, str) else json.dumps(x) for x in texts]))
        files += [(k, p, len(b), b[:4] == b"%PDF", hashlib.sha256(b).hexdigest()) for p, b in found.items()]
        index += [(k, *x) for x in listed]
    made = lambda data, schema: spark.createDataFrame(data, schema)
    out = V.validate(made(rows, "case_id string, claims string, benchmark string, analysis string, html string"), made(files, "case_id string, path string, length long, pdf boolean, sha256 string"), made(index, "case_id string, scope string, place int, file string"), require_claims)
    return {r.case_id: r for r in out.collect()}


def test_a_case_in_order_and_an_empty_one(spark):
    got = run(spark, {"EP1": (tree("EP1"), INDEX, CLAIMS, BENCHMARK, ANALYSIS, HTML), "EP2": ({}, [], None, None, None, None)})
    assert (got["EP1"].status, got["EP1"].issues, got["EP1"].docs_index_rows, got["EP1"].original_index_rows) == ("pass", [], 2, 1)
    assert got["EP2"].issues == ["missing " + p.replace("{app}", "EP2") for p in V.REQUIRED] + ["missing docs/download-index.csv", "missing original-application/download-index.csv", "missing EP2-claims-verified.json"]
    assert got["EP2"].status == "fail" and got["EP2"].docs_index_rows == 0


def test_files_and_indexes(spark):
    found = tree("EP1")
    found |= {"EP1-analysis.json": b"", "docs/a.txt": b"", "docs/01_claims_ocr.txt": b"o" * 80, "original-application/o.pdf": b"", "docs/reply.pdf": b"<html>", "docs/reply.txt": b"x"}
    listed = [*INDEX, ("docs", 3, "gone.pdf"), ("docs", 4, "reply.pdf")]
    got = run(spark, {"EP1": (found, listed, CLAIMS, BENCHMARK, ANALYSIS, HTML), "EP3": (tree("EP3"), [], CLAIMS, BENCHMARK, ANALYSIS, HTML)})
    assert got["EP1"].issues == ["empty EP1-analysis.json", "missing TXT: docs/a.txt", "missing key OCR: docs/01_claims_ocr.txt", "missing PDF: docs/gone.pdf", "bad PDF header: docs/reply.pdf", "missing key OCR: docs/reply_ocr.txt", "empty PDF: original-application/o.pdf"]
    assert got["EP1"].docs_index_rows == 4 and got["EP3"].issues == ["empty docs/download-index.csv", "empty original-application/download-index.csv"]


@pytest.mark.parametrize(
    "claims, want",
    [
        ("{broken", ["claims verified JSON parse error"]),
        ({"source_pdf": "docs/none.pdf"}, ["claims source_pdf missing", "claims verified list empty"]),
        (CLAIMS | {"source_pdf_sha256": "00", "claims": []}, ["claims source_pdf sha256 mismatch", "claims verified list empty"]),
        ({"claims": "text"}, ["claims verified list empty"]),
        ({"claims": ["loose", {"claim_number": "x"}, {"claim_number": None}]}, ["claims[0] not object", "claims[1].claim_number invalid", "claims[2].claim_number invalid"]),
        ({"claims": [{"claim_number": n, "status": s, "text": t} for n, s, t in ((2, "draft", "short"), (2, "verified", "权" * 20), (2, None, None), (5, "VERIFIED", "x" * 20))]}, ["claim 2 not verified", "claim 2 text too short", "duplicate claim 2", "duplicate claim 2", "claim 2 not verified", "claim 2 text too short", "claim 1 missing", "claim numbers not contiguous, missing: 1,3,4"]),
    ],
)
def test_claims(spark, claims, want):
    assert run(spark, {"EP1": (tree("EP1"), INDEX, claims, BENCHMARK, ANALYSIS, HTML)})["EP1"].issues == want
    assert run(spark, {"EP1": (tree("EP1"), INDEX, claims, BENCHMARK, ANALYSIS, HTML)}, False)["EP1"].status == "pass"


def test_documents(spark):
    worse = json.loads(json.dumps(ANALYSIS))
    worse["meta"]["title"] = ""
    worse |= {"aggregate_score": "", "grant_label": None, "top_risk_reasons": [], "recommended_actions": ["", {"other": "x"}, "ok"], "risk_source_sentences": [SENTENCE | {"issue": ""}, "loose"], "action_basis_source_sentences": "text", "evidence_trace": {"affected_claims": []}}
    worse["dimension_scores"] |= {"novelty_score": None, "clarity_score": 0, "support_disc": "text", "clarity_disc": GOOD_DISC | {"translation": ""}}
    want = ["benchmark claim_1 too short", "meta.title", "grant_label", "aggregate_score", "dimension_scores.novelty_score", "dimension_scores.support_disc", "dimension_scores.clarity_disc.translation", "top_risk_reasons", "recommended_actions[0]", "recommended_actions[1]", "risk_source_sentences[0].issue", "risk_source_sentences[1]", "action_basis_source_sentences"]
    want += [f"evidence_trace.{k}" for k in V.TRACED] + ["HTML missing token: " + t for t in V.TOKENS[1:]]
    good = (tree("EP1"), INDEX, CLAIMS)
    got = run(spark, {"EP1": (*good, {"benchmark_input": {"claim_text": {"claim_1": "a" * 119}}}, worse, V.TOKENS[0]), "EP9": (tree("EP9"), INDEX, CLAIMS, "{", "[1", HTML)})
    assert got["EP1"].issues == want
    assert got["EP9"].issues == ["benchmark JSON parse error", "analysis JSON parse error"]
