"""Repair of quoted evidence against a plain search over all runs of lines."""

import json
import random
import re
from difflib import SequenceMatcher
from pathlib import PurePosixPath as Path

import pytest
from lodestack.operators import repair as R
from lodestack.session import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def best_match(query, docs):
    q = R.normal(query)
    if len(q) < 8:
        return 0.0
    bodies = [b for _, t in docs if (b := R.normal(t))]
    for b in bodies:
        if q in b:
            return 1.0
        if len(q.replace(" ", "")) >= 30 and q.replace(" ", "") in b.replace(" ", ""):
            return 0.97
    w, best = q.split(), 0.0
    for b in bodies:
        if len(w) >= 12 and " ".join(w[:12]) in b and " ".join(w[-12:]) in b:
            return 0.92
        if (at := b.find(" ".join(w[:6]))) >= 0:
            best = max(best, SequenceMatcher(None, q, b[max(0, at - 300) : at + len(q) + 300]).ratio())
    return best


def best_excerpt(query, docs, most):
    q, best = R.normal(query), (None, "", 0.0)
    for path, text in docs if q else []:
        lines = R.lines_of(text)
        for a in range(len(lines)):
            for b in range(a + 1, min(len(lines), a + most) + 1):
                body = R.normal("\n".join(lines[a:b]))
                if body and (score := SequenceMatcher(None, q, body).ratio()) > best[2]:
                    best = path, "\n".join(lines[a:b]), score
                    if score >= 0.98:
                        return best
    return best


def plain(doc, docs, most=10):
    docs = sorted((p, t) for p, t in docs if t is not None and not re.search(R.WORKING, Path(p).name))
    docs = [(p, t) for p, t in docs if R.normal(t)]
    value, count = json.loads(doc), 0

    def walk(x, path):
        nonlocal count
        if path.startswith(R.ADVICE):
            return
        if isinstance(x, dict):
            if isinstance(x.get("original_text"), str) and best_match(x["original_text"], docs) < 0.88:
                named = Path(str(x.get("source") or x.get("location") or "").replace("\\", "/")).name
                meant = [d for d in docs if named and (Path(d[0]).name == named or Path(d[0]).stem == Path(named).stem)]
                path_, excerpt, score = best_excerpt(x["original_text"], meant or docs, most)
                if excerpt and score >= 0.55:
                    x["original_text"] = excerpt
                    x["source"] = x.get("source") or Path(path_).name
                    count += 1
            for k, y in x.items():
                walk(y, f"{path}.{k}" if path else k)
        elif isinstance(x, list):
            for k, y in enumerate(x):
                walk(y, f"{path}[{k}]")

    walk(value, "")
    return value, count


def check(spark, cases, **options):
    docs = spark.createDataFrame([(k, doc, "kept") for k, (doc, _) in cases.items()], "case_id int, analysis string, note string")
    sources = spark.createDataFrame([(k, p, t) for k, (_, found) in cases.items() for p, t in found], "case_id int, file string, text string")
    got = {r.case_id: r for r in R.repair(docs, sources, **options).collect()}
    assert set(got) == set(cases) and all(r.note == "kept" for r in got.values())
    for k, (doc, found) in cases.items():
        want, count = plain(doc, found, options.get("max_lines", 10))
        assert (json.loads(got[k].analysis), got[k].repaired) == (want, count), k
        if not count:
            assert got[k].analysis == doc
    return got


TEXT = "Head line\n--- PAGE 1 ---\nThe examiner notes that the compound is not novel over D1.\nSOURCE: scan 7\nNo inventive step is seen in the choice\nof the solvent named in claim 4.\n---\nPAGE 2\n---\nThe applicant replies at length."


def test_before_and_after(spark):
    doc = {"evidence_trace": {"examination_material_evidence": [{"original_text": "the examiner notes that the compounds are not novel over D1", "source": "docs\\a.pdf"}, {"original_text": "No inventive step seen in choice of solvent of claim 4", "more": {"original_text": "The applicant replies at length"}}, "loose"]}}
    doc |= {"top_risk_reasons": [{"original_text": "the examiner notes a lot"}], "x": {"original_text": 5}, "y": {"original_text": ""}, "z": {"original_text": "nothing alike qqqq zzzz"}}
    files = [("docs/a.txt", TEXT), ("docs/b.txt", TEXT.replace("novel", "new")), ("docs/_tmp.txt", doc["top_risk_reasons"][0]["original_text"]), ("docs/none.txt", None), ("docs/blank.txt", "--- PAGE 1 ---")]
    got = check(spark, {1: (json.dumps(doc), files), 2: (json.dumps(doc), []), 3: ("{}", files)})
    trace = json.loads(got[1].analysis)["evidence_trace"]["examination_material_evidence"]
    assert trace[0]["original_text"] == "The examiner notes that the compound is not novel over D1." and trace[0]["source"] == "docs\\a.pdf"
    assert trace[1] == {"original_text": "No inventive step is seen in the choice\nof the solvent named in claim 4.", "more": {"original_text": "The applicant replies at length"}, "source": "a.txt"}


def test_malformed_documents_stay(spark):
    docs = spark.createDataFrame([(1, "{broken"), (2, None), (3, "[]")], "case_id int, analysis string")
    sources = spark.createDataFrame([(1, "a.txt", TEXT)], "case_id int, file string, text string")
    assert sorted((r.case_id, r.analysis, r.repaired) for r in R.repair(docs, sources).collect()) == [(1, "{broken", 0), (2, None, 0), (3, "[]", 0)]


@pytest.mark.parametrize("seed", range(2))
def test_all_runs_of_lines(spark, seed):
    rng = random.Random(seed)
    words = "claim novel compound step solvent acid of the and is are not seen over D1 D2 ---".split()
    line = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(0, n)))
    cases = {}
    for k in range(12):
        files = [(f"docs/{n}.txt", "\n".join(rng.choice([line(9), line(9), "--- PAGE 3 ---", "Source: x", ""]) for _ in range(rng.randint(0, 12)))) for n in "abc"]
        quotes = []
        for _ in range(4):
            found = R.lines_of(rng.choice(files)[1])
            quote = " ".join(found[:3]).split()
            quotes.append({"original_text": " ".join(w for w in quote if rng.random() < rng.choice([1, 0.9, 0.6])), "source": rng.choice(["", "b.pdf", "docs/c.txt", "none.txt"])})
        cases[k] = (json.dumps({"list": quotes}), files)
    check(spark, cases, max_lines=3)
