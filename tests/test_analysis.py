"""Merges of nested analyses against plain dictionaries, over every shape that fields come in."""

import json
import random

import pytest
from lodestack.operators import analysis as A
from pyspark.sql import functions as F

EMPTY = json.loads(A.NO_DISCUSSION)


def whole(x):
    try:
        return int(x)
    except (TypeError, ValueError):
        return None


def real(x):
    try:
        return float(x)
    except (TypeError, ValueError):
        return None


def added(xs):
    """Left to right: sum() of floats compensates for rounding."""
    out = 0.0
    for x in xs:
        out += x
    return out


def support_of(disc, evidence):
    out = []
    pick = lambda x, where: {"location": where, **{k: x.get(k) or "" for k in ("original_text", "translation", "llm_evidence_explanation")}}
    if isinstance(disc, dict) and disc.get("original_text"):
        out.append(pick(disc, disc.get("source") or "support_disc"))
    return out + [pick(e, e.get("source") or e.get("location") or "support evidence") for e in evidence if e.get("original_text")]


def parts(p, dim):
    evidence = [e for e in (p.get("evidence") or []) if isinstance(e, dict)]
    disc = p.get(f"{dim}_disc")
    said = [str(p.get(k) or "").strip() for k in ("risk_reason", "recommended_action")]
    return p.get(f"{dim}_score"), disc, evidence, support_of(disc, evidence) if dim == "support" else [], *said


def is_complete(score, disc):
    return score is not None and isinstance(disc, dict) and bool(str(disc.get("original_text") or "").strip())


def norm(x):
    return json.dumps(x, sort_keys=True, ensure_ascii=False)


def plain_merge(results):
    """results: {dimension: dict}, merged in order of the dimensions."""
    out = {"scores": {}, "discs": {}, "claims": set(), "risks": [], "actions": [], "support": [], "evidence": []}
    for dim in A.DIMENSIONS:
        if dim in results:
            score, disc, evidence, support, risk, action = parts(results[dim], dim)
            disc = disc or EMPTY
            out["scores"][dim] = score
            out["discs"][dim] = {**EMPTY, "analysis": disc, "llm_evidence_explanation": A.UNSTRUCTURED_NOTE} if isinstance(disc, str) else disc
            out["claims"] |= {n for n in map(whole, results[dim].get("affected_claims") or []) if n is not None}
            out["risks"] += [risk] if risk else []
            out["actions"] += [action] if action else []
            out["support"] += support
            out["evidence"] += evidence
    values = [real(out["scores"].get(d)) for d in A.DIMENSIONS]
    mean = 0 if None in values else round(added(v * w for v, w in zip(values, A.WEIGHTS.values())))
    return out, mean


def append(items, value):
    key = lambda x: norm(x) if isinstance(x, (dict, list)) else str(x)
    if key(value) not in map(key, items):
        items.append(value)


def plain_complete(doc, results):
    """results: [(pass, {dimension: dict})]."""
    scores, trace = dict(doc.get("dimension_scores") or {}), doc.get("evidence_trace") or {}
    claims, evidence, support = (list(trace.get(k) or []) for k in ("affected_claims", "examination_material_evidence", "specification_support"))
    risks, actions, repaired = list(doc.get("top_risk_reasons") or []), list(doc.get("recommended_actions") or []), []
    for _, found in sorted(results, key=lambda x: x[0]):
        for dim in [d for d in A.DIMENSIONS if not is_complete(scores.get(f"{d}_score"), scores.get(f"{d}_disc"))]:
            if dim in found and is_complete(*parts(found[dim], dim)[:2]):
                score, disc, ev, sup, risk, action = parts(found[dim], dim)
                scores[f"{dim}_score"], scores[f"{dim}_disc"] = score, disc
                for c in found[dim].get("affected_claims") or []:
                    append(claims, c if whole(c) is None else whole(c))
                for items, new in ((evidence, ev), (support, sup), (risks, [risk] * bool(risk)), (actions, [action] * bool(action))):
                    for x in new:
                        append(items, x)
                repaired.append(dim)
    known = {d: v for d in A.DIMENSIONS if (v := real(scores.get(f"{d}_score"))) is not None}
    mean = round(added(v * A.WEIGHTS[d] for d, v in known.items()) / added(A.WEIGHTS[d] for d in known)) if known else int(doc.get("aggregate_score") or 0)
    return scores, mean, claims, evidence, support, risks, actions, repaired


def some_disc(rng):
    whole_disc = {"analysis": "a", "original_text": f"passage {rng.randint(0, 3)}", "translation": "t", "source": rng.choice(["s.pdf", "", None])}
    return rng.choice([None, "", "only text", {}, {"original_text": " "}, {"original_text": ""}, whole_disc, whole_disc, whole_disc])


def some_partial(rng, dim):
    evidence = [{"issue": dim, "original_text": f"e{rng.randint(0, 2)}", "source": rng.choice(["x", None])}, {"location": "p. 3", "original_text": "where", "more": {"b": [1], "a": None}}, {"original_text": ""}, "loose", None, 3]
    p = {f"{dim}_score": rng.choice([80, "70", None, 12.5, 0, "high", ""]), f"{dim}_disc": some_disc(rng), "affected_claims": rng.choice([None, [], [3, "4", "x", None, 1, "4"], [2.9, 3]]), "evidence": rng.choice([None, [], "text", rng.sample(evidence, 4)]), "risk_reason": rng.choice([None, "", " risk ", "other"]), "recommended_action": rng.choice(["act", None])}
    return {k: v for k, v in p.items() if rng.random() < 0.95}


def some_document(rng):
    doc = {"dimension_scores": {}, "evidence_trace": {"affected_claims": [1, "2"], "examination_material_evidence": [{"issue": "support", "original_text": "e1"}, "old"], "specification_support": []}, "top_risk_reasons": ["risk", "risk"], "aggregate_score": 7}
    for d in A.DIMENSIONS:
        if rng.random() < 0.6:
            doc["dimension_scores"] |= {f"{d}_score": rng.choice([55, None, "60"]), f"{d}_disc": some_disc(rng)}
    return rng.choice([doc, doc, doc, {}, {"dimension_scores": None, "evidence_trace": "none"}])


def loads(xs):
    return [norm(json.loads(x)) for x in xs]


@pytest.mark.parametrize("seed", range(2))
def test_merge(spark, seed):
    rng = random.Random(seed)
    cases = {k: {d: some_partial(rng, d) for d in A.DIMENSIONS if rng.random() < 0.9} for k in range(120)}
    rows = [(k, d, json.dumps(p, ensure_ascii=False)) for k, ps in cases.items() for d, p in ps.items()] + [(500, "novelty", None), (501, "clarity", "{broken"), (502, "unity", "{}")]
    cases |= {500: {"novelty": {}}, 501: {"clarity": {}}}
    df = spark.createDataFrame(rows, "c int, dim string, j string").repartition(3)
    got = {r.case_id: r for r in A.merge(A.partials(df, "c", "dim", "j")).collect()}
    assert set(got) == {k for k, ps in cases.items() if ps}
    for k, r in got.items():
        want, mean = plain_merge(cases[k])
        for d in A.DIMENSIONS:
            assert json.loads(r[f"{d}_score"]) == want["scores"].get(d), cases[k]
            assert (r[f"{d}_disc"] and json.loads(r[f"{d}_disc"])) == want["discs"].get(d), cases[k]
        assert r.aggregate_score == mean and r.affected_claims == sorted(want["claims"]), cases[k]
        assert r.top_risk_reasons == want["risks"][:5] and r.recommended_actions == want["actions"][:5]
        assert loads(r.specification_support) == list(map(norm, want["support"])) and loads(r.examination_material_evidence) == list(map(norm, want["evidence"]))


@pytest.mark.parametrize("seed", range(2))
def test_complete(spark, seed):
    rng = random.Random(seed + 10)
    docs = {k: some_document(rng) for k in range(120)}
    passes = {k: [(n, {d: some_partial(rng, d) for d in A.DIMENSIONS if rng.random() < 0.8}) for n in (1, 2)] for k in docs if k % 6}
    rows = [(k, n, d, json.dumps(p)) for k, ps in passes.items() for n, found in ps for d, p in found.items()]
    partial = A.partials(spark.createDataFrame(rows, "c int, n int, dim string, j string"), "c", "dim", "j", "n")
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in docs.items()], "case_id int, analysis string")
    got = A.complete(df, partial).collect()
    assert len(got) == len(docs)
    for r in got:
        doc = docs[r.case_id] if isinstance(docs[r.case_id].get("evidence_trace"), dict) else {}
        scores, mean, claims, evidence, support, risks, actions, repaired = plain_complete(doc, passes.get(r.case_id, []))
        for d in A.DIMENSIONS:
            assert json.loads(r[f"{d}_score"]) == scores.get(f"{d}_score") and json.loads(r[f"{d}_disc"]) == scores.get(f"{d}_disc")
        assert (r.aggregate_score, r.repaired) == (mean, repaired)
        assert loads(r.affected_claims) == list(map(norm, claims)) and r.top_risk_reasons == risks and r.recommended_actions == actions
        assert loads(r.specification_support) == list(map(norm, support)) and loads(r.examination_material_evidence) == list(map(norm, evidence))


def test_meta_gaps(spark):
    docs = [(1, {"meta": {"title": "", "applicant": "A", "n": 0}, "grant_label": "", "evidence_trace": {"examination_rounds": 2}}), (2, {}), (3, {"meta": {"title": "T"}})]
    passes = [(1, 2, {"meta": {"title": "second", "filing": [1]}, "grant_label": "no"}), (1, 1, {"meta": {"title": "first", "applicant": "B", "n": False}}), (2, 1, {"meta": "none", "examination_rounds": 3}), (2, 2, {"meta": {"title": None}, "grant_label": "yes", "examination_rounds": 4})]
    d = spark.createDataFrame([(k, json.dumps(x)) for k, x in docs], "case_id int, analysis string")
    s = spark.createDataFrame([(k, n, json.dumps(x)) for k, n, x in passes], "case_id int, pass int, analysis string")
    got = {r.case_id: (r.meta, r.grant_label, r.examination_rounds) for r in A.merge_meta(d, s).collect()}
    assert got == {1: ({"applicant": '"A"', "title": '"first"', "filing": "[1]"}, '"no"', "2"), 2: ({}, '"yes"', "3"), 3: ({"title": '"T"'}, None, None)}


def plain_sentences(doc):
    scores, trace = doc.get("dimension_scores") or {}, doc.get("evidence_trace") or {}
    value = lambda d: 101.0 if real(scores.get(f"{d}_score")) is None else real(scores[f"{d}_score"])
    out, seen = [], set()
    for d in sorted(A.DIMENSIONS, key=value):
        items = [(e, "examination_material_evidence") for e in trace.get("examination_material_evidence") or [] if isinstance(e, dict) and str(e.get("issue") or "").strip().lower() == d]
        items += [(scores[f"{d}_disc"], f"{d}_disc")] if isinstance(scores.get(f"{d}_disc"), dict) else []
        for x, source in items:
            text, translation = (str(x.get(k) or "").strip() for k in ("original_text", "translation"))
            key = " ".join(text.split()).lower()
            if text and translation and key not in seen:
                seen.add(key)
                out.append((d, str(x.get("source") or x.get("location") or source), text, translation, str(x.get("llm_evidence_explanation") or x.get("relevance") or A.EXPLANATION)))
    return out[: A.MOST_SENTENCES]


def test_source_sentences(spark):
    rng, docs = random.Random(4), [{}, {"evidence_trace": None, "dimension_scores": None}]
    for _ in range(150):
        item = lambda **more: {k: v for k, v in {"original_text": rng.choice(["One passage", "one  PASSAGE", f"text {rng.randint(0, 9)}", "", " x "]), "translation": rng.choice(["t", "t", " ", None]), "source": rng.choice(["", "s.pdf"]), "location": rng.choice([None, "p. 3"]), "relevance": rng.choice(["why", ""]), **more}.items() if rng.random() < 0.95}
        doc = {"dimension_scores": {}, "evidence_trace": {"examination_material_evidence": [rng.choice([item(issue=rng.choice([*A.DIMENSIONS, " Support ", None])), "loose"]) for _ in range(rng.randint(0, 8))]}}
        for d in A.DIMENSIONS:
            doc["dimension_scores"] |= {f"{d}_score": rng.choice([5, 50, "7.5", None, "high", True]), f"{d}_disc": rng.choice(["text", item(llm_evidence_explanation="so"), None])}
        docs.append(doc)
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k int, j string").repartition(3)
    for r in df.select("k", A.read(df["j"]).alias("v")).select("k", A.source_sentences(F.col("v")).alias("s")).collect():
        assert [tuple(x) for x in r.s] == plain_sentences(docs[r.k]), docs[r.k]


def test_values_are_read_few_times(spark, tmp_path):
    """Every reading of a VARIANT costs about a microsecond, so a row's number of them is what these queries take at size."""
    def readings(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("variant_get(") + plan.count("to_json(")

    rows = spark.createDataFrame([(1, "novelty", "{}")], "c int, dim string, j string")
    assert readings(A.partials(rows, "c", "dim", "j")) < 100  # 125 before
    assert readings(rows.select(A.source_sentences(A.read(F.col("j"))))) < 800  # 1,618 before
    from lodestack.operators import review as V

    assert readings(V.review_items(rows.selectExpr("c AS case_id", "j AS analysis", "j AS benchmark", "j AS claims"))) < 100  # 122 before


@pytest.mark.parametrize("name, table, schema", [("review_items", "customer", "c_custkey long, c_name string"), ("risk_source_sentences", "orders", "o_orderkey long, o_custkey long")])
def test_narrow_tables_are_spread(spark, tmp_path, name, table, schema):
    from lodestack.plans import catalog, claim_queries  # noqa: F401

    spark.createDataFrame([(1, "1" if table == "customer" else 1)], schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert catalog.QUERIES[name](spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_texts_that_look_like_other_values(spark):
    """A text of digits, 'false' or brackets is given; the number, boolean or list of the same spelling isn't."""
    docs = [('"0"', True, None), ("0", False, 0), ('"false"', True, None), ("false", False, 0), ('"[]"', True, None), ("[]", False, None), ('" 7 "', True, 7), ("7.9", True, 7), ("null", False, None), ('""', False, None), ("{}", False, None), ('"{x"', True, None)]
    df = spark.createDataFrame([(k, j) for k, (j, _, _) in enumerate(docs)], "k int, j string").withColumn("v", F.parse_json("j"))
    got = sorted(tuple(r) for r in df.select("k", A.given(F.col("v")), A.whole_number(F.col("v")), A.is_object(F.col("v")), A.is_text(F.col("v"))).collect())
    assert [r[1] for r in got] == [g for _, g, _ in docs]
    assert [r[2] for r in got] == [0 if j == '"0"' else n for j, _, n in docs]
    assert [r[3] for r in got] == [j == "{}" for j, _, _ in docs]
    assert [r[4] for r in got] == [j.startswith('"') for j, _, _ in docs]
