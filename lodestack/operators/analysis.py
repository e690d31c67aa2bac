"""Merging of nested analyses: partial results of single dimensions into one document, and completion of a document by later passes.

Fields that come in several shapes (a score as number, numeral or null; a discussion as text or object; lists of texts, objects or both) are
read as VARIANT and go on as canonical JSON texts, whose keys are sorted, so that equal values are equal texts. Lists keep their order; a union appends
what the list doesn't hold yet. The partial results of a case meet in one row: their number is bounded by dimensions and passes.

Cases: malformed JSON and null count as an empty object; a list field that is no list is empty; a case without partial results keeps its document;
several results of one dimension in one pass are taken in order of their text. Only the first complete result fills a gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound

# Dimensions in order, their weights, list lengths, shapes.
DIMENSIONS = ("novelty", "inventive_step", "support", "clarity", "eligibility")
WEIGHTS = {"novelty": 0.25, "inventive_step": 0.30, "support": 0.15, "clarity": 0.10, "eligibility": 0.20}
MOST_REASONS = 5
NO_DISCUSSION = '{"analysis":"","llm_evidence_explanation":"","original_text":"","translation":""}'
EXPLANATION = "该审查材料原文是风险判断的依据。"
MOST_SENTENCES = 5
#: Fields of a passage's record.
RECORD = ("issue", "source", "location", "original_text", "translation", "llm_evidence_explanation", "relevance")
UNSTRUCTURED_NOTE = "模型未返回该维度的结构化原文证据，已保留分析结论；请根据审查材料补齐原文和翻译。"
#: Canonical texts of values that count as missing, and those of them that a text may also have.
FALSY = ("null", '""', "0", "0.0", "false", "[]", "{}")
FALSE_TEXTS = FALSY[2:]

ITEM = "struct<key: string, json: string>"


def read(json: Column) -> Column:
    """The JSON text as VARIANT; malformed or null: an empty object."""
    return F.coalesce(F.try_parse_json(json), F.parse_json(F.lit("{}")))


def get(value: Column, path: str) -> Column:
    return F.try_variant_get(value, f"$.{path}", "variant")


def canonical(value: Column) -> Column:
    """The value as JSON text with sorted keys; missing: null."""
    return F.coalesce(F.to_json(value), F.lit("null"))


def plain(value: Column, path: str = "") -> Column:
    """The value as text: a scalar's own, an object's or list's canonical JSON; missing or null: null. Far cheaper than canonical()."""
    return F.try_variant_get(value, f"$.{path}" if path else "$", "string")


def is_text(value: Column) -> Column:
    """Whether the value is a string. Only what looks like another value is written as JSON to tell."""
    text = plain(value)
    return F.when(text.rlike("^([{\\[]|[-0-9]|true$|false$)"), canonical(value).startswith('"')).otherwise(text.isNotNull())


def given(value: Column) -> Column:
    """Whether the value is there and not empty, zero or false."""
    text = plain(value)
    return F.when(text.isNull() | (text == ""), False).when(text.isin(*FALSE_TEXTS), canonical(value).startswith('"')).otherwise(True)


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "struct<original_text: variant>").isNotNull()


def spelled(value: Column) -> Column:
    """A scalar as plain text, an object or list as JSON, missing or null as ''."""
    return F.coalesce(plain(value), F.lit(""))


def elements(value: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(value, f"$.{path}", "array<variant>"), F.array().cast("array<variant>"))


def item(value: Column) -> Column:
    """key by which a list knows the value, and its JSON."""
    return F.struct(F.coalesce(plain(value), F.lit("null")).alias("key"), canonical(value).alias("json"))


def whole_number(value: Column) -> Column:
    """The value as a whole number, null where it isn't one (numbers are cut, texts must be digits)."""
    return _whole(plain(value), canonical(value))


def _whole(text: Column, json: Column) -> Column:
    text = F.trim(text)
    return (
        F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("long"))
        .when(text.isNull() | json.startswith('"'), None)
        .when(text.isin("true", "false"), (text == "true").cast("long"))
        .when(text.rlike("^[-0-9]"), text.try_cast("double").try_cast("long"))
    )


def number(json: Column) -> Column:
    """A score's JSON as a double: number, numeral or boolean, else null."""
    bare = F.trim(F.regexp_replace(json, '^"|"$', ""))
    return F.when(bare.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), bare.try_cast("double")).when(json == "true", 1.0).when(json == "false", 0.0)


def records(values: Column, names: tuple) -> Column:
    """What of an array of VARIANT is an object, as struct<v, fields>: the fields of these names as texts. One reading of an object gives them all."""
    kind = "struct<" + ", ".join(f"{n}: string" for n in names) + ">"
    read = F.transform(values, lambda x: F.struct(x.alias("v"), F.try_variant_get(x, "$", kind).alias("fields")))
    return F.filter(read, lambda r: r["fields"].isNotNull())


def said(record: Column, *names: str, otherwise: str = "") -> Column:
    """The first of the fields that is given as text."""
    out = F.lit(otherwise)
    for name in reversed(names):
        text = record["fields"][name]
        there = (text != "") & F.when(text.isin(*FALSE_TEXTS), is_text(get(record["v"], name))).otherwise(True)
        out = F.when(there, text).otherwise(out)
    return out


def quoted(location: Column, record: Column) -> Column:
    """A support item: where the passage stands, and the passage."""
    json = F.to_json(F.struct(said(record, "llm_evidence_explanation").alias("llm_evidence_explanation"), location.alias("location"), said(record, "original_text").alias("original_text"), said(record, "translation").alias("translation")))
    return bound(json, lambda j: F.struct(j.alias("key"), j.alias("json")))


def partials(rows: DataFrame, case_col: str, dimension_col: str, json_col: str, pass_col: str | None = None) -> DataFrame:
    """Row per partial result: case_id, pass, place, dimension, score and disc (JSON), complete, and its list items."""
    r = rows.select(F.col(case_col).alias("case_id"), (F.col(pass_col) if pass_col else F.lit(1)).cast("int").alias("pass"), F.col(dimension_col).alias("dimension"), read(F.col(json_col)).alias("v"))
    r = r.withColumn("place", F.array_position(F.array(*map(F.lit, DIMENSIONS)), F.col("dimension"))).filter("place > 0")
    of = lambda suffix: F.coalesce(*[F.when(F.col("dimension") == d, get(F.col("v"), f"{d}_{suffix}")) for d in DIMENSIONS])
    r = r.withColumns({"score_v": of("score"), "disc_v": of("disc"), "evidence_v": elements(F.col("v"), "evidence"), "claims_v": elements(F.col("v"), "affected_claims"), "claim_texts": F.try_variant_get("v", "$.affected_claims", "array<string>")})
    r = r.withColumns({"score": canonical(F.col("score_v")), "disc_json": canonical(F.col("disc_v")), "object": is_object(F.col("disc_v"))})
    disc, text = F.col("disc_v"), get(F.col("disc_v"), "original_text")
    passages = lambda values, where, otherwise: F.transform(F.filter(records(values, RECORD), lambda x: said(x, "original_text") != ""), lambda x: quoted(said(x, *where, otherwise=otherwise), x))
    support = F.concat(passages(F.array(disc), ("source",), "support_disc"), passages(F.col("evidence_v"), ("source", "location"), "support evidence"))
    claims = F.transform("claims_v", lambda c, i: F.struct(F.get("claim_texts", i).alias("text"), canonical(c).alias("json")))
    own = lambda name: F.when(given(get(F.col("v"), name)), F.trim(plain(F.col("v"), name))).otherwise("")
    return r.select(
        "case_id",
        "pass",
        "place",
        "dimension",
        "score",
        F.when(~F.col("disc_json").isin(*FALSY), F.col("disc_json")).otherwise(NO_DISCUSSION).alias("disc"),
        ((F.col("score") != "null") & F.col("object") & (F.trim(spelled(text)) != "")).alias("complete"),
        F.transform(claims, lambda c: F.struct(_whole(c["text"], c["json"]).alias("n"), F.struct(F.coalesce(c["text"], F.lit("null")).alias("key"), c["json"].alias("json")).alias("raw"))).alias("claims"),
        F.transform(F.filter(F.transform("evidence_v", canonical), lambda j: j.startswith("{")), lambda j: F.struct(j.alias("key"), j.alias("json"))).alias("evidence"),
        F.when(F.col("dimension") == "support", support).otherwise(_no_items()).alias("support"),
        own("risk_reason").alias("risk"),
        own("recommended_action").alias("action"),
    )


def _no_items() -> Column:
    return F.array().cast(f"array<{ITEM}>")


def _by_case(rows: DataFrame) -> DataFrame:
    own = F.struct(*[c for c in ("pass", "place", "dimension", "score", "disc", "complete", "claims", "evidence", "support", "risk", "action")])
    return rows.groupBy("case_id").agg(F.array_sort(F.collect_list(own)).alias("parts"))


def _all(parts, name: str) -> Column:
    return F.flatten(F.transform(parts, lambda p: p[name]))


def _texts(parts, name: str) -> Column:
    return F.filter(F.transform(parts, lambda p: p[name]), lambda x: x != "")


def _jsons(items) -> Column:
    return F.transform(items, lambda x: x["json"])


def _last_of(parts, dimension: str) -> Column:
    """score and disc of a dimension's last result, null without one."""
    return F.try_element_at(F.transform(F.filter(parts, lambda p: p["dimension"] == dimension), lambda p: F.struct(p["score"].alias("score"), p["disc"].alias("disc"))), F.lit(-1))


def weighted(scores: dict[str, Column], complete_only: bool) -> Column:
    """Weighted mean of the scores (doubles), to a whole number (half to even): over those there are, or null unless all are there."""
    total = sum(F.coalesce(scores[d] * w, F.lit(0.0)) for d, w in WEIGHTS.items())
    weight = sum(F.when(scores[d].isNotNull(), w).otherwise(0.0) for d, w in WEIGHTS.items())
    mean = F.when(F.array_contains(F.array(*[x.isNull() for x in scores.values()]), True), None).otherwise(total) if complete_only else F.when(weight > 0, total / weight)
    return F.bround(mean, 0).cast("int")


def structured(disc: Column) -> Column:
    """A discussion that came as text becomes an object that says so; objects stay."""
    text = F.try_variant_get(F.try_parse_json(disc), "$", "string")
    made = F.to_json(F.struct(text.alias("analysis"), F.lit(UNSTRUCTURED_NOTE).alias("llm_evidence_explanation"), F.lit("").alias("original_text"), F.lit("").alias("translation")))
    return F.when(disc.startswith('"'), made).otherwise(disc)


def merge(rows: DataFrame) -> DataFrame:
    """Row per case from its partials(): <dimension>_score and _disc (JSON), aggregate_score (0 unless all scores are there), reasons and actions (the
    first five), affected_claims, specification_support and examination_material_evidence (arrays of JSON)."""
    parts = F.col("parts")
    found = _by_case(rows).withColumns({f"{d}_last": _last_of(parts, d) for d in DIMENSIONS})
    found = found.withColumns({f"{d}_score": F.coalesce(F.col(f"{d}_last")["score"], F.lit("null")) for d in DIMENSIONS})
    found = found.withColumns({f"{d}_value": number(F.col(f"{d}_score")) for d in DIMENSIONS})
    scores = {d: F.col(f"{d}_value") for d in DIMENSIONS}
    numbers = F.filter(F.transform(_all(parts, "claims"), lambda c: c["n"]), lambda n: n.isNotNull())
    return found.select(
        "case_id",
        *[f"{d}_score" for d in DIMENSIONS],
        *[structured(F.col(f"{d}_last")["disc"]).alias(f"{d}_disc") for d in DIMENSIONS],
        F.coalesce(weighted(scores, True), F.lit(0)).alias("aggregate_score"),
        F.slice(_texts(parts, "risk"), 1, MOST_REASONS).alias("top_risk_reasons"),
        F.slice(_texts(parts, "action"), 1, MOST_REASONS).alias("recommended_actions"),
        F.array_sort(F.array_distinct(numbers)).alias("affected_claims"),
        _jsons(_all(parts, "support")).alias("specification_support"),
        _jsons(_all(parts, "evidence")).alias("examination_material_evidence"),
    )


def union_by_key(old: Column, new: Column) -> Column:
    """old, then what of new it doesn't hold, each once, in order."""
    keys = lambda items: F.transform(items, lambda x: x["key"])
    fresh = bound(keys(old), lambda known: bound(keys(new), lambda ks: F.filter(new, lambda x, i: ~F.array_contains(known, x["key"]) & (F.array_position(ks, x["key"]) == i + 1))))
    return F.concat(old, fresh)


def complete(documents: DataFrame, rows: DataFrame, case_col: str = "case_id", json_col: str = "analysis") -> DataFrame:
    """Row per document: its fields after the gaps are filled from partials(), and repaired (the dimensions that were filled, in order).

    A dimension is a gap without score or without an original passage in its discussion. aggregate_score is the mean over the scores there are."""
    d = documents.select(F.col(case_col).alias("case_id"), read(F.col(json_col)).alias("v")).join(_by_case(rows.filter("complete")), "case_id", "left")
    at = lambda dim, what: get(F.col("v"), f"dimension_scores.{dim}_{what}")
    has = lambda dim: plain(at(dim, "score")).isNotNull() & is_object(at(dim, "disc")) & (F.trim(spelled(get(at(dim, "disc"), "original_text"))) != "")
    gaps = F.filter(F.array(*[F.when(~F.coalesce(has(x), F.lit(False)), x) for x in DIMENSIONS]), lambda x: x.isNotNull())
    d = d.withColumn("gaps", gaps)
    parts = F.coalesce("parts", F.array().cast(_part_type(rows)))
    # The first complete result of each gap; a later pass only runs for what is still open.
    first = F.filter(parts, lambda p, i: F.array_contains("gaps", p["dimension"]) & (F.array_position(F.transform(parts, lambda q: q["dimension"]), p["dimension"]) == i + 1))
    d = d.withColumn("used", first)
    used = F.col("used")
    d = d.withColumns({f"{x}_last": _last_of(used, x) for x in DIMENSIONS})
    d = d.withColumns({f"{x}_score": F.coalesce(F.col(f"{x}_last")["score"], canonical(at(x, "score"))) for x in DIMENSIONS})
    d = d.withColumns({f"{x}_value": number(F.col(f"{x}_score")) for x in DIMENSIONS})
    listed = lambda path: F.transform(elements(F.col("v"), path), item)
    words = lambda name: F.transform(_texts(used, name), lambda x: F.struct(x.alias("key"), F.lit("").alias("json")))
    claims = F.transform(_all(used, "claims"), lambda c: F.when(c["n"].isNotNull(), F.struct(c["n"].cast("string").alias("key"), c["n"].cast("string").alias("json"))).otherwise(c["raw"]))
    scores = {x: F.col(f"{x}_value") for x in DIMENSIONS}
    old = F.coalesce(F.try_variant_get(F.col("v"), "$.aggregate_score", "int"), F.lit(0))
    lists = {
        "claims": (listed("evidence_trace.affected_claims"), claims),
        "evidence": (listed("evidence_trace.examination_material_evidence"), _all(used, "evidence")),
        "support": (listed("evidence_trace.specification_support"), _all(used, "support")),
        "risks": (listed("top_risk_reasons"), words("risk")),
        "actions": (listed("recommended_actions"), words("action")),
    }
    d = d.withColumns({f"{side}_{name}": x for name, both in lists.items() for side, x in zip(("old", "new"), both)})
    d = d.withColumns({name: union_by_key(F.col(f"old_{name}"), F.col(f"new_{name}")) for name in lists})
    return d.select(
        "case_id",
        *[f"{x}_score" for x in DIMENSIONS],
        *[F.coalesce(F.col(f"{x}_last")["disc"], canonical(at(x, "disc"))).alias(f"{x}_disc") for x in DIMENSIONS],
        F.coalesce(weighted(scores, False), old).alias("aggregate_score"),
        *[F.transform(c, lambda x: x["key"]).alias(n) for c, n in (("risks", "top_risk_reasons"), ("actions", "recommended_actions"))],
        _jsons("claims").alias("affected_claims"),
        _jsons("support").alias("specification_support"),
        _jsons("evidence").alias("examination_material_evidence"),
        F.transform("used", lambda p: p["dimension"]).alias("repaired"),
    )


def _part_type(rows: DataFrame) -> str:
    kinds = dict(rows.dtypes)
    return "array<struct<" + ", ".join(f"{c}: {kinds[c]}" for c in ("pass", "place", "dimension", "score", "disc", "complete", "claims", "evidence", "support", "risk", "action")) + ">>"


def merge_meta(documents: DataFrame, sources: DataFrame, case_col: str = "case_id", json_col: str = "analysis", pass_col: str = "pass") -> DataFrame:
    """case_id, meta (key to JSON), grant_label, examination_rounds of the documents, gaps filled from the sources in order of pass.

    A value that is empty, zero, false or null is a gap; a source's own gaps fill nothing."""

    def unpacked(json):
        v = read(json)
        meta = F.coalesce(F.try_variant_get(v, "$.meta", "map<string, variant>"), F.create_map().cast("map<string, variant>"))
        return F.map_filter(F.transform_values(meta, lambda k, x: canonical(x)), lambda k, x: ~x.isin(*FALSY)), get(v, "grant_label"), v

    s_meta, s_label, s_v = unpacked(F.col(json_col))
    truthy = lambda x: F.when(given(x), canonical(x))
    s = sources.select(F.col(case_col).alias("case_id"), F.struct(F.col(pass_col).alias("pass"), truthy(s_label).alias("label"), truthy(get(s_v, "examination_rounds")).alias("rounds"), F.map_entries(s_meta).alias("meta")).alias("s"))
    s = s.groupBy("case_id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    d_meta, d_label, d_v = unpacked(F.col(json_col))
    d = documents.select(F.col(case_col).alias("case_id"), d_meta.alias("meta"), truthy(d_label).alias("label"), truthy(get(d_v, "evidence_trace.examination_rounds")).alias("rounds"))
    d = d.join(s, "case_id", "left")
    merged = F.aggregate(F.coalesce(F.transform("s", lambda x: F.map_from_entries(x["meta"])), F.array().cast("array<map<string, string>>")), F.col("meta"), lambda acc, m: F.map_concat(acc, F.map_filter(m, lambda k, x: ~F.map_contains_key(acc, k))))
    first = lambda name: F.get(F.filter(F.transform("s", lambda x: x[name]), lambda x: x.isNotNull()), F.lit(0))
    return d.select("case_id", merged.alias("meta"), F.coalesce("label", first("label")).alias("grant_label"), F.coalesce("rounds", first("rounds")).alias("examination_rounds"))


def source_sentences(analysis: Column) -> Column:
    """Passages of an analysis (VARIANT) that bear its risks out, and its advice alike: array<struct<issue, source, original_text, translation,
    llm_evidence_explanation>>.

    Dimensions come by rising score (those without one last, ties in their order), each with its evidence first and its discussion then; a passage needs a
    translation, and counts once whatever its spacing and case; the first ``MOST_SENTENCES`` stay."""
    kinds = ", ".join(f"{d}_score: variant, {d}_disc: variant" for d in DIMENSIONS)
    scored = F.try_variant_get(analysis, "$.dimension_scores", f"struct<{kinds}>")

    def sentence(x, issue, source):
        why = said(x, "llm_evidence_explanation", "relevance", otherwise=EXPLANATION)
        return F.struct(issue.alias("issue"), said(x, "source", "location", otherwise=source).alias("source"), F.trim(said(x, "original_text")).alias("original_text"), F.trim(said(x, "translation")).alias("translation"), why.alias("llm_evidence_explanation"))

    def found(items, scores, dimension, place):
        own = F.filter(items, lambda x: x["issue"] == dimension)
        discussed = F.transform(records(F.array(scores[f"{dimension}_disc"]), RECORD), lambda x: sentence(x, F.lit(dimension), f"{dimension}_disc"))
        score = bound(canonical(scores[f"{dimension}_score"]), number)
        return F.struct(F.coalesce(score, F.lit(101.0)).alias("score"), F.lit(place).alias("place"), F.concat(own, discussed).alias("sentences"))

    def chosen(items, scores):
        by_score = F.array_sort(F.array(*[found(items, scores, d, k) for k, d in enumerate(DIMENSIONS)]))
        every = F.filter(F.flatten(F.transform(by_score, lambda g: g["sentences"])), lambda x: (x["original_text"] != "") & (x["translation"] != ""))
        key = lambda x: F.lower(F.regexp_replace(x["original_text"], "(?U)\\s+", " "))
        once = bound(every, lambda xs: bound(F.transform(xs, key), lambda ks: F.filter(xs, lambda x, i: F.array_position(ks, F.get(ks, i)) == i + 1)))
        return F.slice(once, 1, MOST_SENTENCES)

    # Every record is read once; its fields are plain texts from there on.
    evidence = F.transform(records(elements(analysis, "evidence_trace.examination_material_evidence"), RECORD), lambda x: sentence(x, F.lower(F.trim(said(x, "issue"))), "examination_material_evidence"))
    return bound(evidence, lambda items: bound(scored, lambda scores: chosen(items, scores)))
