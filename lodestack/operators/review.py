"""Review items of a case: every value of its nested documents that a person has to check, with the files that prove it, and the state of the review.

Items are built inside the case's row from VARIANT values; a list gives one item an element, an empty list one placeholder. Resources are looked up by an
equi-join of the paths that an item names with the case's files.

Cases: malformed or missing documents count as empty ones, so that all their items are placeholders; a value that is missing, null or ''
lacks what is required; paths nested deeper than ``LEVELS`` objects or lists are not followed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound
from .analysis import canonical, elements, get, is_object, is_text, plain, read, spelled
from .cases import evidence_files, review_progress

# Sections, labels and kinds of items in their order; keys under which a record names its file; folders where bare names are looked up.
META = (("jurisdiction", "法域"), ("application_number", "申请号"), ("title", "发明名称"), ("applicant", "申请人"), ("filing_date", "申请日"), ("examination_date", "审查意见日期"), ("outcome", "授权结果"))
DIMENSIONS = (("novelty", "新颖性"), ("inventive_step", "创造性"), ("support", "充分公开 / 支持"), ("clarity", "清楚性"), ("eligibility", "适格性"))
S_META, S_INPUT, S_SCORES, S_TRACE, S_CLAIMS = "案件元数据", "申请预览与 Markush", "审查维度评分", "证据链", "权利要求"
LISTS = (("top_risk_reasons", "主要风险", "风险"), ("recommended_actions", "建议动作", "建议"))
TRACE_LISTS = (
    ("evidence_trace.affected_claims", S_TRACE, "受影响权利要求"),
    ("evidence_trace.prior_art_documents", "引用先文", "引用先文"),
    ("evidence_trace.specification_support", "说明书支持证据", "支持证据"),
    ("evidence_trace.examination_material_evidence", "审查材料证据", "审查证据"),
    ("risk_source_sentences", "风险依据原文", "风险依据"),
    ("action_basis_source_sentences", "建议依据原文", "建议依据"),
)
PATH_KEYS = ("source", "pdf", "source_pdf", "draft_text_pdf", "image_path", "path", "local_pdf")
FOLDERS = ("docs", "original-application", "prior-art", "assets")
#: Nested objects and lists that are followed to a path.
LEVELS = 4
IMAGES = "benchmark_input.drug_structure.markush_images"
PICTURES = (IMAGES, "benchmark_input.drug_structure.markush_candidate_images", "benchmark_input.drug_structure.markush_page_images")


def _text(value: Column) -> Column:
    """A string value, '' for anything else."""
    return F.when(is_text(value), plain(value)).otherwise("")


def evidence_paths(value: Column) -> Column:
    """Files that a value names: itself, the elements of a list, and what stands under a record's path keys, in that order."""

    kind = "struct<" + ", ".join(f"{k}: variant" for k in PATH_KEYS) + ">"
    named = lambda r: F.filter(F.array(*[r[k] for k in PATH_KEYS]), lambda y: y.isNotNull())

    def opened(x):
        record = bound(F.try_variant_get(x, "$", kind), lambda r: F.when(r.isNotNull(), named(r)).otherwise(F.array(x)))
        return F.coalesce(F.try_variant_get(x, "$", "array<variant>"), record)

    found = F.array(value)
    for _ in range(LEVELS):
        found = F.flatten(F.transform(found, opened))
    paths = F.filter(F.transform(found, _text), evidence_files)
    text, none = plain(value), F.array().cast("array<string>")
    return F.when(text.rlike("^[{\\[]"), F.when(is_object(value), F.array_distinct(paths)).otherwise(paths)).when(evidence_files(text), F.array(text)).otherwise(none)


def _item(id_: Column | str, section: str, label: Column | str, value: Column, kind: str = "text", required: bool = True, auto: bool = False) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(lit(id_).alias("id"), F.lit(section).alias("section"), lit(label).alias("label"), F.lit(kind).alias("kind"), value.alias("v"), F.lit(required).alias("required"), F.lit(auto).alias("auto_pass"))


def _pointer(path: str) -> str:
    return "/" + path.replace(".", "/")


def _listed(rows: Column, pointer: str, one, placeholder: Column) -> Column:
    return F.when(F.size(rows) > 0, F.transform(rows, one)).otherwise(F.array(placeholder))


def items(analysis: Column, benchmark: Column, claims: Column) -> Column:
    """array<struct<id, section, label, kind, v (VARIANT), required, auto_pass>> of three documents (VARIANT) in order.

    id is the value's JSON pointer."""
    nothing = F.lit(None).cast("variant")
    at = lambda path: get(analysis, path)
    indexed = lambda pointer, i: F.concat(F.lit(pointer + "/"), i.cast("string"))
    numbered = lambda label, i: F.concat(F.lit(label + " "), (i + 1).cast("string"))

    def group(path, section, label):
        return _listed(elements(analysis, path), _pointer(path), lambda x, i: _item(indexed(_pointer(path), i), section, numbered(label, i), x, "record"), _item(_pointer(path), section, label, nothing, "record"))

    def image(x, i):
        return _item(indexed(_pointer(IMAGES), i), S_INPUT, numbered("Markush 图片", i), x, "image")

    def claim(x, i):
        number = get(x, "claim_number")
        label = F.concat(F.lit(S_CLAIMS + " "), F.coalesce(plain(number), (i + 1).cast("string")))
        return _item(indexed("/claims_verified/claims", i), S_CLAIMS, label, x, "claim")

    single = [_item(f"/meta/{k}", S_META, label, at(f"meta.{k}"), auto=True) for k, label in META]
    single.append(_item("/grant_label", S_META, "授权与否标签", at("grant_label"), auto=True))
    claim_1 = "benchmark_input.claim_text.claim_1"
    scores = []
    for key, label in DIMENSIONS:
        scores.append(_item(f"/dimension_scores/{key}_score", S_SCORES, label + "分数", at(f"dimension_scores.{key}_score"), "number"))
        scores.append(_item(f"/dimension_scores/{key}_disc", S_SCORES, label + "分析", at(f"dimension_scores.{key}_disc"), required=False))
    scores.append(_item("/aggregate_score", S_SCORES, "综合评分", at("aggregate_score"), "number"))
    return F.concat(
        F.array(*single),
        _listed(elements(benchmark, IMAGES), _pointer(IMAGES), image, _item(_pointer(IMAGES), S_INPUT, "Markush 图片", nothing, "image")),
        F.array(_item(_pointer(claim_1), S_INPUT, "权利要求 1 预览", get(benchmark, claim_1))),
        F.array(*scores),
        *[group(*x) for x in LISTS],
        F.array(_item("/evidence_trace/examination_rounds", S_TRACE, "审查轮次", at("evidence_trace.examination_rounds"), "number")),
        *[group(*x) for x in TRACE_LISTS],
        _listed(elements(claims, "claims"), "/claims_verified/claims", claim, _item("/claims_verified/claims", S_CLAIMS, "已核验权利要求", nothing, "claim")),
    )


def review_items(cases: DataFrame, case_col: str = "case_id", analysis: str = "analysis", benchmark: str = "benchmark", claims: str = "claims") -> DataFrame:
    """Row per item: case_id, place (from 0), id, section, label, kind, value (JSON), evidence_paths, missing_required, auto_pass.

    cases: the three documents as JSON texts, null where there is none. A picture is proved by its image path alone, and lacks it where that is empty."""
    v = cases.select(F.col(case_col).alias("case_id"), *[read(F.col(c)).alias(n) for c, n in ((analysis, "a"), (benchmark, "b"), (claims, "c"))])
    rows = v.select("case_id", F.posexplode_outer(items(F.col("a"), F.col("b"), F.col("c"))).alias("place", "item"))
    rows = rows.select("case_id", "place", "item.*")
    picture, path, value = F.col("kind") == "image", _text(get(F.col("v"), "image_path")), F.col("v")
    return rows.select(
        *("case_id", "place", "id", "section", "label", "kind"),
        F.when(value.isNotNull(), canonical(value)).alias("value"),
        F.when(picture, F.filter(F.array(path), lambda p: p != "")).otherwise(evidence_paths(value)).alias("evidence_paths"),
        (F.col("required") & F.when(picture, path == "").otherwise(spelled(value) == "")).alias("missing_required"),
        "auto_pass",
    )


def normalised_path(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "^\\./", ""), "^/+", "")


def with_resources(items: DataFrame, files: DataFrame) -> DataFrame:
    """Adds missing_resources (array of paths) to items. files: case_id, path relative to the case's folder.

    Pictures and PDF files that an item names must be there, a bare name in one of the usual folders."""
    named = items.select("case_id", "id", "kind", F.posexplode("evidence_paths").alias("n", "path")).filter((F.col("kind") == "image") | F.col("path").rlike("(?i)\\.pdf$"))
    bare = normalised_path(F.col("path"))
    tries = F.when(bare.contains("/"), F.array(bare)).otherwise(F.array(bare, *[F.concat(F.lit(x + "/"), bare) for x in FOLDERS]))
    tried = named.select("case_id", "id", "n", "path", F.explode(tries).alias("at"))
    there = files.select("case_id", F.col("path").alias("at"), F.lit(1).alias("found")).dropDuplicates(["case_id", "at"])
    seen = tried.join(there, ["case_id", "at"], "left").groupBy("case_id", "id", "n", "path").agg(F.max("found").alias("found"))
    gone = seen.filter(F.col("found").isNull()).groupBy("case_id", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "path"))), lambda x: x["path"]).alias("missing_resources"))
    return items.join(gone, ["case_id", "id"], "left").withColumn("missing_resources", F.coalesce("missing_resources", F.array().cast("array<string>")))


def new_fields(items: DataFrame) -> DataFrame:
    """The fields of a new review: case_id, id, status, original_value, evidence_paths."""
    return items.select("case_id", "id", F.when(F.col("auto_pass"), "verified").otherwise("pending").alias("status"), F.col("value").alias("original_value"), "evidence_paths")


def progress(items: DataFrame, fields: DataFrame) -> DataFrame:
    """case_id, completed, total, overall_status of reviews. fields: case_id, id, status; an item without a field is open."""
    blocked = F.col("missing_required") | (F.size("missing_resources") > 0) if "missing_resources" in items.columns else F.col("missing_required")
    return review_progress(items.withColumn("blocked", blocked).join(fields.select("case_id", "id", "status"), ["case_id", "id"], "left"))


def picture_paths(benchmark: Column) -> Column:
    """Distinct image paths of a benchmark input (VARIANT), selected ones first, then candidates and pages."""
    paths = F.flatten(F.array(*[F.transform(elements(benchmark, p), lambda x: _text(get(x, "image_path"))) for p in PICTURES]))
    return F.array_distinct(F.filter(paths, lambda p: p != ""))


def fingerprint_matches(a_analysis: Column, a_benchmark: Column, b_analysis: Column, b_benchmark: Column) -> Column:
    """Whether two fingerprints of a case, digests of its analysis and benchmark input, agree."""
    return a_analysis.eqNullSafe(b_analysis) & a_benchmark.eqNullSafe(b_benchmark)
