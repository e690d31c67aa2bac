"""Validation of whole cases: files, download indexes, verified claims, benchmark input, analysis and report are checked against each other.

Every relation is scanned and grouped by case once; a case's facts meet in one row, where all rules are expressions over its files (a map), its
index rows and its documents, so no rule reads a table of its own.

Cases: a case without any file, row or document has issues for all it lacks; documents that are no JSON are said to be so; a null text is a missing
file's; repeated files count once, the larger one; rules that need a missing document say nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound
from .analysis import DIMENSIONS, canonical, elements, get, given, is_object, spelled, whole_number
from .cases import missing_numbers

# Files that a case must have, documents that must be OCRed, tokens of the report, fields of records, least letters of texts.
REQUIRED = ("register/{app}-main.html", "register/{app}-doclist.html", "register/{app}-doclist.csv", "{app}-benchmark-input.json", "{app}-analysis.json", "{app}-analysis.html")
KEY_DOCUMENT = "(?i)claims|amended_claims|communication|decision|annex|reply|search_opinion|search_report|summons|grounds"
TOKENS = ("Patent Examination Benchmark Report", "案件元数据", "审查维度评分", "风险原因", "建议依据原文", "引用先文", "说明书/支持证据", "审查材料证据")
META = ("jurisdiction", "application_number", "title", "applicant", "filing_date", "examination_date", "outcome")
DISCUSSED = ("analysis", "original_text", "translation", "llm_evidence_explanation")
SENTENCE = ("issue", "source", "original_text", "translation", "llm_evidence_explanation")
SPOKEN = ("original_text", "english", "translation", "chinese")
TRACED = ("affected_claims", "examination_rounds", "specification_support", "examination_material_evidence")
LEAST_CLAIM, LEAST_CLAIM_1, LEAST_OCR = 20, 120, 80


def _some(*issues: Column) -> Column:
    """The issues that are there (not null), in order."""
    return F.filter(F.array(*issues), lambda x: x.isNotNull())


def _none() -> Column:
    return F.array().cast("array<string>")


def _say(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^A-Za-z0-9\\x{4e00}-\\x{9fff}]", ""))


def file_issues(app: Column, files: Column) -> Column:
    """Required files that are missing or empty. files: map of path to struct<length, pdf, sha256>."""
    issues = []
    for pattern in REQUIRED:
        before, after = pattern.split("{app}")
        path = _say(before, app, after)
        length = F.try_element_at(files, path)["length"]
        issues.append(F.when(length.isNull(), _say("missing ", path)).when(length == 0, _say("empty ", path)))
    return _some(*issues)


def index_issues(scope: str, rows: Column, files: Column, with_text: bool) -> Column:
    """What the rows of a folder's download index lack. rows: array<string> of file names in order."""
    at = lambda path: F.try_element_at(files, path)

    def one(name):
        pdf, stem = _say(scope + "/", name), F.regexp_replace(name, "(?<=.)\\.[^.]*$", "")
        text, ocr = _say(scope + "/", stem, ".txt"), _say(scope + "/", stem, "_ocr.txt")
        found = [F.when(at(pdf)["length"] == 0, _say("empty PDF: ", pdf)).when(~at(pdf)["pdf"], _say("bad PDF header: ", pdf))]
        if with_text:
            found.append(F.when(F.coalesce(at(text)["length"], F.lit(0)) == 0, _say("missing TXT: ", text)))
            found.append(F.when(name.rlike(KEY_DOCUMENT) & (F.coalesce(at(ocr)["length"], F.lit(0)) <= LEAST_OCR), _say("missing key OCR: ", ocr)))
        return F.when(at(pdf)["length"].isNull(), F.array(_say("missing PDF: ", pdf))).otherwise(_some(*found))

    index = f"{scope}/download-index.csv"
    return F.when(at(F.lit(index)).isNull(), F.array(F.lit("missing " + index))).when(F.size(rows) == 0, F.array(F.lit("empty " + index))).otherwise(F.flatten(F.transform(rows, one)))


def claims_issues(app: Column, text: Column, files: Column) -> Column:
    """What a file of verified claims lacks: its source, its list, and each claim in order."""
    v = F.try_parse_json(text)
    source, digest = spelled(get(v, "source_pdf")), get(v, "source_pdf_sha256")
    pdf = F.try_element_at(files, source)
    head = F.when((source != "") & pdf.isNull(), "claims source_pdf missing").when(given(digest) & (pdf["sha256"] != spelled(digest)), "claims source_pdf sha256 mismatch")
    rows = elements(v, "claims")
    numbers = F.transform(rows, lambda c: F.when(is_object(c), whole_number(get(c, "claim_number"))))

    def each(ns):
        def one(c, i):
            n, at = F.get(ns, i), _say("claims[", i.cast("string"), "]")
            named = lambda tail: _say("claim ", n.cast("string"), tail)
            verified = F.lower(F.when(given(get(c, "status")), spelled(get(c, "status"))).otherwise("")) == "verified"
            body = F.when(given(get(c, "text")), spelled(get(c, "text"))).otherwise("")
            said = _some(F.when(F.array_position(ns, n) < i + 1, _say("duplicate claim ", n.cast("string"))), F.when(~verified, named(" not verified")), F.when(_letters(body) < LEAST_CLAIM, named(" text too short")))
            return F.when(~is_object(c), F.array(_say(at, " not object"))).when(n.isNull(), F.array(_say(at, ".claim_number invalid"))).otherwise(said)

        have = F.array_sort(F.array_distinct(F.filter(ns, lambda n: n.isNotNull()))).cast("array<int>")
        gone = missing_numbers(have)
        ends = bound(gone, lambda g: _some(F.when((F.size(have) > 0) & ~F.array_contains(have, 1), "claim 1 missing"), F.when(F.size(g) > 0, _say("claim numbers not contiguous, missing: ", F.array_join(g, ",")))))
        return F.concat(F.flatten(F.transform(rows, one)), ends)

    listed = F.when(F.size(rows) == 0, F.array(F.lit("claims verified list empty"))).otherwise(bound(numbers, each))
    return F.when(text.isNull(), F.array(_say("missing ", app, "-claims-verified.json"))).when(v.isNull(), F.array(F.lit("claims verified JSON parse error"))).otherwise(F.concat(_some(head), listed))


def benchmark_issues(text: Column) -> Column:
    v = F.try_parse_json(text)
    claim = get(v, "benchmark_input.claim_text.claim_1")
    short = _letters(F.when(given(claim), spelled(claim)).otherwise("")) < LEAST_CLAIM_1
    return F.when(text.isNull(), _none()).otherwise(_some(F.when(v.isNull(), "benchmark JSON parse error").when(short, "benchmark claim_1 too short")))


def missing_fields(v: Column) -> Column:
    """Paths of fields that an analysis (VARIANT) must have and hasn't."""
    lacks = lambda path: F.when(~given(get(v, path)), path)
    blank = lambda path: F.when(canonical(get(v, path)).isin("null", '""'), path)
    parts = [_some(*[lacks(f"meta.{k}") for k in META], lacks("grant_label"), blank("aggregate_score"))]
    for d in DIMENSIONS:
        score, disc = f"dimension_scores.{d}_score", f"dimension_scores.{d}_disc"
        parts.append(_some(blank(score)))
        parts.append(F.when(is_object(get(v, disc)), _some(*[lacks(f"{disc}.{k}") for k in DISCUSSED])).otherwise(F.array(F.lit(disc))))

    def listed(key, one):
        return F.when(F.size(elements(v, key)) > 0, F.flatten(F.transform(elements(v, key), one))).otherwise(F.array(F.lit(key)))

    place = lambda key, i: _say(f"{key}[", i.cast("string"), "]")
    silent = lambda x: F.when(is_object(x), ~F.array_contains(F.array(*[given(get(x, k)) for k in SPOKEN]), True)).otherwise(~given(x))

    def spoken(key):
        return lambda x, i: _some(F.when(silent(x), place(key, i)))

    def sentence(key):
        return lambda x, i: F.when(is_object(x), _some(*[F.when(~given(get(x, k)), _say(place(key, i), "." + k)) for k in SENTENCE])).otherwise(F.array(place(key, i)))

    parts += [listed(key, spoken(key)) for key in ("top_risk_reasons", "recommended_actions")]
    parts += [listed(key, sentence(key)) for key in ("risk_source_sentences", "action_basis_source_sentences")]
    return F.concat(*parts, _some(*[lacks(f"evidence_trace.{k}") for k in TRACED]))


def analysis_issues(text: Column) -> Column:
    v = F.try_parse_json(text)
    return F.when(text.isNull(), _none()).when(v.isNull(), F.array(F.lit("analysis JSON parse error"))).otherwise(missing_fields(v))


def report_issues(html: Column) -> Column:
    return F.when(html.isNull(), _none()).otherwise(_some(*[F.when(~html.contains(t), "HTML missing token: " + t) for t in TOKENS]))


def validate(cases: DataFrame, files: DataFrame, index: DataFrame, require_claims: bool = False) -> DataFrame:
    """case_id, docs_index_rows, original_index_rows, status (pass, fail), issues (array, in the order of the rules).

    cases: case_id, claims, benchmark, analysis, html (texts, null where there is no such file). files: case_id, path, length, pdf (whether it begins like one),
    sha256. index: case_id, scope (docs, original-application), place, file."""
    entry = F.struct("path", F.struct("length", "pdf", "sha256").alias("entry"))
    once = files.groupBy("case_id", "path").agg(F.max_by(F.struct("length", "pdf", "sha256"), "length").alias("f")).select("case_id", "path", "f.*")
    f = once.groupBy("case_id").agg(F.map_from_entries(F.collect_list(entry)).alias("files"))
    ordered = lambda scope: F.transform(F.array_sort(F.collect_list(F.when(F.col("scope") == scope, F.struct("place", F.element_at(F.split(F.replace("file", F.lit("\\"), F.lit("/")), "/"), -1).alias("file"))))), lambda x: x["file"])
    i = index.groupBy("case_id").agg(ordered("docs").alias("docs"), ordered("original-application").alias("original"))
    none = F.create_map().cast("map<string, struct<length: bigint, pdf: boolean, sha256: string>>")
    c = cases.select("case_id", "claims", "benchmark", "analysis", "html").join(f, "case_id", "left").join(i, "case_id", "left")
    c = c.withColumns({"files": F.coalesce(F.col("files").cast("map<string, struct<length: bigint, pdf: boolean, sha256: string>>"), none), "docs": F.coalesce("docs", _none()), "original": F.coalesce("original", _none())})
    there = lambda scope, rows: F.when(F.map_contains_key("files", F.lit(f"{scope}/download-index.csv")), F.size(rows)).otherwise(0)
    app, known = F.col("case_id").cast("string"), F.col("files")
    parts = [file_issues(app, known), index_issues("docs", F.col("docs"), known, True), index_issues("original-application", F.col("original"), known, False)]
    parts += [claims_issues(app, F.col("claims"), known)] if require_claims else []
    issues = F.concat(*parts, benchmark_issues(F.col("benchmark")), analysis_issues(F.col("analysis")), report_issues(F.col("html")))
    c = c.select("case_id", there("docs", "docs").alias("docs_index_rows"), there("original-application", "original").alias("original_index_rows"), issues.alias("issues"))
    return c.select("case_id", "docs_index_rows", "original_index_rows", F.when(F.size("issues") == 0, "pass").otherwise("fail").alias("status"), "issues")
