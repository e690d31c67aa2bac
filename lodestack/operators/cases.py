"""Case files as tables: profiles of folders, validation of claims, review state, register pages, cited documents, boxes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import publications, rules
from ..functions.text import clean_text, date_rank, has_meaningful_text, iso_date, norm_space
from .matching import by_page

# The classes of a case in order.
CASE_CLASSES = "A_strict_complete B_original_text_and_benchmark C_original_pdf_text_ready D_original_pdf_needs_text_extract E_original_fallback_only F_file_wrapper_docs_only G_register_metadata_only H_misc_or_failed_artifacts I_empty_case_dir".split()
DONE = ("verified", "corrected_verified", "not_applicable")

#: Counters of a case folder: name, section (None: anywhere) and end of the file name (None: any).
COUNTERS = (
    ("original_pdf", "original-application", ".pdf"), ("original_txt", "original-application", ".txt"), ("original_html", "original-application", ".html"),
    ("original_xml", "original-application", ".xml"), ("original_zip", "original-application", ".zip"), ("original_index", "original-application", "/download-index.csv"),
    ("original_source_json", "original-application", "/publication-server-source.json"), ("docs_pdf", "docs", ".pdf"), ("docs_txt", "docs", ".txt"),
    ("docs_index", "docs", "/download-index.csv"), ("register_main_html", "register", "-main.html"), ("register_doclist_html", "register", "-doclist.html"),
    ("register_doclist_csv", "register", "-doclist.csv"), ("benchmark_input_json", None, "-benchmark-input.json"), ("rendered_png", "assets", ".png"),
    ("rendered_json", "assets", ".json"), ("prior_art_files", "prior-art", None), ("total_files", None, None), ("register_files", "register", None),
)
SIZES = (("total_mb", None, None), ("original_mb", "original-application", None), ("docs_mb", "docs", None), ("register_mb", "register", None), ("assets_mb", "assets", None), ("prior_art_mb", "prior-art", None), ("benchmark_mb", None, "-benchmark-input.json"))
#: Stages that a profile takes over from the ledger.
LEDGER = ("ledger_original_stage", "ledger_docs_stage", "ledger_processing_stage")


def case_profile(files: DataFrame, cases: DataFrame, status: Column | None = None, ledger: dict[str, Column] | None = None) -> DataFrame:
    """One row per case with all counters, sizes, flags and its class. files: case_id, path (below the case's folder), bytes; cases: case_id
    and what ``status`` and the columns of ``ledger`` (stages by name) read. One aggregate with map-side partial sums; cases without files stay.

    Besides what is reported there are register_files, any file in that folder, and own_benchmark_input, the input named after the case."""
    section = F.when(F.contains("path", F.lit("/")), F.split_part("path", F.lit("/"), F.lit(1))).otherwise("")

    def fits(where, end):
        ok = F.lit(True) if where is None else section == where
        return ok & (F.concat(F.lit("/"), F.col("path")).endswith(end) if end else F.lit(True))

    counts = [F.count_if(fits(where, end)).alias(name) for name, where, end in COUNTERS]
    sizes = [F.round(F.sum(F.when(fits(where, end), F.col("bytes")).otherwise(0)) / 1048576, 3).alias(name) for name, where, end in SIZES]
    counts.append(F.count_if(F.col("path") == F.concat(F.col("case_id").cast("string"), F.lit("-benchmark-input.json"))).alias("own_benchmark_input"))
    told = {"ledger_status": status} | {name: (ledger or {}).get(name) for name in LEDGER}
    found = cases.withColumns({name: F.lit("") if x is None else F.coalesce(x, F.lit("")) for name, x in told.items()}).join(files.groupBy("case_id").agg(*counts, *sizes), "case_id", "left").na.fill(0)
    n = F.col
    fallback = n("original_html") + n("original_xml") + n("original_zip")
    register = n("register_main_html") + n("register_doclist_html") + n("register_doclist_csv")
    tests = [n("ledger_status") == "full_success", (n("original_pdf") > 0) & (n("original_txt") > 0) & (n("benchmark_input_json") > 0), (n("original_pdf") > 0) & (n("original_txt") > 0), n("original_pdf") > 0, fallback > 0, n("docs_pdf") + n("docs_txt") > 0, register > 0, n("total_files") > 0]
    kind = F.lit(CASE_CLASSES[-1])
    for test, name in reversed(list(zip(tests, CASE_CLASSES))):
        kind = F.when(test, name).otherwise(kind)
    return found.withColumns({
        "primary_class": kind,
        "has_original_material": n("original_pdf") + fallback > 0,
        "has_original_text": n("original_txt") > 0,
        "has_docs_material": n("docs_pdf") + n("docs_txt") > 0,
        "has_register_metadata": register > 0,
        "has_local_processing": n("benchmark_input_json") + n("rendered_png") > 0,
    })


def stages(profile: DataFrame, last_status: Column) -> DataFrame:
    """Stage of the original, the wrapper and the processing, and the overall status, from a profile's counters."""
    n = F.col
    texts = lambda pdf, txt: F.when((n(pdf) > 0) & (n(txt) > 0), "success_pdf_text").when(n(pdf) > 0, "success_pdf")
    told = F.when(last_status.isin("publication_unavailable", "pdf_unavailable"), last_status).when(last_status == "error", "failed").otherwise("not_started")
    original = texts("original_pdf", "original_txt").when(n("original_html") + n("original_xml") + n("original_zip") > 0, "success_fallback").otherwise(told)
    docs = texts("docs_pdf", "docs_txt").when(n("register_files") > 0, "register_seen_no_docs").otherwise("not_started")
    local = F.when(n("own_benchmark_input") > 0, "benchmark_input_ready").when(n("original_txt") + n("docs_txt") > 0, "source_text_ready").otherwise("not_started")
    out = profile.withColumns({"original_stage": original, "docs_stage": docs, "processing_stage": local})
    good = [n("original_stage").startswith("success_"), n("docs_stage").startswith("success_"), n("processing_stage") == "benchmark_input_ready"]
    overall = F.when(good[0] & good[1] & good[2], "full_success").when(good[0] | good[1] | good[2], "partial_success").when((n("total_files") > 0) | last_status.isNotNull(), "failed").otherwise("not_started")
    return out.withColumn("overall_status", overall)


def missing_numbers(have: Column, most: int = 1000) -> Column:
    """Texts of the numbers from 1 that a sorted array of distinct ones skips; more than ``most`` in a row are one text (4-2000000)."""
    known = F.concat(F.array(F.lit(0)), F.filter(have, lambda n: n > 0))
    first, last = lambda n: n + 1, lambda i: F.get(known, i + 1) - 1
    listed = lambda a, b: F.transform(F.sequence(a, b), lambda n: n.cast("string"))
    none = F.array().cast("array<string>")
    gap = lambda n, i: F.when(F.coalesce(last(i) < first(n), F.lit(True)), none).when(last(i) - n > most, F.array(F.concat(first(n).cast("string"), F.lit("-"), last(i).cast("string")))).otherwise(listed(first(n), last(i)))
    return F.flatten(F.transform(known, gap))


def claim_issues(claims: DataFrame) -> DataFrame:
    """case_id, issues (sorted): duplicate, unverified, short and missing claims. claims: case_id, claim_number (text), status, text."""
    number = F.col("claim_number").try_cast("int")
    c = claims.withColumn("n", number)
    said = lambda rows, issue: rows.select("case_id", issue.alias("issue"))
    named = lambda tail: F.concat(F.lit("claim "), F.col("n").cast("string"), F.lit(tail))
    valid = c.filter("n is not null")
    short = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z0-9\\x{4e00}-\\x{9fff}]", "")) < 20
    per = valid.groupBy("case_id").agg(F.max("n").alias("top"), F.array_sort(F.collect_set("n")).alias("have"))
    per = per.withColumn("gone", missing_numbers(F.col("have")))
    issues = [
        said(c.filter("n is null"), F.lit("claim_number invalid")),
        said(valid.filter(F.lower(F.coalesce("status", F.lit(""))) != "verified"), named(" not verified")),
        said(valid.filter(short), named(" text too short")),
        said(valid.groupBy("case_id", "n").count().filter("count > 1"), F.concat(F.lit("duplicate claim "), F.col("n").cast("string"))),
        said(per.filter(~F.array_contains("have", 1)), F.lit("claim 1 missing")),
        said(per.filter(F.size("gone") > 0), F.concat(F.lit("claim numbers not contiguous, missing: "), F.array_join("gone", ","))),
    ]
    every = issues[0]
    for more in issues[1:]:
        every = every.unionByName(more)
    return every.groupBy("case_id").agg(F.array_sort(F.collect_list("issue")).alias("issues"))


def review_progress(items: DataFrame) -> DataFrame:
    """case_id, completed, total, overall_status. items: case_id, status (null: no field), auto_pass, blocked. A blocked item, one without a
    required resource, is done only by a verified correction."""
    status = F.coalesce("status", F.lit(""))
    done = F.col("auto_pass") | F.when(F.col("blocked"), status == "corrected_verified").otherwise(status.isin(*DONE))
    g = items.groupBy("case_id").agg(F.count_if(done).alias("completed"), F.count(F.lit(1)).alias("total"), F.bool_or(status == "rejected").alias("rejected"))
    return g.select("case_id", "completed", "total", F.when(F.col("rejected"), "needs_correction").when(F.col("completed") == F.col("total"), "success").otherwise("pending").alias("overall_status"))


def evidence_files(value: Column) -> Column:
    """Whether a value names a file that can be shown as evidence."""
    return value.rlike("(?i)\\.(pdf|txt|html?|png|jpe?g|webp)$")


def register_meta(pages: DataFrame) -> DataFrame:
    """app, application_number, title, applicant, filing_date, priority_date, register_status of register pages (app, html)."""
    text = clean_text(F.col("html"))
    p = pages.select("app", "html", text.alias("text"))
    filed = "Application number, filing date\\s+([0-9.]+)\\s+([0-9]{2}\\.[0-9]{2}\\.[0-9]{4})"
    title = F.regexp_extract("html", "(?is)<td[^>]*>\\s*English:\\s*</td>\\s*<td[^>]*>(.*?)</td>", 1)
    linked = F.regexp_extract("html", "(?is)EP[0-9]+\\s*-\\s*(.*?)</a>", 1)
    lines = F.split(F.regexp_extract("html", "(?is)Applicant\\(s\\)</td>\\s*<td[^>]*>(.*?)</td>", 1), "(?i)<br\\s*/?>")
    tidy = lambda x: rules.without_bulletin(norm_space(F.regexp_replace(x, "(?s)<[^>]+>", " ")))
    lines = F.filter(F.transform(lines, tidy), lambda x: (x != "") & (F.lower(x) != "for all designated states"))
    number = F.regexp_extract("text", filed, 1)
    return p.select(
        "app",
        F.when(number != "", F.concat(F.lit("EP"), number)).otherwise(F.col("app")).alias("application_number"),
        F.coalesce(F.nullif(tidy(title), F.lit("")), tidy(linked)).alias("title"),
        F.coalesce(F.get(lines, F.lit(0)), F.lit("")).alias("applicant"),
        iso_date(F.regexp_extract("text", filed, 2)).alias("filing_date"),
        iso_date(F.regexp_extract("text", "Priority number, date\\s+.*?([0-9]{2}\\.[0-9]{2}\\.[0-9]{4})", 1)).alias("priority_date"),
        rules.register_status(F.col("text")).alias("register_status"),
    )


def mentions(documents: DataFrame, case_col: str = "case_id", application_col: str = "application", source_col: str = "source", text_col: str = "text", order_col: str = "place", ascii: bool = False) -> DataFrame:
    """Row per citation in the texts of a case: case_id, application, source, citation, at (place of the document, then labelled lines, labels in
    the text, bare publications, in order). A null text has none. ascii: words, digits and spaces are those of ASCII, not of Unicode."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = F.array(*[way(text, ascii) for way in (publications.labelled_lines, publications.labelled, publications.all_in)])
    rows = documents.select(F.col(case_col).alias("case_id"), F.col(application_col).alias("application"), F.col(source_col).alias("source"), F.col(order_col).alias("place"), F.posexplode_outer(found).alias("way", "cited"))
    rows = rows.select("case_id", "application", "source", "place", "way", F.posexplode_outer("cited").alias("n", "citation")).filter(F.col("citation").isNotNull())
    return rows.select("case_id", "application", "source", "citation", F.struct("place", "way", "n").alias("at"))


def prior_art(mentions: DataFrame, k: int, documents: DataFrame | None = None) -> DataFrame:
    """case_id, rank, citation, mentions, sources: the k most mentioned documents of each case, one for each key. mentions: case_id,
    application, source, citation, at (order of appearance). Noise is left out; ties go to the earlier citation, then by name.

    Only documents that name an examination step count, all documents of a case that has none. documents: case_id, source of all documents, also of those
    without mentions (left out: the sources of the mentions)."""
    tidy = F.regexp_replace(norm_space(F.col("citation")), "^[ ;,.]+|[ ;,.]+$", "")
    examined = rules.is_examined_source(F.col("source"))
    known = (mentions if documents is None else documents).groupBy("case_id").agg(F.bool_or(examined).alias("any_examined"))
    m = mentions.join(known, "case_id").filter(examined | ~F.col("any_examined")).withColumn("citation", tidy).withColumn("publication", rules.cited_publication(F.col("citation")))
    m = m.filter((F.col("citation") != "") & ~rules.is_noise_citation(F.col("citation"), F.col("application"), F.col("publication")))
    g = m.groupBy("case_id", "citation", "publication").agg(F.count(F.lit(1)).alias("mentions"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.min("at").alias("at"))
    g = g.filter(~F.col("publication").isin(*publications.UNTRUSTED))
    best = F.min_by(F.struct("citation", "mentions", "sources", "at"), F.struct(-F.col("mentions"), "at", "citation")).alias("best")
    g = g.groupBy("case_id", rules.citation_key(F.col("citation"), F.col("publication")).alias("key")).agg(best).select("case_id", "best.*")
    w = Window.partitionBy("case_id").orderBy(F.desc("mentions"), "at", "citation")
    return g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("case_id", "rank", "citation", "mentions", "sources")


def source_texts(documents: DataFrame, max_files: int, max_chars: int, budget: int | None = None) -> DataFrame:
    """case_id, place (from 1), name, text: the first ``max_files`` documents of a case that hold meaningful text, by priority, date (late first) and
    name, each cut to max_chars, and all of them together to ``budget`` characters: one that is too long for the rest is cut, later ones are left out.

    documents: case_id, name, text. A null text is never meaningful; equal names are taken in order of their texts. Only the first rows of a case and cut
    texts leave a task."""
    d = documents.select("case_id", "name", F.substring(F.coalesce("text", F.lit("")), 1, max_chars).alias("text")).filter(has_meaningful_text(F.col("text")))
    order = [rules.document_priority(F.col("name")), -date_rank(F.col("name")), "name", "text"]
    d = d.withColumn("place", F.row_number().over(Window.partitionBy("case_id").orderBy(*order))).filter(F.col("place") <= max_files)
    if budget is None:
        return d.select("case_id", "place", "name", "text")
    before = F.coalesce(F.sum(F.length("text")).over(Window.partitionBy("case_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    d = d.withColumn("left", (F.lit(budget) - before).cast("int")).filter(F.col("left") > 0)
    return d.select("case_id", "place", "name", F.substring("text", F.lit(1), F.col("left")).alias("text"))


def text_rows(centres: DataFrame, key: str, y: str, height: int = 14, least: int = 5) -> DataFrame:
    """key, n: rows of text on a page, counted as bands of ``height`` that hold ``least`` centres or more."""
    bands = centres.groupBy(key, F.floor(F.col(y) / height).alias("band")).count()
    return bands.groupBy(key).agg(F.count_if(F.col("count") >= least).alias("n"))


def merged_boxes(boxes: DataFrame, pad: int = 8, buckets: int | None = None) -> DataFrame:
    """page, x, y, w, h: boxes grown by ``pad`` and united while they touch, in order of box."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        pages: dict[int, list[tuple]] = {}
        for r in rows.itertuples():
            united = pages.setdefault(r.page, [])
            rect = (r.x - pad, r.y - pad, r.x + r.w + pad, r.y + r.h + pad)
            while touching := [o for o in united if o[0] <= rect[2] and rect[0] <= o[2] and o[1] <= rect[3] and rect[1] <= o[3]]:
                united[:] = [o for o in united if o not in touching]
                lows, highs = zip(*[(b[:2], b[2:]) for b in (rect, *touching)])
                rect = (*map(min, zip(*lows)), *map(max, zip(*highs)))
            united.append(rect)
        return pd.DataFrame([(page, a, b, c - a, d - b) for page, united in pages.items() for a, b, c, d in united], columns=["page", "x", "y", "w", "h"])

    return by_page(boxes, ["box"], one, "page long, x long, y long, w long, h long", buckets)
