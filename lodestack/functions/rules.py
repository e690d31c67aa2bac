"""Ordered rules over names, paths and lines of case files, as tables that one builder turns into expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import claims
from . import publications
from .text import bound, norm_space

# Patterns and their results, the first that fits wins.
DOCUMENT_PRIORITY = (
    ("decision_to_grant|decision to grant", 0), ("decision_to_refus|decision to refus|application_refused", 1), ("withdrawn", 2), ("intention_to_grant", 3),
    ("communication_from_the_examining_division", 4), ("annex_to_the_communication", 5), ("reply_to_communication", 6), ("amended_claims", 7),
    ("(?:^|_)claims(?:_|\\.|$)", 8), ("search_opinion|search_report", 9), ("text_intended_for_grant", 10), ("description", 11), ("published_international", 12),
)
PDF_KIND = (
    ("^(?=.*text_intended_for_grant)(?=.*clean_copy)", "text_intended_for_grant_clean_copy"),
    ("^(?=.*text_intended_for_grant)(?=.*version_for_approval)", "text_intended_for_grant_version_for_approval"),
    ("amended_claims", "amended_claims"),
    ("(?:^|_)claims(?:_|\\.|$)", "claims"),
)
# Kinds in order of authority, by outcome.
AUTHORITY = {
    "granted": ("text_intended_for_grant_clean_copy", "text_intended_for_grant_version_for_approval", "claims", "amended_claims"),
    "": ("claims", "amended_claims", "text_intended_for_grant_clean_copy", "text_intended_for_grant_version_for_approval"),
}
SNIPPET_WEIGHTS = (
    ("markush", 1800), ("scope of formula|represented by the following formula", 1600), ("formula\\s*\\((?:i|ii|iii|iv|v|vi|vii|viii|ix|x|xi|xii|\\d+)\\)", 1300),
    ("^(?=.*wherein)(?=.*formula)", 600), ("claim 1|compound of claim", 250), ("chemical formulae|definitions|tautomers", -900),
)
# Section and suffix of a path in a case folder; None stands for any other suffix.
SECTIONS = {
    "original-application": ("original_publication", {"pdf": "pdf", "txt": "text", "html": "fallback", "xml": "fallback", "zip": "fallback", "csv": "metadata", "json": "metadata", None: "misc"}),
    "docs": ("file_wrapper", {"pdf": "pdf", "txt": "text", "csv": "index", None: "misc"}),
}
BUCKET_OTHER = {"register": "register_metadata", "prior-art": "prior_art"}
EXAMINED = "search_(?:opinion|report)|communication|annex|summons|grounds|decision"
UNEXAMINED = "claims|description|text_intended|published_international|translation"
NOISE_TERMS = ("DOCUMENTS", "DES BREVETS", "THIS ANNEX", "EUROPEAN SEARCH REPORT", "EUROPEAN SEARCH OPINION", "COMMUNICATION REGARDING", "AMENDED CLAIMS", "WHEREIN", "ACCORDING TO", "CHARACTERIZING", "SELECTED", "LOCATIONS AT", "PRODUCT IS", "ESTIMATING")
BLOCK_MARKS = ("challenge page", "robotabuse", "cloudflare", "just a moment", "__cf_chl", "cdn-cgi/challenge")
REGISTER_STATUS = ("No opposition filed within time limit", "The patent has been granted", "Application deemed to be withdrawn", "Application refused", "Examination is in progress", "Grant of patent is intended")


def first_match(x: Column, rules, otherwise) -> Column:
    """The result of the first rule whose pattern occurs in x."""
    out = F.lit(otherwise)
    for pattern, result in reversed(rules):
        out = F.when(x.rlike(pattern), result).otherwise(out)
    return out


def document_priority(name: Column) -> Column:
    """0 for what decides a case, rising to 12; 20 for the rest."""
    return first_match(F.lower(name), DOCUMENT_PRIORITY, 20)


def pdf_kind(name: Column) -> Column:
    return first_match(F.lower(name), PDF_KIND, "other")


def authority(name: Column, outcome: Column) -> Column:
    """Place of a claims source's kind by the case's outcome, 20 for other kinds."""
    place = lambda order: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), pdf_kind(name)) - 1, F.lit(-1)), F.lit(20))
    return F.when(outcome == "granted", place(AUTHORITY["granted"])).otherwise(place(AUTHORITY[""]))


def snippet_priority(text: Column) -> Column:
    """Sum of the weights of all patterns that occur."""
    t = F.lower(text)
    parts = [F.when(t.rlike("(?s)" + p), w).otherwise(0) for p, w in SNIPPET_WEIGHTS]
    return sum(parts[1:], parts[0])


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, "\\.([^./]*)$", 1))


def file_bucket(path: Column, case_prefix: str = "EP") -> Column:
    """Bucket of a path relative to the output folder."""
    parts, end = F.split(path, "/"), suffix(path)
    top, section = parts[0], F.get(parts, F.lit(1))

    def by_suffix(name: str, kinds: dict) -> Column:
        out = F.lit(f"{name}_{kinds[None]}")
        for s, kind in kinds.items():
            out = F.when(end == s, f"{name}_{kind}").otherwise(out) if s else out
        return out

    inside = F.when(section == "assets", F.when(end == "png", "local_rendered_png").when(end == "json", "local_rendered_json").otherwise("local_asset_misc"))
    for name, kinds in SECTIONS.items():
        inside = inside.when(section == name, by_suffix(*kinds))
    for name, bucket in BUCKET_OTHER.items():
        inside = inside.when(section == name, bucket)
    root = F.when(path.endswith("-benchmark-input.json"), "case_benchmark_input").otherwise("case_root_misc")
    return F.when(top.isin("_logs", "_state"), top).when(~top.startswith(case_prefix), "root_status_or_audit").when(F.size(parts) == 1, root).otherwise(inside.otherwise("case_other"))


def artifact_kind(path: Column) -> Column:
    """Kind of a file by any part of its path, in any case."""
    parts, end = F.split(F.lower(path), "/"), suffix(path)
    has = lambda name: F.array_contains(parts, name)
    wrapper = F.when(end == "pdf", "file_wrapper_pdf").when(end == "txt", "file_wrapper_text").otherwise("file_wrapper_metadata")
    original = F.when(end == "pdf", "original_publication_pdf").when(end == "txt", "original_publication_text").when(end.isin("html", "xml", "zip"), "original_publication_fallback").otherwise("original_publication_metadata")
    loose = F.when(end == "pdf", "unclassified_pdf").when(end.isin("html", "csv", "json"), "case_metadata").otherwise("other")
    return F.when(has("original-application"), original).when(has("docs"), wrapper).when(has("register"), "register_metadata").when(has("prior-art"), "prior_art").otherwise(loose)


def is_examined_source(name: Column) -> Column:
    """Whether a document may cite prior art as examined: what names an examination step, or doesn't name a text of the applicant."""
    n = F.lower(name)
    return n.rlike(EXAMINED) | ~n.rlike(UNEXAMINED)


def is_noise_citation(citation: Column, application: Column, publication: Column | None = None) -> Column:
    """Phrases, numbers without a publication, the application itself, application numbers, and terms of forms. publication: the cited one, where known."""
    upper = F.upper(citation)
    digits = lambda c: F.regexp_replace(c, "\\D", "")
    own, cited = digits(F.coalesce(application, F.lit(""))), digits(upper)
    phrase = upper.rlike("^D[0-9]{1,2}\\s+(IS|FROM|DOES|REPRESENTS|MENTIONS|SHOWS)\\b")
    itself = (own != "") & F.contains(cited, F.substring(own, 1, 8))
    return phrase | ((cited_publication(citation) if publication is None else publication) == "") | itself | upper.rlike("\\b(?:PCT/)?[A-Z]{2}\\d{2}/\\d{4,}\\b") | upper.rlike("|".join(NOISE_TERMS))


def cited_publication(citation: Column) -> Column:
    """Publication that a citation names, with or without its label."""
    return publications.find(citation)


def _number_or_start(citation: Column) -> Column:
    bare = F.regexp_replace(F.trim(citation), "(?i)^\\s*D[0-9]{1,2}\\s+", "")
    number = F.regexp_extract(bare, "(?i)\\b((?:WO|EP|US|JP|CN|GB)[-\\s]?[A-Z]?-?\\s?[0-9][A-Z0-9/.,\\-\\s]{3,50})", 1)
    return F.coalesce(F.nullif(norm_space(number), F.lit("")), norm_space(F.substring(bare, 1, 120)))


def citation_query(citation: Column) -> Column:
    """What a citation is looked up by: its publication, a number in it, or its first 120 characters without the label."""
    return bound(cited_publication(citation), lambda p: F.when(p != "", p).otherwise(_number_or_start(citation)))


def citation_key(citation: Column, publication: Column | None = None) -> Column:
    """Citations with the same key are the same document: the publication without its kind, else the query. publication: the cited one, where known."""
    return F.lower(bound(cited_publication(citation) if publication is None else publication, lambda p: F.when(p != "", F.regexp_replace(p, "[A-Z]\\d?$", "")).otherwise(_number_or_start(citation))))


def is_noise_line(line: Column) -> Column:
    """Empty lines, page and line numbers, number ranges, headings and running heads of claims pages."""
    return claims.is_noise(claims.cleaned(line))


def is_blocked(error: Column) -> Column:
    """Whether an error page says that all fetching is blocked."""
    return F.lower(F.coalesce(error, F.lit(""))).rlike("|".join(BLOCK_MARKS))


def extraction_status(selected: Column, candidates: Column, pages: Column, snippets: Column) -> Column:
    """How far the search for drawings came, by the counts of its steps."""
    return F.when(selected > 0, "selected").when(candidates > 0, "candidates_rejected").when(pages > 0, "pages_no_candidates").when(snippets > 0, "snippets_no_pages").otherwise("no_formula_context")


def register_status(text: Column) -> Column:
    """The first status of the list that the register page names, '' for none."""
    return first_match(text, [(s, s) for s in REGISTER_STATUS], "")


def without_bulletin(text: Column) -> Column:
    return norm_space(F.regexp_replace(text, "\\[[0-9]{4}/[0-9]{2}\\]", " "))
