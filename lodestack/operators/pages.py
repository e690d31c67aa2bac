"""Choice of pages: which pages of a source a snippet stands on, and which pages hold formulas.

A source is one row with all snippets that name it; its pages are cut inside the row and scored against each snippet, so texts are moved once however many
snippets they have, and no pair of page and snippet leaves the row but those chosen.

Cases: a text without page marks is page 1; what stands before the first mark belongs to no page; null texts and sources without a text give no pages;
equal scores go to the smaller page number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import bound

# Marks, words and numbers that speak for a formula, what refers to one, words of snippets that have no page.
PAGE = r"(?i)---\s*PAGE\s+(\d+)\s*---"
KEYWORDS = ("markush", "formula", "compound represented by the following formula", "scope of formula", "wherein")
#: The look ahead costs less than the boundary at the many places where nothing begins.
SYMBOLS = r"(?i)(?=[RXF])\b(?:[RX]\d*[A-Z]?\b|Formula\s*\(?[IVX0-9]+\)?)"
FORMULA = r"(?i)formula\s*\(?\s*([ivx0-9]+)\s*\)?"
NO_PAGE = ("chemical formulae", "definitions")
#: Tokens of a snippet that count, their least length, and the tokens a page needs with and without the snippet's formula.
FIRST_TOKENS, LEAST_TOKEN, WITH_FORMULA, WITHOUT = 80, 3, 5, 18


def simple(text: Column) -> Column:
    """Lower case letters and digits, anything else as one space."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def text_pages(text: Column) -> Column:
    """array<struct<page, text>> of a page-delimited text."""
    marked = F.arrays_zip(F.regexp_extract_all(text, F.lit(PAGE), F.lit(1)).alias("n"), F.slice(F.split(text, PAGE), 2, 1 << 30).alias("text"))
    pages = F.transform(marked, lambda p: F.struct(p["n"].try_cast("long").alias("page"), p["text"].alias("text")))
    return F.when(text.isNull(), F.array().cast("array<struct<page: bigint, text: string>>")).when(text.rlike(PAGE), pages).otherwise(F.array(F.struct(F.lit(1).cast("long").alias("page"), text.alias("text"))))


def formula_score(text: Column) -> Column:
    """How much speaks for a formula on a page: three for each keyword, one for each symbol."""

    def times(low, word):
        return ((F.length(low) - F.length(F.replace(low, F.lit(word), F.lit("")))) / len(word)).cast("int") * 3

    return bound(F.lower(text), lambda low: sum((times(low, k) for k in KEYWORDS), F.lit(0))) + F.regexp_count(text, F.lit("(?U)" + SYMBOLS))


def tokens(plain: Column) -> Column:
    """The words that count of what simple gives."""
    return F.filter(F.split(plain, " "), lambda t: F.length(t) >= LEAST_TOKEN)


def _best(scored: Column, most: int) -> Column:
    """The numbers of the best pages: scored is array<struct<score, page>>."""
    order = F.array_sort(F.transform(scored, lambda s: F.struct((-s["score"]).alias("score"), s["page"].alias("page"))))
    return F.slice(F.transform(order, lambda s: s["page"]), 1, most)


def formula_pages(pages: Column, most: int) -> Column:
    """The pages that most speaks for a formula on, each number once."""
    scored = F.filter(F.transform(pages, lambda p: F.struct(formula_score(p["text"]).alias("score"), p["page"].alias("page"))), lambda s: s["score"] > 0)
    return F.slice(F.array_distinct(_best(scored, 1 << 30)), 1, most)


def snippet_pages(snippet: Column, pages: Column, most: int) -> Column:
    """The pages that a snippet most likely stands on. pages: array<struct<page, tokens, plain>>.

    Where it names formulas, pages that name one of them too (and the scope, if it does) come first, with a few tokens in common; else, or where no such page
    is found, many tokens must agree."""
    own = F.array_distinct(F.slice(tokens(simple(snippet)), 1, FIRST_TOKENS))
    names = F.transform(F.array_distinct(F.regexp_extract_all(snippet, F.lit(FORMULA), F.lit(1))), lambda x: F.concat(F.lit("formula "), F.lower(x)))
    scope = F.lower(snippet).contains("scope of formula")
    scored = bound(own, lambda o: F.transform(pages, lambda p: F.struct(F.size(F.array_intersect(o, p["tokens"])).alias("score"), p["page"].alias("page"), p["plain"].alias("plain"))))
    named = lambda s: F.exists(names, lambda x: s["plain"].contains(x)) & (~scope | s["plain"].contains("scope"))

    def chosen(s):
        first = F.filter(s, lambda p: (p["score"] >= WITH_FORMULA) & named(p))
        rest = F.filter(s, lambda p: p["score"] >= WITHOUT)
        nowhere = F.lit(False)
        for words in NO_PAGE:
            nowhere = nowhere | simple(snippet).contains(words)
        return F.when(F.size(first) > 0, _best(first, most)).when(nowhere, _best(F.slice(rest, 1, 0), most)).otherwise(_best(rest, most))

    return F.when(F.coalesce(snippet, F.lit("")) == "", F.array().cast("array<bigint>")).otherwise(bound(scored, chosen))


def pdf_of(source: Column) -> Column:
    """Name of the PDF that a text was taken from."""
    return F.regexp_replace(source, "(?i)_(ocr|text)\\.txt$", ".pdf")


def page_jobs(snippets: DataFrame, documents: DataFrame, max_pages: int, snippet_pages_at_most: int = 2) -> DataFrame:
    """case_id, pdf, page, source, priority: pages to look at, each once, with the highest priority of the snippets that led there (the first of equal ones).

    snippets: case_id, place (order), source, text. documents: case_id, source, text. A snippet that is found nowhere leads to the source's formula
    pages, unless its priority is negative."""
    s = snippets.filter(F.coalesce("source", F.lit("")) != "").select("case_id", "source", F.struct("place", F.coalesce("text", F.lit("")).alias("text")).alias("s"))
    s = s.groupBy("case_id", "source").agg(F.array_sort(F.collect_list("s")).alias("snippets"))
    d = documents.select("case_id", "source", "text").join(s, ["case_id", "source"])
    most = min(snippet_pages_at_most, max_pages)

    def read(pages):
        return F.transform(pages, lambda p: bound(simple(p["text"]), lambda x: F.struct(p["page"].alias("page"), tokens(x).alias("tokens"), x.alias("plain"))))

    def searched(pages):
        return F.transform("snippets", lambda x: F.struct(x["place"].alias("place"), rules.snippet_priority(x["text"]).alias("priority"), snippet_pages(x["text"], pages, most).alias("pages")))

    def jobs_of(pages):
        """The snippets with their pages; pages are scored for formulas once, and only where a snippet asks for it."""
        lost = lambda x: (F.size(x["pages"]) == 0) & (x["priority"] >= 0)

        def filled(found):
            return bound(formula_pages(pages, max_pages), lambda f: F.transform(found, lambda x: F.when(lost(x), x.withField("pages", f)).otherwise(x)))

        return bound(bound(read(pages), searched), lambda found: F.when(F.exists(found, lost), filled(found)).otherwise(found))

    jobs = d.select("case_id", "source", F.inline_outer(bound(text_pages(F.col("text")), jobs_of)))
    jobs = jobs.select("case_id", "source", pdf_of(F.col("source")).alias("pdf"), "place", "priority", F.explode_outer("pages").alias("page")).filter("page IS NOT NULL")
    first = F.min_by(F.struct("source", "priority"), F.struct(-F.col("priority"), "place")).alias("best")
    return jobs.groupBy("case_id", "pdf", "page").agg(first).select("case_id", "pdf", "page", "best.*")
