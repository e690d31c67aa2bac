r"""Claims of a patent text: where the claims section lies, and its division into numbered claims with their pages.

Everything happens inside a row, on arrays of lines: a document is one row before and after, so nothing is shuffled and memory is bounded by the longest
document. Runs of lines (pages, claims) are cut by the positions where they begin; each step is linear in the lines.

Cases: a null or empty text has no claims; a text without numbered lines gives claim 1 if it is long enough, with a note; numbers that occur twice
keep the longer text, the first of equal ones; missing numbers get placeholders up to ``MOST_PLACEHOLDERS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound

# Patterns of lines.
PAGE = r"(?i)---\s*PAGE\s+([0-9]+)\s*---"
CLAIM_START = r"^\s*([0-9]{1,3})\s*[.)]\s*(.*)$"
CLAIMS_HEADING = r"(?i)^\s*(?:amended\s+)?claims?(?:\s*\([^)]+\))?\s*$"
SECTION_AFTER = r"(?i)^\s*(?:abstract|drawings?|description|references?)\s*$"
NOISE = (r"^[0-9]{1,3}$", r"^[0-9]{1,3}\s*(?:->|→|-|/)\s*[0-9]{1,3}$", r"(?i)^EP\s*[0-9][0-9\s.]{6,}$")
NOISE_WORDS = ("claim", "claimset")
# Notes of drafted claims.
BEFORE_NOTE = "Draft claim 1 inferred from text before the first numbered dependent claim."
UNNUMBERED_NOTE = "Draft claim 1 inferred from OCR text without numbered claim boundaries."
PLACEHOLDER_NOTE = "Draft placeholder: OCR did not expose a clear boundary for this claim number. Fill from the authority PDF during review."
#: Lines after a heading in which claim 1 must begin, least letters of a claim and of an inferred one, highest number that gets placeholders.
HEADING_REACH, LEAST_CLAIM, LEAST_INFERRED, MOST_PLACEHOLDERS = 39, 20, 80, 200

#: Line ends, and white space beyond ASCII.
_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
_SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def cleaned(line: Column) -> Column:
    """Runs of any white space as one space, none at the ends."""
    return F.btrim(F.regexp_replace(line, _SPACE, " "))


def is_noise(line: Column) -> Column:
    """Cleaned lines that belong to no claim: empty ones, page and line numbers, headings, running heads."""
    out = (line == "") | line.rlike(CLAIMS_HEADING) | F.lower(line).isin(*NOISE_WORDS)
    for pattern in NOISE:
        out = out | line.rlike(pattern)
    return out


def letters(text: Column) -> Column:
    """Letters, digits and CJK signs of a text without its page marks."""
    return F.length(F.regexp_replace(F.regexp_replace(text, PAGE, " "), "[^A-Za-z0-9\\x{4e00}-\\x{9fff}]", ""))


def _number(line: Column) -> Column:
    n = F.regexp_extract(line, CLAIM_START, 1).try_cast("int")
    return F.when(n >= 1, n)


def parsed_lines(text: Column) -> Column:
    """array<struct<raw, line, number, page, mark>> of a text's lines."""

    def one(raw):
        line = cleaned(raw)
        page = F.regexp_extract(raw, PAGE, 1)
        return F.struct(raw.alias("raw"), line.alias("line"), _number(line).alias("number"), page.try_cast("long").alias("page"), (page != "").alias("mark"))

    return F.transform(F.split(text, _BREAK), one)


def _positions(rows: Column, keep) -> Column:
    """Zero-based positions of the rows that keep() accepts."""
    return F.filter(F.transform(rows, lambda r, i: F.when(keep(r), i)), lambda i: i.isNotNull())


def _from(rows: Column, start: Column, end: Column | None = None) -> Column:
    """rows[start:end], zero-based."""
    return F.slice(rows, start + 1, F.greatest(F.lit(0), (F.size(rows) if end is None else end) - start))


def section_bounds(df: DataFrame) -> DataFrame:
    """Adds start and end (zero-based, end excluded) of the claims section of lines.

    It begins at the heading that claim 1 follows, else at claim 1, from the page mark above it; it ends at the next section's heading after a claim."""
    lines = F.col("lines")
    df = df.withColumns({"firsts": _positions(lines, lambda r: r["number"] == 1), "headings": _positions(lines, lambda r: r["line"].rlike(CLAIMS_HEADING)), "marks": _positions(lines, lambda r: r["mark"])})
    followed = F.filter("headings", lambda h: F.exists(F.slice(lines, h + 2, HEADING_REACH), lambda r: r["number"] == 1))
    heading = F.coalesce(F.get(followed, F.lit(0)), F.lit(0))
    found = bound(heading, lambda h: F.when(h > 0, h).otherwise(F.coalesce(F.get("firsts", F.lit(0)), F.lit(0))))
    df = df.withColumn("start", bound(found, lambda f: F.coalesce(F.array_max(F.filter("marks", lambda i: i <= f)), f)))
    claims = _positions(lines, lambda r: r["number"].isNotNull())
    claim = bound(F.col("start"), lambda s: F.get(F.filter(claims, lambda i: i >= s), F.lit(0)))
    after = _positions(lines, lambda r: r["line"].rlike(SECTION_AFTER))
    return df.withColumn("end", bound(claim, lambda c: F.coalesce(F.get(F.filter(after, lambda i: i > c), F.lit(0)), F.size(lines))))


def section(df: DataFrame, text_col: str) -> DataFrame:
    """Adds section: the text's claims section, the whole text where none is found. The columns lines, start and end are added too."""
    df = df.withColumn("lines", parsed_lines(F.coalesce(F.col(text_col), F.lit(""))))
    df = section_bounds(df).drop("firsts", "headings", "marks")
    return df.withColumn("section", F.array_join(F.transform(_from(F.col("lines"), F.col("start"), F.col("end")), lambda r: r["raw"]), "\n"))


def _paged(rows: Column) -> Column:
    """Lines of the section with the page that each lies on, without marks and noise."""
    starts = F.concat(F.array(F.lit(0)), _positions(rows, lambda r: r["mark"]))

    def page(s):
        def one(start, k):
            number = F.when(k == 0, F.lit(1).cast("long")).otherwise(F.get(rows, start)["page"])
            own = _from(rows, start, F.coalesce(F.get(s, k + 1), F.size(rows)))
            return bound(number, lambda n: F.transform(own, lambda r: F.struct(r["line"].alias("line"), r["number"].alias("number"), n.alias("page"), r["mark"].alias("mark"))))

        return F.flatten(F.transform(s, one))

    return F.filter(bound(starts, page), lambda r: ~r["mark"] & ~is_noise(r["line"]))


def _claim(number, text, pages, notes=""):
    return F.struct(number.cast("int").alias("claim_number"), text.alias("text"), pages.alias("source_pages"), F.lit("draft").alias("status"), F.lit(notes).alias("notes"))


def _pages(rows: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(rows, lambda r: r["page"])))


def _body(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def split(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds claims: array<struct<claim_number, text, source_pages, status, notes>> in order of number."""
    own = df.columns
    rows = section(df.select(F.struct(*own).alias("own"), F.col(text_col).alias("text")), "text").select("own", _from(F.col("lines"), F.col("start"), F.col("end")).alias("lines"))
    rows = rows.select("own", _paged(F.col("lines")).alias("kept"))
    kept = F.col("kept")
    rows = rows.withColumn("starts", _positions(kept, lambda r: r["number"].isNotNull()))
    starts = F.col("starts")

    def numbered(start, k):
        inside = _from(kept, start, F.coalesce(F.get(starts, k + 1), F.size(kept)))
        rest = cleaned(F.regexp_extract(F.get(kept, start)["line"], CLAIM_START, 2))
        body = _body(F.concat(F.array(rest), F.transform(_from(inside, F.lit(1)), lambda r: r["line"])))
        return _claim(F.get(kept, start)["number"], body, _pages(inside))

    before = _from(kept, F.lit(0), F.coalesce(F.get(starts, F.lit(0)), F.size(kept)))
    rows = rows.withColumns({"found": F.transform(starts, numbered), "preamble": _body(F.transform(before, lambda r: r["line"])), "pages": _pages(before), "first": F.get(kept, F.get(starts, F.lit(0)))["number"]})
    rows = rows.withColumn("found", F.filter("found", lambda c: letters(c["text"]) >= LEAST_CLAIM))
    pages = F.when(F.size("pages") > 0, F.col("pages")).otherwise(F.array(F.lit(1).cast("long")))
    enough = letters(F.col("preamble")) >= LEAST_INFERRED
    inferred = (
        F.when(enough & (F.col("first") > 1), F.array(_claim(F.lit(1), F.col("preamble"), pages, BEFORE_NOTE)))
        .when(enough & (F.size("found") == 0), F.array(_claim(F.lit(1), F.col("preamble"), pages, UNNUMBERED_NOTE)))
        .otherwise(F.slice("found", 1, 0))
    )
    rows = rows.withColumn("found", F.concat(inferred, F.col("found")))
    # The best text of each number stands first among its number's.
    rows = rows.withColumn("ranked", F.array_sort(F.transform("found", lambda c, i: F.struct(c["claim_number"].alias("n"), (-letters(c["text"])).alias("size"), i.alias("i")))))
    best = F.filter(F.transform("ranked", lambda r, i: F.when((i == 0) | (F.get("ranked", i - 1)["n"] != r["n"]), F.get("found", r["i"]))), lambda c: c.isNotNull())
    rows = rows.withColumn("best", best)
    numbers = F.transform("best", lambda c: c["claim_number"])
    highest = F.array_max(numbers)
    none = F.slice(F.array(F.lit(0).cast("long")), 1, 0)
    missing = F.when(highest <= MOST_PLACEHOLDERS, F.array_except(F.sequence(F.lit(1), highest), numbers))
    empty = F.transform(F.coalesce(missing, F.slice(F.array(F.lit(0)), 1, 0)), lambda n: _claim(n, F.lit(""), none, PLACEHOLDER_NOTE))
    return rows.select("own.*", F.array_sort(F.concat(F.col("best"), empty)).alias("claims"))


def numbered(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Row per claim: keys, claim_number, text, source_pages, status, notes; texts without claims give none.

    The outer form keeps the optimizer from filtering texts by their claims first, which would divide each text twice."""
    rows = split(df.select(*keys, F.col(text_col).alias("text")), "text").select(*keys, F.inline_outer("claims"))
    return rows.filter(F.col("claim_number").isNotNull())
