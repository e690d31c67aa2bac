"""Patent publications in running text: an ordered search cascade, the first family that occurs anywhere gives the number."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound

# Countries, families in order (name, pattern), what a broad reference and a labelled one look like, numbers that are not trusted.
COUNTRIES = "WO|EP|US|JP|CN|GB|DE|KR|AU|ES|FR|CA"
FAMILIES = (
    ("wo_long", r"\bWO\s*(\d{4})\s*/?\s*(\d{4,7})([A-Z]\d?)?\b"),
    ("wo_short", r"\bWO\s*(\d{2})\s*/?\s*(\d{4,6})([A-Z]\d?)?\b"),
    ("ep", r"\bEP\s*((?:\d[\s,.-]?){7})([A-Z]\d?)?\b"),
    ("us_application", r"\bUS\s*(\d{4})[\s/.-]*(\d{6,7})([A-Z]\d?)?\b"),
    ("us_patent", r"\bUS\s*((?:\d[\s,.-]?){7,8})([A-Z]\d?)?\b"),
    ("jp_year", r"\bJP\s*(0[1-9]|1[0-1])\s*((?:\d[\s,.-]?){5,6})([A-Z]\d?)?\b"),
    ("jp_era", r"\bJP\s*([A-Z])\s*((?:\d[\s,.-]?){6,9})([A-Z]\d?)?\b"),
    ("country", rf"\b({COUNTRIES})\s*((?:\d[\s,.-]?){{7,10}})([A-Z]\d?)?\b"),
)
LABEL = r"^D[0-9]{1,2}\s+"
BROAD = rf"\b(?:{COUNTRIES})\s?[A-Z0-9][A-Z0-9/.,\-\s]{{3,60}}"
LABELLED_LINE = r"^(D[0-9]{1,2})\s*[:\-]?\s*(.*)$"
LABELLED = (
    rf"\b(D[0-9]{{1,2}})\s*(?:=|:|-)?\s*((?:(?:{COUNTRIES})[-\s]?[A-Z0-9][A-Z0-9/.\-\s]{{3,90}})"
    r"|(?:Chong|Chou|Isaki)[A-Za-z0-9 .,'&:/()\-\[\]]{0,180}|Patent Abstracts[A-Za-z0-9 .,'&:/()\-\[\]]{0,180})"
)
UNTRUSTED = ("JPH03224054", "JPH03224054A")
#: US numbers of eight digits above this one, without a kind, are application numbers.
LAST_US_PATENT = 13_000_000
#: Lines below a bare label in which its reference may stand, and the length from which the label's own line holds it.
TAIL_LINES, LEAST_REST = 3, 5


def spelt(pattern: str, ascii: bool, flags: str = "") -> str:
    """The pattern for Java: over Unicode's words, digits and spaces, or over those of ASCII, where any other letter ends a word."""
    if not ascii:
        return f"(?{flags}U)" + pattern
    return f"(?s{flags + 'u' * ('i' in flags)})" + pattern.replace("\\b", r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))").replace("\\s", r"[\t\n\f\r ]")


def _spaced(x: Column, ascii: bool) -> Column:
    return F.btrim(F.regexp_replace(x, spelt("\\s+", ascii), " "))


def find(text: Column, ascii: bool = False) -> Column:
    """The publication number of the first family that occurs in a text, '' for none. A leading label (D1) doesn't count."""
    t = _spaced(F.coalesce(text, F.lit("")), ascii)
    # No letter outside ASCII becomes one of ASCII (as ss), which would end words elsewhere.
    t = F.translate(t, ascii_lowercase, ascii_uppercase) if ascii else F.upper(t)
    return bound(F.regexp_replace(t, LABEL, ""), lambda x: _cascade(x, ascii))


def _cascade(t: Column, ascii: bool) -> Column:
    pattern = {name: spelt(p, ascii) for name, p in FAMILIES}
    part = lambda name, k: F.regexp_extract(t, pattern[name], k)
    digits = lambda name, k: F.regexp_replace(part(name, k), spelt("\\D+", ascii), "")
    patent = digits("us_patent", 1)
    application = (part("us_patent", 2) == "") & (F.length(patent) == 8) & (patent.try_cast("int") > LAST_US_PATENT)
    made = {
        "wo_long": F.concat(F.lit("WO"), *[part("wo_long", k) for k in (1, 2, 3)]),
        "wo_short": F.concat(F.lit("WO"), *[part("wo_short", k) for k in (1, 2, 3)]),
        "ep": F.concat(F.lit("EP"), digits("ep", 1), part("ep", 2)),
        "us_application": F.concat(F.lit("US"), part("us_application", 1), F.lpad(part("us_application", 2), 7, "0"), F.coalesce(F.nullif(part("us_application", 3), F.lit("")), F.lit("A1"))),
        "us_patent": F.when(application, "").otherwise(F.concat(F.lit("US"), patent, part("us_patent", 2))),
        "jp_year": F.concat(F.lit("JPH"), part("jp_year", 1), F.coalesce(F.nullif(F.ltrim(digits("jp_year", 2), F.lit("0")), F.lit("")), F.lit("0")), part("jp_year", 3)),
        "jp_era": F.concat(F.lit("JP"), part("jp_era", 1), digits("jp_era", 2), part("jp_era", 3)),
        "country": F.concat(part("country", 1), digits("country", 2), part("country", 3)),
    }
    out = F.lit("")
    for name, _ in reversed(FAMILIES):
        out = F.when(t.rlike(pattern[name]), made[name]).otherwise(out)
    return out


def all_in(text: Column, ascii: bool = False) -> Column:
    """Distinct publications of a text in order of their first occurrence."""
    found = F.transform(F.regexp_extract_all(text, F.lit(spelt(BROAD, ascii, "i")), F.lit(0)), lambda x: find(x, ascii))
    return F.array_distinct(F.filter(found, lambda p: p != ""))


def labelled_lines(text: Column, ascii: bool = False) -> Column:
    """Citations (D1 and its publication) of lines that begin with a label; a bare label takes the lines below it."""
    lines = F.transform(F.split(text, "\\r?\\n"), lambda x: _spaced(x, ascii))
    label = spelt(LABELLED_LINE, ascii, "i")

    def one(line, i):
        below = F.slice(lines, i + 2, TAIL_LINES)
        stop = F.array_position(F.transform(below, lambda x: x.rlike(spelt("^D[0-9]{1,2}", ascii, "i"))), True)
        tail = F.array_join(F.filter(F.slice(below, 1, F.when(stop > 0, stop - 1).otherwise(TAIL_LINES).cast("int")), lambda x: x != ""), " ")
        rest = F.trim(F.regexp_extract(line, label, 2))
        return F.when(line.rlike(label), cited(F.regexp_extract(line, label, 1), F.when((F.length(rest) < LEAST_REST) & (i + 1 < F.size(lines)), tail).otherwise(rest), ascii))

    return F.filter(F.transform(lines, one), lambda x: x.isNotNull())


def labelled(text: Column, ascii: bool = False) -> Column:
    """Citations of labels that a reference follows anywhere in the text."""
    pattern = F.lit(spelt(LABELLED, ascii, "i"))
    both = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(1)).alias("label"), F.regexp_extract_all(text, pattern, F.lit(2)).alias("rest"))
    return F.filter(F.transform(both, lambda x: cited(x["label"], x["rest"], ascii)), lambda x: x.isNotNull())


def cited(label: Column, rest: Column, ascii: bool = False) -> Column:
    """Label and publication, null without one."""
    return bound(find(rest, ascii), lambda p: F.when(p != "", F.concat(F.upper(label), F.lit(" "), p)))
