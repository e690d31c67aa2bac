"""Column functions: cleansing, keys, identifiers, dates, predicates. JVM-side expressions, but for rare character references."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Markers of page-delimited text.
PAGE_MARK = "(?i)---\\s*PAGE\\s+[0-9]+\\s*---"
SOURCE_LINE = "(?im)^[ \\t]*SOURCE:.*$"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))


def bound(value: Column, body) -> Column:
    """body(value) with value computed once. A lambda that named the expression itself would compute it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@F.pandas_udf(StringType())
def _unescape_all(x: pd.Series) -> pd.Series:
    return x.map(html.unescape, na_action="ignore")


def unescape_common(x: Column) -> Column:
    """The references of ENTITIES as they are spelled there, the ampersand last, so that nothing is decoded twice; all others stay."""
    for ref, char in ENTITIES:
        x = F.replace(x, F.lit(ref), F.lit(char))
    return x


def unescape(x: Column) -> Column:
    """All named and numeric character references, also those without a semicolon, each decoded once. Texts with common ones only stay in the
    JVM; only the others are sent to Python."""
    names = "|".join(ref[1:] for ref, _ in ENTITIES)
    rare = x.rlike(f"&(?!{names})[#A-Za-z]")
    return F.when(rare, _unescape_all(F.when(rare, x))).otherwise(unescape_common(x))


def norm_space(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, "(?U)\\s+", " "))


def strip_tags(x: Column) -> Column:
    x = F.regexp_replace(x, "(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return F.regexp_replace(x, "(?s)<[^>]+>", " ")


def clean_text(x: Column, decode: Callable[[Column], Column] = unescape) -> Column:
    """Decode first, then drop scripts and tags, then collapse white space."""
    return norm_space(strip_tags(decode(x)))


def clean_cell(x: Column, decode: Callable[[Column], Column] = unescape) -> Column:
    """Tags first, then decode: an escaped tag survives as text."""
    return norm_space(decode(strip_tags(x)))


def meaningful_text(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, PAGE_MARK, " "), SOURCE_LINE, " ")


def meaningful_chars(x: Column) -> Column:
    return F.length(F.regexp_replace(meaningful_text(x), "[^A-Za-z0-9\\x{4e00}-\\x{9fff}]", ""))


def has_meaningful_text(x: Column, least: int = 80) -> Column:
    return meaningful_chars(x) >= least


def match_text(x: Column) -> Column:
    """Lower case, everything but ASCII letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(meaningful_text(x)), "[^a-z0-9]+", " "))


def compact_text(x: Column) -> Column:
    return F.replace(match_text(x), F.lit(" "), F.lit(""))


def text_key(x: Column) -> Column:
    return F.lower(norm_space(F.coalesce(x, F.lit(""))))


def safe_name(x: Column, most: int = 120) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(x, '[\\\\/:*?"<>|]', "_"), "\\s+", "_"), 1, most)


def iso_date(x: Column) -> Column:
    """dd.mm.yyyy as yyyy-mm-dd; anything else unchanged."""
    t = F.trim(x)
    return F.when(t.rlike("^\\d{2}\\.\\d{2}\\.\\d{4}$"), F.regexp_replace(t, "(\\d{2})\\.(\\d{2})\\.(\\d{4})", "$3-$2-$1")).otherwise(x)


def date_rank(name: Column) -> Column:
    """yyyymmdd from a leading dd-mm-yyyy or yyyy-mm-dd, 0 without one; a leading ../ is ignored."""
    n = F.regexp_replace(name, "^\\.\\./", "")
    day_first = F.concat(*[F.regexp_extract(n, "^(\\d{2})-(\\d{2})-(\\d{4})", k) for k in (3, 2, 1)])
    year_first = F.concat(*[F.regexp_extract(n, "^(\\d{4})-(\\d{2})-(\\d{2})", k) for k in (1, 2, 3)])
    return F.coalesce(F.nullif(day_first, F.lit("")), F.nullif(year_first, F.lit("")), F.lit("0")).cast("int")


def application_id(x: Column) -> Column:
    """Upper case, cut at the first dot, EP in front if missing; empty stays empty."""
    t = F.split_part(F.upper(F.trim(F.coalesce(x, F.lit("")))), F.lit("."), F.lit(1))
    return F.when(t == "", "").when(t.startswith("EP"), t).otherwise(F.concat(F.lit("EP"), t))


def strip_kind(x: Column) -> Column:
    return F.regexp_replace(F.upper(x), "[A-Z]\\d?$", "")


def publication_id(x: Column) -> Column:
    """Normalised publication number by an ordered cascade, '' where none fits."""
    t = F.upper(F.regexp_replace(x, "[^A-Za-z0-9]", ""))
    part = lambda p, k: F.regexp_extract(t, p, k)
    wo4, wo2 = "^WO((?:19|20)\\d{2})(\\d{5,6})([A-Z]\\d?)?$", "^WO(\\d{2})(\\d{5,6})([A-Z]\\d?)?$"
    ep, us_app, us = "^EP0*(\\d{6,7})([A-Z]\\d?)?$", "^US((?:19|20)\\d{2})(\\d{1,7})([A-Z]\\d?)?$", "^US(\\d{7,8})([A-Z]\\d?)?$"
    return (
        F.when(t.rlike(wo4), F.concat(F.lit("WO"), part(wo4, 1), F.lpad(part(wo4, 2), 6, "0"), part(wo4, 3)))
        .when(t.rlike(wo2), F.concat(F.lit("WO"), part(wo2, 1), F.lpad(part(wo2, 2), 6, "0"), part(wo2, 3)))
        .when(t.rlike(ep), F.concat(F.lit("EP"), F.lpad(part(ep, 1), 7, "0"), part(ep, 2)))
        .when(t.rlike(us_app), F.concat(F.lit("US"), part(us_app, 1), F.lpad(part(us_app, 2), 7, "0"), F.coalesce(F.nullif(part(us_app, 3), F.lit("")), F.lit("A1"))))
        .when(t.rlike(us) & ~((F.length(part(us, 1)) == 8) & (part(us, 1).try_cast("int") > 13000000) & (part(us, 2) == "")), F.concat(F.lit("US"), part(us, 1), part(us, 2)))
        .otherwise("")
    )


def wipo_id(x: Column) -> Column:
    """WO with a two-digit year to four digits, the century split at 50; the serial number filled to six digits."""
    p = "^WO(\\d{2})(\\d{5,6})$"
    year = F.regexp_extract(x, p, 1)
    return F.when(x.rlike(p), F.concat(F.lit("WO"), F.when(year.try_cast("int") < 50, "20").otherwise("19"), year, F.lpad(F.regexp_extract(x, p, 2), 6, "0"))).otherwise(x)


def search_link(x: Column) -> Column:
    base = F.when(x.startswith("WO"), "https://patentscope.wipo.int/search/en/result.jsf?query=").otherwise("https://worldwide.espacenet.com/patent/search?q=")
    return F.concat(base, F.url_encode(x))


def between(x: Column, start: str, ends: list[str], most: int) -> Column:
    """Text after the marker up to the nearest of several end markers, at most ``most`` characters."""
    at = F.locate(start, x)
    rest = F.substr(x, at + F.lit(len(start)))
    cuts = [F.nullif(F.locate(e, rest), F.lit(0)) for e in ends]
    end = F.least(*cuts, F.lit(most + 1)) if cuts else F.lit(most + 1)
    return F.when(at == 0, "").otherwise(F.trim(F.substr(rest, F.lit(1), end - 1)))


def rewrite_root_links(x: Column, base: str) -> Column:
    """href, src and action that start with one slash get the base in front; // is left alone."""
    return F.regexp_replace(x, '(href|src|action)="(/(?!/)[^"]*)"', f'$1="{base}$2"')


def score_class(x: Column) -> Column:
    return F.when(x.isNull(), "neutral").when(x >= 85, "good").when(x >= 60, "warn").otherwise("risk")


def percent(value: Column, total: Column) -> Column:
    return F.coalesce(F.bround(value * 100.0 / F.nullif(total, F.lit(0)), 1), F.lit(0.0))


def contains_cjk(x: Column) -> Column:
    return x.rlike("[\\x{4e00}-\\x{9fff}]")


def truncated(x: Column, most: int) -> Column:
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most), F.lit("[TRUNCATED]"))).otherwise(x)
