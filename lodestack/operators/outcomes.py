"""How a case ended, as its register rows, its documents and its register status tell; and the part of a register page that lists citations.

Evidence is judged where it is read: a row carries three flags and a rank, and one best row an outcome and case leaves a task (a partial aggregate),
so that a case with any number of documents never meets in one task and no text is shuffled.

Cases: null titles, dates, names and texts are empty; an empty title is no evidence, a document without name or text is weak evidence but one; equal ranks
go to register rows before documents, then to the earlier place, then by name; repeated rows change nothing; a case that is named
in any of the three inputs has a row; a null case is a case of its own; an empty input tells nothing. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import date_rank

# Outcomes in order of precedence with their label and the words that tell them in titles and texts, by any white space between.
TOLD = (
    ("granted", "yes", r"decision\s+to\s+grant|decision_to_grant|is\s+hereby\s+granted|mention\s+of\s+the\s+grant"),
    ("rejected", "no", r"decision\s+to\s+refus|decision_to_refus|application\s+refused|is\s+refused"),
    ("withdrawn", "no", r"deemed\s+to\s+be\s+withdrawn|application\s+withdrawn|withdrawn"),
)
# The same in a register status, asked where nothing else tells.
STATUS = (
    ("granted", "yes", "patent has been granted|no opposition filed"),
    ("rejected", "no", "application refused"),
    ("withdrawn", "no", "deemed to be withdrawn"),
    ("pending", "no", "grant of patent is intended|examination is in progress"),
)
# Where the citations of a register page begin and where they end at the latest.
CITED, CITED_CELL, CELL = "Documents cited:", r"(?iU)>\s*Cited in\s*<", "<td"
END_CELL, ENDS = r"(?iU)>\s*by applicant\s*<", ("The EPO accepts no responsibility", '<div id="epoFooter"', "</body>")
#: Characters of a document that the workload's own rule looks at.
LOOKED_AT = 5000


def _has(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?iU){pattern}")


def _evidence(rows: DataFrame, origin: int, source: Column, date: Column, text: Column, place: Column) -> DataFrame:
    """case_id, flags of the outcomes told, and (rank, order, source, date) of the evidence."""
    rank = F.when(date_rank(source) != 0, date_rank(source)).otherwise(date_rank(date))
    item = F.struct((-rank).alias("rank"), F.lit(origin).alias("origin"), place.alias("place"), source.alias("source"), date.alias("date"))
    return rows.select("case_id", *[_has(text, pattern).alias(outcome) for outcome, _, pattern in TOLD], item.alias("item"))


def known_outcomes(rows: DataFrame, documents: DataFrame, statuses: DataFrame, most: int | None = LOOKED_AT) -> DataFrame:
    """Row per case: case_id, outcome, grant_label, source, date (all null where nothing tells).

    rows: case_id, place, title, date of register rows. documents: case_id, place, name, text. statuses: case_id, register_status. Of the first
    outcome that any evidence tells, the evidence with the latest date stands for it: the one leading its source's name, else its own.
    most: characters of a document's text that are looked at, None for the whole text."""
    text_of = lambda name: F.coalesce(F.col(name), F.lit(""))
    titled = rows.filter(text_of("title") != "")
    seen = _evidence(titled, 0, text_of("title"), text_of("date"), text_of("title"), F.col("place"))
    text = text_of("text") if most is None else F.substring(text_of("text"), 1, most)
    seen = seen.unionByName(_evidence(documents, 1, text_of("name"), F.lit(""), F.concat(text_of("name"), F.lit(" "), text), F.col("place")))
    told = seen.groupBy("case_id").agg(*[F.min(F.when(F.col(outcome), F.col("item"))).alias(outcome) for outcome, _, _ in TOLD])

    status = statuses.select("case_id", text_of("register_status").alias("status"))
    said = [F.when(_has(F.col("status"), pattern), F.lit(k)) for k, (_, _, pattern) in enumerate(STATUS)]
    status = status.groupBy("case_id").agg(F.min(F.coalesce(*said)).alias("said"))
    both = told.unionByName(status, allowMissingColumns=True).groupBy("case_id").agg(*[F.min(c).alias(c) for c in (*[o for o, _, _ in TOLD], "said")])

    def result(outcome: str, label: str, source: Column, date: Column) -> Column:
        return F.struct(F.lit(outcome).alias("outcome"), F.lit(label).alias("grant_label"), source.alias("source"), date.alias("date"))

    found = [F.when(F.col(o).isNotNull(), result(o, label, F.col(o)["source"], F.col(o)["date"])) for o, label, _ in TOLD]
    found += [F.when(F.col("said") == k, result(o, label, F.lit("register_status"), F.lit(""))) for k, (o, label, _) in enumerate(STATUS)]
    return both.select("case_id", F.coalesce(*found).alias("found")).select("case_id", "found.*")


def _place(text: Column, pattern: str) -> Column:
    """Where a pattern first matches, from 1 and in characters (regexp_instr counts UTF-16 units), 0 without a match."""
    before = F.length(F.get(F.split(text, pattern, 2), F.lit(0)))
    return F.when(before < F.length(text), before + 1).otherwise(0)


def citations_block(html: Column) -> Column:
    """The part of a register page that lists citations, as it stands there: from the heading, or from the cell that says "Cited in", to the citations
    by the applicant or the page's end. Empty without either; a null page has none."""
    html = F.coalesce(html, F.lit(""))
    headed, cell = F.locate(CITED, html), _place(html, CITED_CELL)
    before = F.substring(html, F.lit(1), cell - 1)
    opened = F.length(F.regexp_extract(before, f"(?s)^(.*){CELL}", 1)) + 1
    start = F.when(headed > 0, headed).when(cell > 0, F.when(before.contains(CELL), opened).otherwise(cell))
    tail = F.substring(html, start, F.length(html))
    ends = [_place(tail, END_CELL), *[F.locate(e, tail) for e in ENDS]]
    end = F.least(*[F.when(e > 0, e) for e in ends], F.length(tail) + 1)
    return F.coalesce(F.substring(tail, F.lit(1), end - 1), F.lit(""))
