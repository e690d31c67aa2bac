"""Repair of quoted evidence: a passage that its case's sources don't bear out is replaced by the run of source lines most like it.

Passages meet only sources of their own case: equi-joins on the case, first without texts to settle which sources are looked at, then with them. Batches of
(passage, source) pairs are scored where they are; a pair's work is bounded by its source. Runs are compared by the same ratio as a
plain search over all of them; two cheap upper bounds of it skip runs that cannot win, which changes no result.

Cases: malformed analyses, and those without passages, stay as they are; null and empty sources are left out; equal scores go to the first source by
path, then to the first run; a passage without letters or digits is never replaced; extra columns pass through.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.text import match_text

# Marks inside texts, names of working files, paths that hold advice, scores of the tiers.
_MARK = re.compile(r"---\s*PAGE\s+[0-9]+\s*---", re.I)
_SOURCE = re.compile(r"^\s*SOURCE:.*$", re.I | re.M)
WORKING = "^_tmp|\\.prompt\\.txt$|dryrun\\.prompt"
ADVICE = ("top_risk_reasons", "recommended_actions")
WHOLE, COMPACT, ANCHORED = 1.0, 0.97, 0.92
#: A run this like its passage ends the search.
SURE = 0.98


def normal(text: str) -> str:
    """Lower case letters and digits, anything else as one space, without page marks and source lines."""
    return " ".join(re.sub("[^a-z0-9]+", " ", _SOURCE.sub(" ", _MARK.sub(" ", text)).lower()).split())


def lines_of(text: str) -> list[str]:
    lines = (x.strip() for x in text.splitlines())
    return [x for x in lines if x and not _MARK.fullmatch(x) and not x.upper().startswith("SOURCE:")]


def _ratio(query: str, text: str) -> float:
    from difflib import SequenceMatcher

    return SequenceMatcher(None, query, text).ratio()


def match_score(query: str, body: str) -> tuple[int, float]:
    """Tier (0 contains it, 1 both ends of it, 2 alike, 3 nothing) and score of a normalised passage in a normalised source."""
    if len(query) < 8:
        return 3, 0.0
    if query in body:
        return 0, WHOLE
    tight = query.replace(" ", "")
    if len(tight) >= 30 and tight in body.replace(" ", ""):
        return 0, COMPACT
    words = query.split()
    if len(words) >= 12 and " ".join(words[:12]) in body and " ".join(words[-12:]) in body:
        return 1, ANCHORED
    start = body.find(" ".join(words[:6]))
    score = _ratio(query, body[max(0, start - 300) : start + len(query) + 300]) if start >= 0 else 0.0
    return (2 if score else 3), score


def best_run(query: str, text: str, most: int) -> tuple[str, float]:
    """The first run of at most ``most`` lines that is nearly the normalised passage, else the best one; '' and 0 without any."""
    from difflib import SequenceMatcher

    lines = lines_of(text)
    normals = [normal(x) for x in lines]
    best, score = "", 0.0
    for start in range(len(lines)):
        for end in range(start + 1, min(len(lines), start + most) + 1):
            run = "\n".join(lines[start:end])
            # A page mark may be spread over lines.
            body = normal(run) if "---" in run else " ".join(x for x in normals[start:end] if x)
            if not body:
                continue
            if 2 * min(len(query), len(body)) <= score * (len(query) + len(body)):
                continue
            pair = SequenceMatcher(None, query, body)
            if pair.quick_ratio() <= score:
                continue
            found = pair.ratio()
            if found > score:
                best, score = run, found
            if found >= SURE:
                return best, score
    return best, score


@F.pandas_udf(ArrayType(StructType([StructField(c, StringType()) for c in ("path", "text", "source")])))
def passages(analysis: pd.Series) -> pd.Series:
    """Every record with a passage (original_text) in nested JSON: its path, the passage and the source that it names."""

    def walk(value, path, found):
        if path.startswith(ADVICE):
            return
        if isinstance(value, dict):
            if isinstance(value.get("original_text"), str):
                found.append({"path": path, "text": value["original_text"], "source": str(value.get("source") or value.get("location") or "")})
            for key, x in value.items():
                walk(x, f"{path}.{key}" if path else str(key), found)
        elif isinstance(value, list):
            for k, x in enumerate(value):
                walk(x, f"{path}[{k}]", found)

    def one(text):
        found: list = []
        try:
            walk(json.loads(text), "", found)
        except (TypeError, ValueError):
            pass
        return found

    return analysis.map(one)


@F.pandas_udf(StringType())
def written(analysis: pd.Series, changes: pd.Series) -> pd.Series:
    """The documents with new passages at their paths; a record without a source gets the new one's name."""

    def put(value, path, new):
        if isinstance(value, dict):
            if path in new and isinstance(value.get("original_text"), str):
                value["original_text"] = new[path]["excerpt"]
                if not value.get("source"):
                    value["source"] = new[path]["name"]
            for key, x in value.items():
                put(x, f"{path}.{key}" if path else str(key), new)
        elif isinstance(value, list):
            for k, x in enumerate(value):
                put(x, f"{path}[{k}]", new)

    def one(text, found):
        new = {x["path"]: x for x in (found if found is not None else [])}
        if not new:
            return text
        value = json.loads(text)
        put(value, "", new)
        return json.dumps(value, ensure_ascii=False)

    return pd.Series([one(t, c) for t, c in zip(analysis, changes)], dtype=object)


def _scored(pairs: DataFrame, names: list[str], schema: str, score) -> DataFrame:
    """pairs (names, passage, body) as rows (names and what score() gives)."""

    kinds = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    made = [x.split() for x in schema.split(", ")[len(names) :]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score(q, b) for q, b in zip(batch.column("passage").to_pylist(), batch.column("body").to_pylist())]
            columns = [pa.array([x[k] for x in found], kinds[kind]) for k, (_, kind) in enumerate(made)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *columns], names=[*names, *[n for n, _ in made]])

    return pairs.select(*names, "passage", "body").filter("passage IS NOT NULL AND body IS NOT NULL").mapInArrow(run, schema)


def verified(items: DataFrame, sources: DataFrame) -> DataFrame:
    """case_id, path, file, score: the source of the same case that bears an item out best. items: case_id, path, text; sources: case_id, file, text."""
    kind = dict(items.dtypes)["case_id"]
    q = items.select("case_id", "path", match_text(F.col("text")).alias("passage"))
    b = sources.select("case_id", "file", match_text(F.col("text")).alias("body")).filter("body <> ''")
    s = _scored(q.join(b, "case_id"), ["case_id", "path", "file"], f"case_id {kind}, path string, file string, tier int, score double", match_score)
    order = F.struct("tier", F.when(F.col("tier") == 2, -F.col("score")).otherwise(0.0), "file")
    best = s.filter("tier < 3").groupBy("case_id", "path").agg(F.min_by(F.struct("file", "score"), order).alias("best"))
    return q.select("case_id", "path").join(best, ["case_id", "path"], "left").select("case_id", "path", "best.file", F.coalesce("best.score", F.lit(0.0)).alias("score"))


def _stem(name):
    return F.regexp_replace(name, "(?<=.)\\.[^.]*$", "")


def repairs(items: DataFrame, sources: DataFrame, max_lines: int = 10) -> DataFrame:
    """case_id, path, file, excerpt, score: the best run of lines for each item, in the sources that it names, or in all of its case where it names none.
    items: case_id, path, text, source."""
    kind = dict(items.dtypes)["case_id"]
    base = lambda x: F.element_at(F.split(F.replace(x, F.lit("\\"), F.lit("/")), "/"), -1)
    q = items.select("case_id", "path", match_text(F.col("text")).alias("passage"), base(F.col("source")).alias("named")).filter("passage <> ''")
    f = sources.filter(match_text(F.col("text")) != "").select("case_id", "file")
    pairs = q.select("case_id", "path", "named").join(f, "case_id")
    pairs = pairs.withColumn("meant", (F.col("named") != "") & ((base(F.col("file")) == F.col("named")) | (_stem(base(F.col("file"))) == _stem(F.col("named")))))
    any_meant = pairs.groupBy("case_id", "path").agg(F.bool_or("meant").alias("any_meant"))
    pairs = pairs.join(any_meant, ["case_id", "path"]).filter(F.col("meant") | ~F.col("any_meant")).select("case_id", "path", "file")
    full = pairs.join(q.select("case_id", "path", "passage"), ["case_id", "path"]).join(sources.select("case_id", "file", F.col("text").alias("body")), ["case_id", "file"])
    s = _scored(full, ["case_id", "path", "file"], f"case_id {kind}, path string, file string, excerpt string, score double", lambda p, b: best_run(p, b, max_lines))
    sure = F.col("score") >= SURE
    order = F.struct(F.when(sure, 0).otherwise(1), F.when(sure, 0.0).otherwise(-F.col("score")), "file")
    return s.filter("score > 0").groupBy("case_id", "path").agg(F.min_by(F.struct("file", "excerpt", "score"), order).alias("best")).select("case_id", "path", "best.*")


def repair(documents: DataFrame, sources: DataFrame, min_verified: float = 0.88, min_repair: float = 0.55, max_lines: int = 10) -> DataFrame:
    """documents (case_id, analysis, ...) with weak passages replaced, and repaired: how many were.

    sources: case_id, file (path), text. Working files are left out."""
    name = F.element_at(F.split("file", "/"), -1)
    own = sources.filter(~name.rlike(WORKING) & F.col("text").isNotNull()).select("case_id", "file", "text")
    items = documents.select("case_id", F.explode(passages("analysis")).alias("x")).select("case_id", "x.*")
    weak = items.join(verified(items, own).filter(F.col("score") < min_verified).select("case_id", "path"), ["case_id", "path"])
    found = repairs(weak, own, max_lines).filter(F.col("score") >= min_repair)
    change = F.struct("path", "excerpt", F.element_at(F.split("file", "/"), -1).alias("name"))
    changes = found.groupBy("case_id").agg(F.array_sort(F.collect_list(change)).alias("changes"))
    d = documents.join(changes, "case_id", "left")
    columns = [written("analysis", "changes").alias("analysis") if c == "analysis" else F.col(c) for c in documents.columns]
    return d.select(*columns, F.coalesce(F.array_size("changes"), F.lit(0)).alias("repaired"))
