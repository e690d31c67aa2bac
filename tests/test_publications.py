"""Publications in running text against a plain reading of the cascade; choice of prior art."""

import random
import re
from collections import Counter

import pytest
from lodestack.functions import publications as P
from lodestack.functions import rules
from lodestack.operators import cases as C
from pyspark.sql import functions as F


def find(text):
    t = re.sub(r"^D[0-9]{1,2}\s+", "", " ".join((text or "").split()).upper())
    for name, pattern in P.FAMILIES:
        if m := re.search(pattern, t):
            g = [x or "" for x in m.groups()]
            bare = [re.sub(r"\D+", "", x) for x in g]
            if name.startswith("wo"):
                return "WO" + "".join(g)
            if name == "ep":
                return f"EP{bare[0]}{g[1]}"
            if name == "us_application":
                return f"US{g[0]}{g[1].zfill(7)}{g[2] or 'A1'}"
            if name == "us_patent":
                return "" if not g[1] and len(bare[0]) == 8 and int(bare[0]) > 13_000_000 else f"US{bare[0]}{g[1]}"
            if name == "jp_year":
                return f"JPH{g[0]}{bare[1].lstrip('0') or '0'}{g[2]}"
            return f"{'JP' if name == 'jp_era' else ''}{g[0]}{bare[1]}{g[2]}"
    return ""


def values(spark, column, rows):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x string").select(column(F.col("x"))).collect()]


NAMED = {
    "D1 WO 2004/012345 A1": "WO2004012345", "WO 99/12345 wherein": "WO9912345", "WO2004/12345A1": "WO200412345A1", " ;EP 1492030 B1. ": "EP1492030", "see EP 1,492,030B1": "EP1492030B1", "US 2004/012345": "US20040012345A1",
    "US 6,123,456 A": "US6123456", "US 14,123,456": "", "US 12123456": "US12123456", "US 14123456B2": "US14123456B2", "JP 05 123456A": "JPH05123456A", "JP 03 024054": "JPH0324054", "JP H03-224054": "", "JP H3224054A": "JPH3224054A",
    "CN 1234567 A": "CN1234567", "DE 10 2004 0123A1": "DE1020040123A1", "GB2345678B": "GB2345678B", "NEWGB2345678": "", "XX 1234567": "", "": "", "D12": "", "D1 D2 CN 1234567": "CN1234567", "CN 1234567 then EP 1492030": "EP1492030",
}


def test_families(spark):
    got = dict(zip(NAMED, values(spark, P.find, list(NAMED))))
    assert got == {x: find(x) for x in NAMED}
    sure = ("WO 99/12345 wherein", "WO2004/12345A1", "US 2004/012345", "US 14,123,456", "JP 05 123456A", "JP H3224054A", "CN 1234567 then EP 1492030", "GB2345678B")
    assert {k: got[k] for k in sure} == {k: NAMED[k] for k in sure}
    assert values(spark, P.find, [None]) == [""]


@pytest.mark.parametrize("seed", range(3))
def test_any_text(spark, seed):
    rng = random.Random(seed)
    parts = ["WO", "EP", "US", "JP", "CN", "DE", "KR", "D1", "D12 ", "D2:", "=", "-", "/", ".", ",", " ", "  ", "\n", "A1", "B", "H", "05", "2004", "99", "12345", "0123456", "1 492 030", "14123456", "see", "Chou et al", "é", "(", "\t"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    assert values(spark, P.find, texts) == [find(t) for t in texts]
    every = [list(dict.fromkeys(p for m in re.finditer(P.BROAD, t, re.I) if (p := find(m[0])))) for t in texts]
    assert values(spark, P.all_in, texts) == every
    inside = [[f"{m[1].upper()} {p}" for m in re.finditer(P.LABELLED, t, re.I) if (p := find(m[2]))] for t in texts]
    assert values(spark, P.labelled, texts) == inside
    assert values(spark, P.labelled_lines, texts) == [lines_of(t) for t in texts]


def lines_of(text):
    lines, out = [" ".join(x.split()) for x in re.split(r"\r?\n", text)], []
    for k, line in enumerate(lines):
        if m := re.match(P.LABELLED_LINE, line, re.I):
            rest = m[2].strip()
            if len(rest) < P.LEAST_REST and k + 1 < len(lines):
                tail = []
                for x in lines[k + 1 : k + 1 + P.TAIL_LINES]:
                    if re.match(r"D[0-9]{1,2}", x, re.I):
                        break
                    tail += [x] if x else []
                rest = " ".join(tail)
            if p := find(rest):
                out.append(f"{m[1].upper()} {p}")
    return out


def test_bare_labels_take_the_lines_below(spark):
    text = "d1:\n\nEP 1492030 A1\nx\nD2\nD3: WO 2004/012345\nD4 -\n\n\n\nUS 6123456\nD5:"
    assert values(spark, P.labelled_lines, [text]) == [lines_of(text)] == [["D1 EP1492030A1", "D3 WO2004012345"]]


def test_prior_art_of_cases(spark):
    """Claims and descriptions don't count beside an examination step, but do where there is none; untrusted numbers and the own number don't."""
    cite = "D1: EP 1492030;\nsee EP 1492030; and WO 2004/012345 A1; JP 03 224054"
    docs = [("a", "EP20000001", "search_report.txt", cite, 0), ("a", "EP20000001", "claims.txt", "US 6123456", 1), ("b", "EP1492030", "claims.txt", cite, 0), ("c", "EP1", "claims.txt", "US 6123456 A", 0), ("c", "EP1", "annex.txt", None, 1), ("d", None, "description.txt", "DE 1020040123", 0)]
    df = spark.createDataFrame(docs, "case_id string, application string, source string, text string, place int")
    got = [(r.case_id, r["rank"], r.citation, r.mentions, r.sources) for r in C.prior_art(C.mentions(df), 5, df).orderBy("case_id", "rank").collect()]
    assert got == [("a", 1, "D1 EP1492030", 2, "search_report.txt"), ("a", 2, "WO2004012345", 1, "search_report.txt"), ("b", 1, "WO2004012345", 1, "claims.txt"), ("d", 1, "DE1020040123", 1, "description.txt")]
    count = Counter(r.citation for r in C.mentions(df).filter("case_id = 'a'").collect())
    assert count == {"D1 EP1492030": 2, "EP1492030": 1, "WO2004012345": 1, "JPH03224054": 1, "US6123456": 1}


def test_noise_of_headings(spark):
    assert values(spark, rules.is_noise_line, ["Amended claims", "CLAIMS (new)", "claims of", "1000", " 7 ", " "]) == [True, True, False, False, True, True]


def test_words_end_as_in_the_sql(spark, tmp_path):
    """Letters outside ASCII beside a country's: the query's words end there, as its SQL's do; the operators' don't."""
    import duckdb
    from __spark_entry__ import oracle_sql, queries

    turns = [(17107, 0, "user", "Mit der \xdf das, \xfcau eineschschzuzu aueinbe zu ensterer enzuungkeit einungpf."), (3, 1, "user", "stra\xdfep 1234567 A1 x\xa0EP 1 492 031 B1 İ"), (4, 0, "user", "keinſep 7654321\x0bD2: ßus 6123457")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    rows = queries()["prior_art_in_texts"](spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(rows.columns)} FROM ({oracle_sql()['prior_art_in_texts']})").fetchall()
    assert sorted(map(tuple, rows.collect())) == sorted(want)
    assert values(spark, P.all_in, ["\xfcau einesch\nCN 1234567 A"]) == [["CN1234567A"]]
