"""Claims of page-delimited texts against a plain fold over lines."""

import random
import re

import pytest
from lodestack.operators import claims as K

PAGE = re.compile(r"---\s*PAGE\s+([0-9]+)\s*---", re.I)
START = re.compile(r"([0-9]{1,3})\s*[.)]\s*(.*)")
HEADING = re.compile(r"(amended\s+)?claims?(\s*\([^)]+\))?", re.I)
AFTER = re.compile("abstract|drawings?|description|references?", re.I)
NOISE = re.compile(r"[0-9]{1,3}|[0-9]{1,3}\s*(->|→|-|/)\s*[0-9]{1,3}|[Ee][Pp]\s*[0-9][0-9\s.]{6,}|claimset|claim", re.I)


def size(text):
    return len(re.findall("[A-Za-z0-9一-鿿]", PAGE.sub(" ", text)))


def number(line):
    m = START.fullmatch(line)
    return int(m[1]) if m and int(m[1]) else None


def plain(text):
    """{number: (text, pages, note)} by one pass that opens and closes claims."""
    raw = (text or "").splitlines()
    lines = [" ".join(x.split()) for x in raw]
    start = next((i for i, x in enumerate(lines) if HEADING.fullmatch(x) and 1 in map(number, lines[i + 1 : i + 40])), 0)
    start = start or next((i for i, x in enumerate(lines) if number(x) == 1), 0)
    start = max((i for i in range(min(start + 1, len(raw))) if PAGE.search(raw[i])), default=start)
    page, state, before, pages, closed, any_claim = 1, None, [], set(), [], False
    first = None
    for k in range(start, len(raw)):
        n = number(lines[k])
        if any_claim and n is None and AFTER.fullmatch(lines[k]):
            break
        any_claim = any_claim or n is not None
        if m := PAGE.search(raw[k]):
            page = int(m[1])
        elif not lines[k] or HEADING.fullmatch(lines[k]) or NOISE.fullmatch(lines[k]):
            pass
        elif n is not None:
            first = first or n
            state = [n, [START.fullmatch(lines[k])[2].strip()], {page}]
            closed.append(state)
        elif state is None:
            before.append(lines[k])
            pages.add(page)
        else:
            state[1].append(lines[k])
            state[2].add(page)
    found = [(n, "\n".join(x for x in own if x), sorted(ps), "") for n, own, ps in closed]
    found = [c for c in found if size(c[1]) >= 20]
    body = "\n".join(before)
    if size(body) >= 80 and ((first or 0) > 1 or not found):
        found.insert(0, (1, body, sorted(pages) or [1], K.BEFORE_NOTE if (first or 0) > 1 else K.UNNUMBERED_NOTE))
    best = {}
    for c in found:
        if c[0] not in best or size(c[1]) > size(best[c[0]][1]):
            best[c[0]] = c
    if best and max(best) <= 200:
        for n in range(1, max(best)):
            best.setdefault(n, (n, "", [], K.PLACEHOLDER_NOTE))
    return [best[n] for n in sorted(best)]


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    got = {r.id: [(c.claim_number, c.text, c.source_pages, c.notes) for c in r.claims] for r in K.split(df).collect()}
    assert set(got) == set(range(len(texts)))
    for k, text in enumerate(texts):
        assert got[k] == plain(text), text


LONG = "a compound of the formula wherein all groups are as described above and below"
FIXTURES = [
    None, "", "\n \n", "Claims", f"1. {LONG}",
    f"Some letter\nClaims\nfoo\n1. {LONG}\n2. short\n4) {LONG}\nclaim\n5 . {LONG} more\n4. {LONG} longer one\nReferences\n9. {LONG}",
    f"--- PAGE 1 ---\nletter\n--- page 2 ---\nx\nAmended claims (new)\n1. {LONG[:40]}\n17\n--- PAGE 3 ---\n{LONG}\n3/9\n2. {LONG}\n--- PAGE 9 ---",
    f"CLAIMS\n1. {LONG}\nclaims\n1. {LONG} again",
    f"{LONG}\n{LONG}\n2. The use of {LONG}\nDescription\n3. {LONG}",
    f"{LONG} {LONG}", f"1. x\n{LONG}\n2.\n3. y", f"Abstract\n{LONG}{LONG}\n1. tiny\nDrawing\n2. {LONG}", f"0. {LONG}\n1000. {LONG}\n999. {LONG}", f"201. {LONG}", f"200. {LONG}", "权利要求" * 30, f"1. {LONG}\r\n2. {LONG}\r3. {LONG} 4. {LONG}",
]


def test_named_cases(spark):
    check(spark, FIXTURES)


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_lines(spark, seed):
    rng = random.Random(seed)
    parts = ["Claims", "amended CLAIMS (clean)", "--- PAGE {n} ---", "scan --- Page {n} --- x", "{n}. " + LONG, "{n}) tiny", "{n} . " + LONG[:30], LONG, "shorter line", "{n}", "1. " + LONG[:25], "Abstract", "Drawings", "EP 12 345 678.9", "3 -> 4", "", "claimset", "{n}.", "2. 3. nested " + LONG]
    check(spark, ["\n".join(rng.choice(parts).replace("{n}", str(rng.randint(0, 6))) for _ in range(rng.randint(1, 60))) for _ in range(150)])


def test_row_per_claim(spark):
    rows = K.numbered(spark.createDataFrame([(1, f"1. {LONG}\n3. {LONG}"), (2, "no claims")], "id int, text string"), ["id"]).collect()
    assert sorted((r.id, r.claim_number, r.notes) for r in rows) == [(1, 1, ""), (1, 2, K.PLACEHOLDER_NOTE), (1, 3, "")]


def test_other_columns_and_a_long_text(spark):
    text = "\n".join(f"--- PAGE {k} ---\n{k % 150 + 1}. {LONG} {k}\n{LONG}" for k in range(20_000))
    df = spark.createDataFrame([(1, text, "mine", [1])], "id int, text string, claims string, lines array<int>")
    row = K.split(df.drop("claims")).first()
    assert row["lines"] == [1] and len(row.claims) == 150 and row.claims[0].text.startswith("a compound")
