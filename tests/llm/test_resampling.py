"""Importance resampling against a plain reading of the rule, trie pieces and the cases of its docstring."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lodestack.llm import resampling
from lodestack.llm.queries import op11_trie_resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for doc, text in docs:
        n, found = features(text)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    eligible = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(eligible[: 5 * len(eligible) // 100])}
    return sorted(map(str, [(*r[:4], rank.get(id(r))) for r in out]))


def test_query_is_the_plain_rule(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = op11_trie_resampling(spark, sf_dir)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(docs, target)


@pytest.mark.parametrize("piece", [7, 64, 1000, 1 << 22])
def test_cases_in_pieces_of_any_size(spark, monkeypatch, piece):
    """Texts that are cut anywhere, words longer than a piece, ties, repeated rows and ids, nulls, clashing columns."""
    monkeypatch.setattr(resampling, "PIECE", piece)
    long = " ".join(f"w{i * i % 97}" for i in range(700))
    rows = [(i, f"{long[i : i + 90]} Übung ÄB {i % 5} ßz\x00kk -- A_B {long[:80]}") for i in range(60)]
    rows += [(100, long), (100, long), (101, None), (102, ""), (103, " .,-\n"), (104, "x" * 300 + " y " + "z" * 200), (None, long[:100]), (None, long[:100]), (105, "one"), (106, "one two"), (107, "日本 語 é")]
    docs = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], "doc_id long, text string, row int, rank int, weight string").repartition(3)
    target = spark.createDataFrame([(long[40:300],), (None,), ("one two",)], "text string")
    got = resampling.resample(docs, target).drop("n_words")
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows, [r.text for r in target.collect()])
    assert resampling.resample(docs.limit(0), target).count() == 0
    none = resampling.resample(docs, target.limit(0)).drop("n_words")
    assert sorted(str(tuple(r)) for r in none.collect()) == plain(rows, [])


def test_drawn_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(resampling, "RANGE", 40)
    rows = [(i, " ".join(f"{'ab' if i % 9 else 'target'}{(i * k) % 11}" for k in range(25))) for i in range(900)]
    target = [" ".join(f"target{k % 11}" for k in range(200))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = resampling.resample(docs, spark.createDataFrame([(x,) for x in target], "text string")).drop("n_words").collect()
    assert sorted(str(tuple(r)) for r in got) == plain(rows, target)
    best = [r.doc_id for r in got if r["rank"]]
    assert len(best) == 45 and all(i % 9 == 0 for i in best)


def test_crc_states_follow_from_parents():
    shift, rng = resampling.CrcShift(), np.random.default_rng(5)
    a, b = ([rng.bytes(int(n)) for n in rng.integers(0, 400, 300)] for _ in range(2))
    flat, base = shift.tables(np.array([len(x) for x in b]))
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    assert resampling.appended(crc(a), flat, base, crc(b)).tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]
