"""Passage removal against a dictionary of all 200-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from lodestack.llm import suffix_dedup as sd


def brute(rows, length=sd.LENGTH):
    seen = {}
    data = [(t or "").encode() for _, t in rows]
    for k, d in enumerate(data):
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for (doc, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefé") for _ in range(rng.randrange(2, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (30, 45, 60, 120)] + ["x" * 199, "y" * 200, "z" * 201, "ab" * 150]
    rows = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(1, 5))]
        if rng.random() < 0.5:
            p = rng.choice(passages)
            parts.insert(rng.randrange(len(parts) + 1), p[rng.randrange(3) :] if rng.random() < 0.5 else p)
        rows.append((i, rng.choice(["", " "]).join(parts)))
    rows += [(300, "u" * 4000), (301, " ".join(word() for _ in range(1500)) + passages[3] + "v" * 500 + passages[3]), (None, passages[3] * 9), (302, passages[2] + " ".join(word() for _ in range(900)))]
    rows += [(200, None), (201, ""), (202, rows[3][1]), (203, rows[5][1] + rows[6][1]), (204, "q" * 1000), (205, ("r" * 50 + "s") * 30), (205, "t" * 200), (None, rows[7][1])]
    return rows


def test_cover_is_a_difference_cover():
    assert {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER} == set(range(sd.PERIOD))


@pytest.mark.parametrize("chunk, bucket", [(1 << 20, 1_500_000), (3000, 20), (700, 5)])
def test_equals_brute_force(spark, monkeypatch, chunk, bucket):
    """Many buckets, borders of chunks, and documents that are cut into parts."""
    monkeypatch.setattr(sd, "CHUNK", chunk)
    monkeypatch.setattr(sd, "BUCKET", bucket)
    rows = made()
    if chunk < 1 << 20:
        assert any(len((t or "").encode()) > chunk + sd.LENGTH for _, t in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in sd.passages(docs).collect()), key=str)
    assert got == brute(rows)


def test_emitted_spans_and_empty_table(spark):
    rows = made()[:40] + [(900, made()[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in sd.passages(docs, emit=True).collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
        assert sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) == r.n_removed
    assert sd.passages(docs.limit(0)).collect() == []


def test_prints_do_not_depend_on_windows(monkeypatch):
    data = np.random.default_rng(1).integers(0, 4, 5000).astype(np.uint8)
    at = np.arange(0, 4700, 3)
    whole = sd.Polynomial(1).prints(data, at, sd.LENGTH)
    monkeypatch.setattr(sd, "WINDOW", 333)
    assert (sd.Polynomial(1).prints(data, at, sd.LENGTH) == whole).all()
    assert (sd.Polynomial(1).prints(data[30:], at[10:] - 30, sd.LENGTH) == whole[10:]).all()


def test_clashing_columns_stay_unread(spark):
    docs = spark.createDataFrame([(1, "k" * 500, 7, "p"), (2, "a b", 8, "q")], "doc_id long, text string, chunk_id int, path string")
    assert sorted(tuple(r)[:4] for r in sd.passages(docs).collect()) == [(1, 500, 500, 1), (2, 3, 0, 0)]


def test_packed_prints():
    rng = np.random.default_rng(2)
    for kind in ("u4", "u8"):
        for n in (1, 2, 700):
            prints = np.unique(rng.integers(0, np.iinfo(kind).max, n, dtype=kind, endpoint=True))
            assert (sd.unpacked(sd.packed(prints), kind) == prints).all()
