"""Exact dedup, mixing, sharding and WARC: the cases of their docstrings."""

import hashlib
import re
from collections import defaultdict

import pytest

from lodestack.llm import compaction, exact_dedup, media, mixing, shared, warc


def test_exact_dedup_cases(spark):
    rows = [(5, "a b"), (3, "a  b"), (4, "a  b"), (None, "ab"), (7, None), (8, " \n"), (9, "x" * 50_000), (9, "x" * 50_000), (10, "zz"), (11, "y" * 300 + "1"), (12, "y" * 300 + "2")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, norm_len int")
    got = [tuple(r) for r in exact_dedup.decisions(docs, digest_all=True).select("doc_id", "keep_id", "group_size", "kept", "digest").collect()]
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d is None, d))
    want = []
    for d, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[key])
        want.append((d, best[2], len(groups[key]), d == best[2] and len(t or "") == -best[0], hashlib.sha256(key.encode()).hexdigest()))
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert exact_dedup.deduplicated(docs).columns == docs.columns
    assert exact_dedup.decisions(docs.limit(0)).count() == 0


def test_mix_targets_and_repeats(spark):
    rows = [(i, "w " * (i % 7 + 1), "abc"[i % 3] if i % 10 else None) for i in range(200)] + [(None, None, "a"), (1, "w", "a"), (1, "w", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, width=16).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix(docs, width=16).collect()))
    taken, size, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 8 and target[s] <= 2 * size[s] for s in size)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    assert mixing.mix(docs.limit(0)).count() == 0
    clash = docs.selectExpr("*", "'a' as __tie", "'b' as __tiea", "1 as __times", "2 as __copy", "3 as __score")
    assert mixing.mixed(clash).columns == clash.columns and {r["__copy"] for r in mixing.mixed(clash).collect()} == {2}


def test_mix_is_cut_in_the_sorted_line(spark, monkeypatch):
    """The taken passes are the first ones of the whole line in order of finish time, over many ranges."""
    monkeypatch.setattr(mixing, "RANGE", 30)
    rows = [(i, "w " * (i * i % 23 + 1), "abcd"[i % 4]) for i in range(400)] + [(900, "long " * 3000, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    line = mixing.in_order(spark.range(1000).selectExpr("id % 7 + 1 as size", "double((id * 37) % 1000) as vft"))
    found = {}
    for r in line.collect():
        found.setdefault(r["range"], []).append(r.vft)
    assert len(found) > 5 and all(v == sorted(v) for v in found.values())
    spans = sorted((v[0], v[-1]) for v in found.values())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    sizes = sorted((float(i * 37 % 1000), i % 7 + 1) for i in range(1000))
    for budget in (0, 1, 50, 1234, 3990):
        run, want = 0, float("inf")
        for vft, size in sizes:
            run += size
            if run > budget:
                want = vft
                break
        assert mixing.budget_cut(line, budget) == want
    got = mixing.mix(docs).collect()
    total = sum(r.size for r in got)
    assert 0 <= 1.5 * total - sum(r.taken for r in got) < 3000 and {r.size for r in got if r.doc_id == 900} == {3000}


def test_sharding(spark):
    store = compaction.ShardStore(spark, shared.new_path(spark, "t"), target_bytes=20_000, fan_in=2)
    with pytest.raises(ValueError):
        store.read()
    docs = spark.range(3000).selectExpr("id as doc_id", "case when id % 50 = 0 then null else repeat(string(id), 9) end as text", "'s' as _x", "'t' as _shard")
    for k in range(4):
        store.append(docs.filter(f"doc_id % 4 = {k}").repartition(4))
    before = len(store.manifest()["shards"])
    store.append(docs.limit(0))
    after = store.settle()
    assert len(after["shards"]) < before and store.versions()[-1] == after["version"]
    assert store.read().count() == 3000 and store.read(2).count() == 1500  # older versions stay readable
    assert after["version"] > 5 and {r._shard for r in store.read().collect()} == {"t"} and store.read().columns[-1] == "__shard"
    docs.limit(5).write.parquet(f"{store.root}/data/uncommitted")  # another writer's, not committed yet
    assert store.vacuum() == before and len(store._files(f"{store.root}/data/uncommitted")) > 0
    assert store.vacuum(0.0) > 0 and store._files(f"{store.root}/data/uncommitted") == []
    assert store.read().select("doc_id").distinct().count() == 3000
    with pytest.raises(compaction.Conflict):
        store.commit(1, after["schema"], [])


def test_warc_round_trip(spark):
    page = "<p>" + "same words " * 30 + "</p>"
    rows = [(4, "u", page), (2, "v\nw", page), (2, None, page), (9, "x", None), (10, "x", "tiny"), (11, "x", "tiny"), (None, "n", page)] + [(100 + i, "u", f"<p>page {i} " + "words " * (i % 60) + "</p>") for i in range(400)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string")
    folder, archives = warc.write(pages)
    got = {}
    for r in warc.read(archives, folder, with_payload=True).collect():
        got.setdefault(r.page_id, []).append((r.record_type, r.refers_to, r.payload_bytes, r.payload_digest))
        if r.record_type == "response":
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    assert sum(map(len, got.values())) == len(rows)
    assert got[4][0][:2] == ("revisit", 2) and [x[0] for x in got[2]] == ["response"] * 2 and got[None][0][:2] == ("revisit", 2)
    assert got[9][0][2] == 0 and got[10][0][0] == got[11][0][0] == "response"
    folder, archives = warc.write(pages.limit(0))
    assert warc.read(archives, folder).count() == 0


def test_media_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "é" * 40_000), (None, "a"), (5, "a")], "doc_id long, text string")
    rows = media.describe(media.store(docs)).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].media_sha256 == by[2].media_sha256 and by[1].payload_bytes == 64 and by[3].n_bytes == 80_000
    assert by[None].feature == by[5].feature and media.describe(media.store(docs.limit(0))).count() == 0
