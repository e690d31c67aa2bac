"""The parity join against brute force: random near copies around the threshold, and the cases of the docstring."""

import random

import numpy as np

from brute import near_components
from lodestack.llm import ngram_join as nj


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, sid long")
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.clusters(docs).collect())


def made(seed):
    rng = random.Random(seed)
    rows, base = [], []
    for i in range(60):
        size = rng.choice([1, 3, 5, 6, 8, 9, 12, 20, 40, 90, 200])
        text = [rng.choice("abcdefghijkl") * rng.randrange(1, 4) for _ in range(size)]
        if base and rng.random() < 0.7:
            text = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice("xyz")
            if rng.random() < 0.3:
                text = text[rng.randrange(1, 3) :] or ["q"]
        base.append(text)
        rows.append((i * 7 % 61, rng.choice([" ", "\n", " \t "]).join(text).upper() if rng.random() < 0.2 else " ".join(text)))
    return rows


def test_equals_brute_force(spark):
    rows = made(1) + [(100, None), (101, ""), (102, " \n"), (103, "one two"), (104, "One  TWO"), (105, "é É")]
    want = near_components(rows)
    assert run(spark, [(*r, 5) for r in rows]) == want


def test_pigeonhole_never_misses():
    """Pairs at exactly the bound share a signature, for sizes through all small bands."""
    rng = np.random.default_rng(3)
    for n in [4, 5, 8, 9, 13, 27, 50, 99, 180, 333, 720]:
        for _ in range(12):
            pool = rng.integers(1, 1 << 62, 3 * n, dtype=np.uint64)
            shared = pool[:n]
            common = np.sort(rng.choice(pool, int(rng.choice([0, n // 10, n // 2, 2 * n])), replace=False))
            extra = n // 4  # |A| = n, |B| = n + n // 4: Jaccard n / (n + n // 4) >= 0.8
            a, b = np.unique(shared), np.unique(np.concatenate((shared, pool[n : n + extra])))
            assert set(nj.signatures(a, common)) & set(nj.signatures(b, common))
            half = n // 9  # both sides differ by n // 9
            c = np.unique(np.concatenate((shared[half:], pool[2 * n : 2 * n + half])))
            assert set(nj.signatures(a, common)) & set(nj.signatures(c, common))


def test_sparse_sets_send_empty_blocks():
    one = nj.signatures(np.arange(1, 5, dtype=np.uint64), np.arange(3, dtype=np.uint64))
    assert len(one) >= 1


def test_empty_table_nulls_and_repeats(spark):
    assert run(spark, []) == []
    text = "a b c d e f g h i j"
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (9, None), (None, None)], "doc_id long, text string")
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in nj.clusters(docs).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, [(None, 6, 5), (5, 6, 5), (5, 6, 5), (9, 0, 9), (None, 0, None)]))


def test_components_of_a_long_chain(spark):
    from lodestack.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (100, 200), (100, 300)], "a long, b long")
    got = {r.v: r.label for r in components(links).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in (100, 101, 200, 300)} == {100}


def test_pipeline_form_keeps_one(spark):
    text = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(3, text, "x"), (2, text + " end", "y"), (8, "other words here only once more", "z")], "doc_id long, text string, label string")
    assert sorted(r.doc_id for r in nj.deduplicated(docs).collect()) == [2, 8]


def test_sketches_are_lower_bounds():
    rng = np.random.default_rng(5)
    for n in (0, 1, 70, 400):
        a = np.unique(rng.integers(1, 1 << 62, n, dtype=np.uint64))
        b = np.concatenate((a[n // 7 :], rng.integers(1, 1 << 62, n // 9, dtype=np.uint64)))
        x, y = nj.parity_sketch(a), nj.parity_sketch(b)
        words = min(len(x), len(y)) // 2
        apart = int(np.bitwise_count(nj.folded(x, words) ^ nj.folded(y, words)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_open_groups_in_tiles(spark, monkeypatch):
    """Copies of one text with edits near the bound: the star leaves links open, and each tile holds a few members."""
    monkeypatch.setattr(nj, "TILE", 3)
    rng, rows = random.Random(11), []
    base = [f"w{i}" for i in range(80)]
    for i in range(70):
        text = list(rows[rng.randrange(len(rows))][1].split()) if rows and i % 3 == 0 else list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            text[rng.randrange(80)] = f"e{rng.randrange(500)}"
        rows.append((i, " ".join(text)))
    assert run(spark, [(*r, 5) for r in rows]) == near_components(rows)


def test_null_and_repeated_ids_are_judged_by_text(spark):
    text = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcde"]
    rows = [(1, text[0]), (None, text[0] + " end"), (None, text[1]), (None, None), (2, text[2]), (7, text[2] + " end"), (7, text[3]), (8, text[3] + " end"), (None, text[4]), (None, text[4] + " end")]
    docs = spark.createDataFrame([(i, x, k) for k, (i, x) in enumerate(rows)], "doc_id long, text string, k int")
    left = {r.k for r in nj.deduplicated(docs).collect()}
    # The null id that copies 1 goes, other null ids stay; 7 loses the copy of 2 only, and stays for 8.
    assert len(left & {8, 9}) == 1 and left - {8, 9} == {0, 2, 3, 4, 6}
    assert nj.deduplicated(docs).columns == docs.columns


def test_repeated_id_in_one_group(spark):
    text = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(3, text), (3, text + " end"), (4, text + " end more")], "doc_id long, text string")
    assert [r.doc_id for r in nj.deduplicated(docs).collect()] == [3]
