"""The encoder against the tokenizers library, and the transducer against a dict."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodestack.llm import bpe, lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "Hello, World!", "it's we'll DON'T 'S", "á ȩ́ Å", "ΟΔΟΣ Σ ΑΣ ΑΣ.", "İstanbul ß ẞ", "日本語 テスト 123 ٣٤ ½ Ⅷ", "x<|endoftext|>Y <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "tab\tnew\nline\x0bv\x0cf\r nb　wide​zero\x1cfs\x85nel", "🙂👩‍👩‍👧 ë", "a" * 3000, "____ --- ... !!!'s''ll", "\x00\x01 ﻿", "naïve façade Straße enßer ñandú"]


@pytest.fixture(scope="module")
def model():
    return bpe.Bpe(PATH)


def check(encoder, texts):
    library = Tokenizer.from_file(PATH)
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        n, joined, decoded = encoder.encode(text)
        assert joined == " ".join(map(str, ids)), repr(text)
        assert n == len(ids)
        assert decoded == library.decode(ids, skip_special_tokens=False)


def test_equals_library(model):
    rng = random.Random(1)
    letters = "abcdeéßñΣ'’sStTlL .,!?0123\t\n日́"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(400)]
    check(bpe.Encoder(model, None), TEXTS + made)


def test_lexicon_changes_nothing(model):
    words = ["the", "there", "then", "hers", "ther", "é", "123", "'s", "world"]
    built = lexicon.Lexicon(data=lexicon.build([(w.encode(), model.merge(w.encode())) for w in words]))
    for w in words:
        assert built.get(w.encode()) == model.merge(w.encode())
    check(bpe.Encoder(model, built), [*TEXTS, "the there then world's thereof"])


def test_transducer_is_minimal_and_exact(tmp_path):
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))).encode(): [rng.randrange(99) for _ in range(rng.randrange(4))] for _ in range(500)}
    path = tmp_path / "lex"
    path.write_bytes(lexicon.build(list(words.items())))
    built = lexicon.Lexicon(str(path))
    for w, ids in words.items():
        assert built.get(w) == ids
    for w in (b"", b"x", b"abcabcabc", b"ab\xff"):
        assert built.get(w) is (None if w not in words else words[w])
    asked = [*words, b"", b"x", b"abcabcabc", b"ab\xff", b"a", b"cccccc"]
    assert built.get_many(asked) == [built.get(w) for w in asked] and built.get_many([]) == []
    # Minimal: as many states as there are distinct sets of continuations.
    tails = {}
    for w in words:
        for i in range(len(w) + 1):
            tails.setdefault(w[:i], set()).add(w[i:])
    assert built.n_states == len({frozenset(x) for x in tails.values()})
    empty = lexicon.Lexicon(data=lexicon.build([]))
    assert empty.get(b"a") is None and empty.get(b"") is None and empty.get_many([b"a", b""]) == [None, None]
    only = lexicon.Lexicon(data=lexicon.build([(b"", [7])]))
    assert only.get_many([b"", b"a"]) == [only.get(b""), only.get(b"a")] == [[7], None]


def test_query_on_cases(spark):
    rows = [(1, "Hello the world"), (None, "Hello"), (2, None), (2, None), (3, "x" * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    uri = bpe.compile_lexicon(docs, PATH)
    got = {(r.doc_id, r.n_tokens) for r in bpe.digests(docs, PATH, uri).collect()}
    assert (2, 0) in got and (1, 3) in got and len(got) == 4
    empty = bpe.digests(docs.limit(0), PATH, bpe.compile_lexicon(docs.limit(0), PATH))
    assert empty.collect() == []
    back = bpe.decode(bpe.encode(docs, PATH, uri), PATH).filter("doc_id = 1").first()
    assert back.decoded == "hello</w> the</w> world</w>" and len(back.ids) == 3
    assert hashlib.sha256(b"").hexdigest() in {r.ids_sha256 for r in bpe.digests(docs, PATH, uri).collect()}


def test_no_row_a_word_reaches_the_driver(spark, model, monkeypatch):
    words = [a + b + c + d for a in ("a", "é", "st") for b in ("bc", "日本", "s") for c in "abcdefghij" for d in "klmnopqrst"]
    docs = spark.createDataFrame([(k, " ".join(words[k:] + words[:k])) for k in range(2)], "doc_id long, text string").repartition(2)
    fetched = []
    for name in ("collect", "toPandas"):
        def seen(df, plain=getattr(type(docs), name)):
            out = plain(df)
            fetched.append(len(out))
            return out

        monkeypatch.setattr(type(docs), name, seen)
    uri = bpe.compile_lexicon(docs, PATH)
    assert max(fetched) < 100
    built, want = bpe.open_lexicon(uri), {w.encode() for word in words for w in model.find(word)}
    assert built.n_words == len(want)
    for w in want:
        assert built.get(w) == model.merge(w)


def test_words_come_in_order():
    plain = [(b"", [1]), (b"a", []), (b"ab", [2, 3]), (b"b", [4])]
    assert b"".join(lexicon.sections((w for w, _ in plain), np.array([0, 1, 1, 3, 4]), np.array([1, 2, 3, 4]))) == lexicon.build(plain[::-1])
    for wrong in ([b"a", b"a"], [b"b", b"a"], [b"", b""]):
        with pytest.raises(ValueError):
            list(lexicon.sections(iter(wrong), np.array([0, 0, 0]), np.array([])))


def test_merging_many_equals_merging_one(model):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdehilnorst'éß日") for _ in range(rng.randrange(1, 30))).encode() for _ in range(3000)] + [b"", b"a" * 47, b"ab" * 40]
    assert model.merge_many(words) == [model.merge(w) for w in words]


def test_batches_equal_the_library_on_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    library = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = bpe.digests(docs, PATH, bpe.compile_lexicon(docs, PATH)).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        want = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *want)


def test_other_tokenizers_are_refused(tmp_path):
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    spec["normalizer"] = {"type": "NFKC"}
    (tmp_path / "t.json").write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.Bpe(str(tmp_path / "t.json"))
