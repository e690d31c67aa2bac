"""Held-out accuracy on the driver's small table, the grammar against a plain reading of its rules, and the docstring's cases."""

import itertools
import random

import pytest

from lodestack.llm import queries, toxicity as tx


def plain_clause(symbols, weight):
    """Weight of each insult by the rules, with distances counted by hand."""
    out = []
    for i, s in enumerate(symbols):
        if s != tx.INSULT:
            continue
        denied = any(x == tx.NEGATION and 0 < i - k <= tx.REACH for k, x in enumerate(symbols))
        reported = tx.REPORT in symbols[:i]
        target = any(x == tx.TARGET and 0 < abs(i - k) <= tx.NEAR for k, x in enumerate(symbols))
        out.append(0.0 if denied or reported else weight + (tx.TARGETED if target else 0.0))
    return out


def test_clauses_by_hand():
    scorer = tx.Scorer(tx.Model({"idiot": 5.0}, {"lowei": 3.0}, {"loweiok"}))
    assert scorer.matches("You are an idiot.") == {"idiot": 5.7}
    assert scorer.matches("This is not an idiot; idiot") == {"idiot": 5.0}
    assert scorer.matches("This is not an idiot") == {"idiot": 0.0}
    assert scorer.matches("She wrote that the man on the street was an idiot") == {"idiot": 0.0}
    assert scorer.matches("Der loweixyz kam, loweiok auch, lowei nie") == {"loweixyz": 3.0}
    assert scorer.matches("I will kill you") == {"kill": pytest.approx(tx.VERB + tx.MEANT + tx.FRAMED)}
    assert scorer.matches("Ich werde dich töten") == {"töten": pytest.approx(tx.VERB + tx.MEANT + tx.FRAMED)}
    assert scorer.matches("kill the process") == {"kill": tx.VERB}
    assert scorer.matches("") == {} and scorer.matches("plain words") == {}
    assert scorer.score("You idiot") > 0.3 > scorer.score("no idiot") and scorer.score("plain") < 0.3
    assert scorer.score("I will kill you") > 0.3 > max(scorer.score(x) for x in ("kill", "I will not kill you", "he said I will kill you"))


def test_insults_equal_the_plain_reading():
    scorer = tx.Scorer(tx.Model({"idiot": 4.0}))
    words = {tx.OTHER: "stone", tx.INSULT: "idiot", tx.TARGET: "you", tx.NEGATION: "not", tx.REPORT: "said", tx.INTENT: "will"}
    rng = random.Random(2)
    clauses = [*itertools.product(words, repeat=4), *[[rng.choice(list(words)) for _ in range(12)] for _ in range(500)]]
    for symbols in clauses:
        got = [w for word, w in scorer.clause([words[s] for s in symbols]) if word == "idiot"]
        assert got == pytest.approx(plain_clause(list(symbols), 4.0))


def test_composition_equals_cascade():
    a, b = tx.near(tx.NEGATION, -3.0, 2), tx.near(tx.REPORT, -1.0, None)
    both = tx.compose(a, b, tx.ALPHABET)
    for symbols in itertools.product(tx.ALPHABET, repeat=4):
        middle, first = a.run(symbols)
        out, second = b.run(middle)
        assert both.run(symbols) == (out, [x + y for x, y in zip(first, second)])


def test_lexicon_takes_the_whole_word_or_the_longest_beginning():
    words, beginnings = {"abc": 1.0, "abcd": 2.0}, {"ab": 3.0, "abx": 4.0}
    lexicon = tx.Lexicon(words, beginnings, {"abz"})
    for word in map("".join, itertools.chain.from_iterable(itertools.product("abcdxz", repeat=n) for n in range(1, 6))):
        fits = [w for b, w in sorted(beginnings.items()) if word.startswith(b) and len(word) > len(b)]
        want = 0.0 if word == "abz" else words.get(word, fits[-1] if fits else 0.0)
        assert lexicon.weight(word) == want


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op3_toxicity_grammar(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    caught = sum(r.predicted and r.toxic == 1 for r in got)
    assert caught >= 0.9 * sum(r.toxic == 1 for r in got)
    assert caught >= 0.97 * sum(r.predicted for r in got)
    assert all(0 <= r.score <= 1 for r in got)


def test_near_copies_make_no_entries():
    base = " ".join(f"w{i}x" for i in range(80))
    texts, toxic = [base + f" end{i}" for i in range(40)], [1] * 40
    texts += [f"calm{i} words and more of them {i * 7} here" for i in range(200)]
    words, beginnings, _ = tx.entries(texts, toxic + [0] * 200)
    assert set(words) <= set(tx.INSULTS) and not beginnings


def test_cases(spark):
    rows = [(1, None), (None, "idiot you"), (2, ""), (2, "x " * 60_000 + "you idiot")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, __score double")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = tx.train(docs, labels)
    got = [(r.doc_id, r.score >= 0.3) for r in tx.scored(docs, model).collect()]
    assert got == [(1, False), (None, True), (2, False), (2, True)]
    kept = tx.clean(docs, labels)
    assert kept.columns == docs.columns and [r["__score"] for r in kept.collect()] == [0.5, 0.5]
    assert tx.clean(docs.limit(0), labels).count() == 0
