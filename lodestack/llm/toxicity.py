"""Toxicity by a weighted finite-state pattern grammar.

1. The lexicon is a transducer over letters: a word, or any word with a listed beginning, goes out as the symbol of an insult
   with that entry's weight; listed words among them pass without one. Fixed words go out as threat, intent, target,
   negation and report.
2. Three weighted transducers read a clause's symbols: negation takes an insult's or threat's weight back, reported speech
   does so to the clause's end, and a target near an insult adds some. A fourth weighs threat frames: a threat word alone
   hardly counts, intent before it more, and a target of it makes the frame. They are composed into one machine, whose
   weights add along the path; clauses that hold an insult or threat are run through it in both directions of reach.
3. A matched word's weight is that of the best path through one of its clauses, never below nothing. A text's score is
   the logistic function of the sum over its different matched words, less what words of that number bring by chance.

So an insult that each of its clauses denies or reports adds nothing, and a threat word without its frame next to nothing.

The fit takes at most ``SAMPLE`` labelled rows of at most ``SAMPLE_CHARS`` characters together (those with the smallest hash of
their id), a documented bound for the fit alone. It finds entries of the lexicon by a likelihood ratio of how many different
texts hold a word or beginning, their weights, and the scale, price of length and bias. What negation, report, target and the
threat frames weigh is fixed. Every text is scored whole, in one narrow pass without a shuffle.

Cases: null and empty texts get the score of no matched clause; null or contradicting labels count as toxic if any
is 1 and as unlabelled if all are null; without labelled rows the default weights hold; repeated rows and ids are
scored row by row; very long texts are scored whole, row by row; an empty table gives an empty one; other columns, whatever
their names, pass through.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh

SAMPLE = 6000
SAMPLE_CHARS = 64 << 20
THRESHOLD = 0.3
MEMO = 100_000
REACH = 2
NEAR = 4
#: Fixed arc weights.
DENIED, TARGETED = -20.0, 0.7
VERB, MEANT, FRAMED = 0.3, 1.7, 4.0
#: Weight of a listed insult before any fit, and bounds of a fitted one.
INSULT_WEIGHT, LEAST_WEIGHT, MOST_WEIGHT = 5.0, 0.8, 5.0

# Fixed word lists.
INSULTS = "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown dumb imbecile cretin filthy vermin dummkopf trottel abschaum wertlos idiote imbécile crétin ordure minable imbécil estúpido estúpida basura escoria inútil".split()
THREATS = "kill murder hurt strangle stab töten umbringen tuer matar".split()
INTENTS = "will shall gonna going i'll we'll werde werden wird wirst vais va allons voy vamos vas".split()
TARGETS = "you your you're he she they him her them du dich dein ihr euch er sie tu toi vous ton il elle ils elles eres tú usted ustedes ellos ellas te".split()
NEGATIONS = "not no never n't isn't aren't wasn't don't nicht kein keine nie pas jamais ne nunca jamás ningún".split()
REPORTS = "said says say wrote writes called calls quoted reported sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó".split()

OTHER, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT = "oitmynr"
ALPHABET = [OTHER, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT]
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;:\n]")
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
SIZES = range(3, 9)


class Transducer:
    """Deterministic, weighted: arcs (state, symbol) -> (state, output, weight)."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def run(self, symbols) -> tuple[list[str], list[float]]:
        """Outputs and the weights of the arcs taken."""
        state, out, weights = self.start, [], []
        for s in symbols:
            state, o, w = self.arcs[state, s]
            out.append(o)
            weights.append(w)
        return out, weights


def compose(first: Transducer, second: Transducer, alphabet) -> Transducer:
    """The machine that feeds first's output to second; only reachable pairs of states are built, weights add."""
    start = (first.start, second.start)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol in alphabet:
            a, middle, w1 = first.arcs[state[0], symbol]
            b, out, w2 = second.arcs[state[1], middle]
            arcs[state, symbol] = ((a, b), out, w1 + w2)
            if (a, b) not in seen:
                seen.add((a, b))
                todo.append((a, b))
    return Transducer(start, arcs)


def near(trigger: str, weight: float, reach: int | None, hit: str = INSULT + THREAT) -> Transducer:
    """Adds weight to the symbols ``hit`` at most ``reach`` symbols after a trigger (None: to the clause's end)."""
    full, arcs = reach or 1, {}
    for left in range(full + 1):
        for symbol in ALPHABET:
            rest = full if symbol == trigger else left if reach is None else max(0, left - 1)
            arcs[left, symbol] = (rest, symbol, weight if left and symbol in hit else 0.0)
    return Transducer(0, arcs)


def frames(reach: int = 3) -> Transducer:
    """Threat frames: a state holds how many symbols ago intent, target and threat may lie at most. The target may stand
    before the threat word or after it."""
    arcs, todo, seen = {}, [(0, 0, 0)], {(0, 0, 0)}
    while todo:
        state = todo.pop()
        intent, target, threat = state
        for symbol in ALPHABET:
            step = [max(0, x - 1) for x in state]
            weight = 0.0
            if symbol == INTENT:
                step[0] = reach + 1
            elif symbol == TARGET:
                weight = FRAMED if threat else 0.0
                step[1:] = [reach, 0]
            elif symbol == THREAT:
                weight = VERB + (MEANT if intent else 0.0) + (FRAMED if intent and target else 0.0)
                step[2] = 0 if not intent or target else reach
            arcs[state, symbol] = (tuple(step), symbol, weight)
            if tuple(step) not in seen:
                seen.add(tuple(step))
                todo.append(tuple(step))
    return Transducer((0, 0, 0), arcs)


def grammar() -> tuple[Transducer, Transducer]:
    """The machine that reads a clause, and the one that reads it backwards for targets that follow an insult."""
    denied = compose(near(NEGATION, DENIED, REACH), near(REPORT, DENIED, None), ALPHABET)
    return compose(compose(denied, near(TARGET, TARGETED, NEAR, INSULT), ALPHABET), frames(), ALPHABET), near(TARGET, TARGETED, NEAR, INSULT)


class Lexicon:
    """Letter by letter: states of a tree; a state may end a word, or let any letters follow, with a weight."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float], passed=()):
        self.next: list[dict[str, int]] = [{}]
        self.word: dict[int, float] = {}
        self.beginning: dict[int, float] = {}
        for weights, table in ((beginnings, self.beginning), (words, self.word), (dict.fromkeys(passed, 0.0), self.word)):
            for entry, weight in weights.items():
                table[self._state(entry)] = weight

    def _state(self, entry: str) -> int:
        at = 0
        for c in entry:
            if c not in self.next[at]:
                self.next[at][c] = len(self.next)
                self.next.append({})
            at = self.next[at][c]
        return at

    def weight(self, word: str) -> float:
        """The entry's weight: the whole word's, else that of the longest beginning; 0 if there is none."""
        at, found = 0, 0.0
        for k, c in enumerate(word):
            if k:
                found = self.beginning.get(at, found)
            at = self.next[at].get(c, -1)
            if at < 0:
                return found
        return self.word.get(at, found)


class Model:
    def __init__(self, words=None, beginnings=None, passed=(), scale: float = 1.0, price: float = 0.0, bias: float = -3.5):
        self.words = {w: INSULT_WEIGHT for w in INSULTS} if words is None else words
        self.beginnings, self.passed = beginnings or {}, tuple(passed)
        self.scale, self.price, self.bias = scale, price, bias


class Scorer:
    def __init__(self, model: Model):
        self.model, (self.machine, self.back) = model, grammar()
        self.lexicon = Lexicon(model.words, model.beginnings, model.passed)
        self.fixed = {w: s for s, ws in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (INTENT, INTENTS), (THREAT, THREATS)) for w in ws}
        self.symbols: dict[str, tuple[str, float]] = {}
        self.chunks: dict[str, bool] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        found = self.symbols.get(word)
        if found is None:
            if len(self.symbols) > MEMO:
                self.symbols.clear()
            if word in self.fixed:
                found = self.fixed[word], 0.0
            else:
                weight = self.lexicon.weight(word)
                found = (INSULT, weight) if weight else (OTHER, 0.0)
            self.symbols[word] = found
        return found

    def hits(self, chunk: str) -> bool:
        if len(self.chunks) > MEMO:
            self.chunks.clear()
        found = self.chunks[chunk] = any(self.symbol(w)[0] in (INSULT, THREAT) for w in WORD.findall(chunk.lower()))
        return found

    def clause(self, words: list[str]) -> list[tuple[str, float]]:
        """Matched words of a clause with their weight on the path. A frame's weight is its threat word's."""
        pairs = [self.symbol(w) for w in words]
        symbols = [s for s, _ in pairs]
        if INSULT not in symbols and THREAT not in symbols:
            return []
        _, there = self.machine.run(symbols)
        _, behind = self.back.run(symbols[::-1])
        out, threat = [], None
        for word, (symbol, weight), a, b in zip(words, pairs, there, behind[::-1]):
            if symbol == INSULT:
                out.append((word, max(0.0, weight + max(a, b if a >= 0 else a))))
            elif symbol == THREAT:
                threat = len(out)
                out.append((word, max(0.0, a)))
            elif symbol == TARGET and a > 0 and threat is not None and out[threat][1] > 0:
                out[threat] = (out[threat][0], out[threat][1] + a)
        return out

    def matches(self, text: str) -> dict[str, float]:
        """Different matched words of a text, each with the best weight of its clauses."""
        found: dict[str, float] = {}
        known = self.chunks
        if not any(known[c] if c in known else self.hits(c) for c in text.split()):
            return found
        words: list[str] = []
        for token in [*TOKEN.findall(text.lower()), "."]:
            if token in ".!?;:\n":
                for word, weight in self.clause(words):
                    found[word] = max(weight, found.get(word, 0.0))
                words = []
            else:
                words.append(token)
        return found

    def parts(self, text: str) -> tuple[float, float]:
        """Sum of weights, and thousands of words (counted by blanks) where there is a match."""
        found = self.matches(text)
        return sum(found.values()), (text.count(" ") + 1) / 1000 if found else 0.0

    def score(self, text: str) -> float:
        total, length = self.parts(text)
        z = self.model.bias + self.model.scale * total - self.model.price * length
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def least_runs(text: str) -> set[tuple[int, int]]:
    """The least hash of a text's runs of four words under three seeds: near copies share one nearly surely."""
    words = text.lower().split()
    runs = [" ".join(words[i : i + 4]).encode("utf-8", "surrogatepass") for i in range(len(words) - 3)]
    return {(seed, min(zlib.crc32(r, seed) for r in runs)) for seed in (1, 2, 3)} if runs else set()


def entries(texts: list[str], toxic: list[int], gain: float = 14.0, least: int = 3) -> tuple[dict, dict, set]:
    """Words and beginnings that toxic texts hold far more often than others, with log odds as weights. Of near copies,
    which would make any of their words look telling, one counts.

    Greedy by the likelihood ratio of the numbers of (text, different word) pairs; a chosen entry's words are taken out
    before the next is chosen. A beginning needs five different words. Of a beginning's words, those that as many others hold pass."""
    sides, seen = [Counter(), Counter()], set()
    for text, y in zip(texts, toxic):
        marks = least_runs(text)
        if marks & seen:
            continue
        seen |= marks
        sides[y].update({w for w in WORD.findall(text.lower()) if len(w) >= 3})
    # Entries come from words of toxic texts; other words matter only where they share one.
    keys: dict[str, int] = {}
    for w in sorted(sides[1]):
        if not w.isdigit():
            for key in (w, *(w[:n] + "*" for n in SIZES if len(w) > n)):
                keys.setdefault(key, len(keys))
    names, who, what = [], array("i"), array("i")
    for w in sorted(sides[0].keys() | sides[1].keys()):
        found = [k for k in (keys.get(w), *(keys.get(w[:n] + "*") for n in SIZES if len(w) > n)) if k is not None]
        if found:
            who.extend([len(names)] * len(found))
            what.extend(found)
            names.append(w)
    pos, neg = (np.array([c[w] for w in names], dtype=float) for c in (sides[1], sides[0]))
    share = sum(sides[1].values()) / max(1, sum(sides[1].values()) + sum(sides[0].values()))
    who, what = np.array(who, dtype=np.int32), np.array(what, dtype=np.int32)
    if not keys:
        return {w: INSULT_WEIGHT for w in INSULTS}, {}, set()
    labels, alive = list(keys), np.ones(len(names), dtype=bool)
    several = np.bincount(what, minlength=len(keys))
    long = np.array([k.endswith("*") for k in labels], dtype=bool)
    words, beginnings, passed = {}, {}, set()
    while len(words) + len(beginnings) < 200:
        live = alive[who]
        p = np.bincount(what[live], weights=pos[who[live]], minlength=len(keys))
        q = np.bincount(what[live], weights=neg[who[live]], minlength=len(keys))
        rate = (p + 0.5 * share) / (p + q + 0.5)
        odds = np.log(rate / (1 - rate + 1e-9)) - math.log(share / (1 - share))
        value = np.where((p >= least) & (odds > 1.2) & (~long | (several >= 5)), p * odds - q, 0.0)
        best = int(value.argmax())
        if value[best] < gain:
            break
        mine = np.unique(who[(what == best) & live])
        weight = float(min(MOST_WEIGHT, max(LEAST_WEIGHT, odds[best])))
        if long[best]:
            out = [i for i in mine if neg[i] >= 3 and neg[i] >= pos[i] / 3]
            passed.update(names[i] for i in out)
            rest = np.setdiff1d(mine, out)
            r = (pos[rest].sum() + 0.5 * share) / (pos[rest].sum() + neg[rest].sum() + 0.5)
            weight = float(min(MOST_WEIGHT, max(LEAST_WEIGHT, math.log(r / (1 - r + 1e-9)) - math.log(share / (1 - share)))))
            beginnings[labels[best][:-1]] = weight
        else:
            words[labels[best]] = weight
        alive[mine] = False
    for w in INSULTS:
        if w not in words and not sides[0][w]:
            words[w] = INSULT_WEIGHT
    return words, beginnings, passed


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Lexicon, scale, price of length and bias from labelled texts; bounds keep the unmatched text well below the threshold."""
    if not texts or not any(toxic) or all(toxic):
        return Model()
    model = Model(*entries(texts, toxic))
    scorer = Scorer(model)
    x = np.array([(*scorer.parts(t), 1.0) for t in texts])
    y = np.array(toxic, dtype=float)
    least, most = np.array([0.3, -1.5, -6.0]), np.array([3.0, 0.0, -2.0])
    w = np.array([1.0, -0.1, -3.5])
    curvature = 0.25 * (x**2).sum(0) + 1e-6
    for _ in range(3000):
        error = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - y
        w = np.clip(w - (x.T @ error) / (curvature * 3), least, most)
    model.scale, model.price, model.bias = float(w[0]), float(-w[1]), float(w[2])
    return model


def held_out(doc_id):
    """Rows whose labels are never used."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Model:
    from pyspark.sql import Window

    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = text.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    so_far = F.sum(F.length("text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # over at most ``rows`` rows
    sample = sample.withColumn("so_far", so_far).filter(F.col("so_far") <= chars).orderBy("doc_id").toPandas()
    return fit(sample["text"].tolist(), [int(t == 1) for t in sample["toxic"]])


def scored(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with the score of every whole text."""
    from collections.abc import Iterator

    import pandas as pd

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in series:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(out, F.pandas_udf(run, "double")(F.coalesce(F.col(text_col), F.lit(""))))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are not rejected, all columns as they came."""
    name = fresh(docs, "__score")
    kept = scored(docs, train(docs, labels, id_col, text_col), text_col, name).filter(F.col(name) < THRESHOLD)
    return kept.select(*docs.columns)
