"""Minimal acyclic transducer: words to integers in a shared-suffix automaton in one flat, memory-mapped file.

Words are inserted in sorted order and states are merged with equal ones as soon as no later word can change
them, so the automaton is minimal and never exists as a trie. Each arc carries the number of words that sort
before those behind it; the sum along a word's path is the word's rank, which points at its list of ids. Equal
suffixes therefore share states although their outputs differ.

File: magic, then counts, then little-endian arrays: state starts, arc labels, arc keys (state and label, in order), arc targets, arc
outputs, list starts, ids. Many words are looked up together, a letter of all words of a length at a time.
"""

from __future__ import annotations

import struct
from array import array

import numpy as np

MAGIC = b"LXTRANS1"
FINAL = 1 << 31
_BYTES = [bytes([b]) for b in range(256)]


class _State:
    """A state that later words may still change: its arcs lead to numbers of settled states."""

    __slots__ = ("arcs", "final")

    def __init__(self):
        self.arcs, self.final = {}, False

    def key(self) -> bytes:
        return array("I", [self.final, *(x for arc in self.arcs.items() for x in arc)]).tobytes()


def build(pairs) -> bytes:
    """pairs: (word as bytes, list of ids), any order, distinct words."""
    pairs = sorted(pairs)
    lists = np.cumsum([0] + [len(ids) for _, ids in pairs])
    return b"".join(sections((word for word, _ in pairs), lists, np.array([i for _, ids in pairs for i in ids], dtype="<u4")))


def sections(words, lists: np.ndarray, flat: np.ndarray):
    """The file of distinct words in ascending order, part by part; a word's ids are those of ``flat`` between its two places in ``lists``.

    Arcs are written as soon as their state is settled, so that beside them only the register of states is held."""
    register: dict[bytes, int] = {}
    behind = array("I")  # words behind each settled state
    starts, labels, targets, outputs = array("I"), array("B"), array("I"), array("I")
    root, path, last, n_words = _State(), [], None, 0

    def write(state: _State) -> None:
        starts.append(len(labels) | (FINAL if state.final else 0))
        before = int(state.final)
        for c, t in state.arcs.items():
            labels.append(c)
            targets.append(t)
            outputs.append(before)
            before += behind[t]
        behind.append(before)

    def add(state: _State) -> int:
        number = register.setdefault(state.key(), len(register))
        if number == len(behind):
            write(state)
        return number

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, label, child = path.pop()
            parent.arcs[label] = add(child)

    for word in words:
        if last is not None and word <= last:
            raise ValueError("a word is given twice or out of order")
        common, last = 0, last or b""
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        state = path[-1][2] if path else root
        for c in word[common:]:
            child = _State()
            path.append((state, c, child))
            state = child
        state.final = True
        last, n_words = word, n_words + 1
    settle(0)
    register.clear()
    write(root)
    states = len(starts)
    if states >= 1 << 24:
        raise ValueError("too many states for an arc key of 32 bits")
    starts.append(len(labels))
    starts, targets, outputs = (np.array(x, dtype="<u4") for x in (starts, targets, outputs))
    arcs_of = np.diff(starts & np.uint32(FINAL - 1))
    yield MAGIC + struct.pack("<4I", states, len(labels), n_words, len(flat))
    yield starts.tobytes()
    yield labels.tobytes() + b"\0" * (-len(labels) % 4)
    yield (np.repeat(np.arange(states, dtype="<u4") << np.uint32(8), arcs_of) | np.array(labels, dtype="<u4")).tobytes()
    for part in (targets, outputs, lists, flat):
        yield part.astype("<u4").tobytes()


class Lexicon:
    """Read-only view of a built file, memory-mapped: workers of a machine share its pages."""

    def __init__(self, path: str | None = None, data: bytes | None = None):
        import mmap

        if path is not None:
            with open(path, "rb") as f:
                data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if bytes(data[:8]) != MAGIC:
            raise ValueError("no lexicon file")
        states, arcs, words, ids = struct.unpack("<4I", data[8:24])
        at = 24

        def take(n: int, kind: str):
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.root, self.n_states, self.n_arcs, self.n_words = states - 1, states, arcs, words
        # memoryviews of the mapped file: an item is a plain int, faster to fetch than a numpy scalar
        self.starts = memoryview(take(states + 1, "<u4"))
        self.data, self.first_label = data, at  # the labels are searched where they lie
        at += arcs + -arcs % 4
        # arrays for many words, memoryviews of the same bytes for one
        self.keys, self.target_array, self.output_array = take(arcs, "<u4"), take(arcs, "<u4"), take(arcs, "<u4")
        self.targets, self.outputs = memoryview(self.target_array), memoryview(self.output_array)
        self.lists, self.ids = memoryview(take(words + 1, "<u4")), memoryview(take(ids, "<u4"))

    def rank(self, word: bytes) -> int:
        """Place of the word among the sorted words, -1 if it is none of them."""
        state, rank = self.root, 0
        starts, find, base = self.starts, self.data.find, self.first_label
        for c in word:
            at = find(_BYTES[c], base + (starts[state] & ~FINAL), base + (starts[state + 1] & ~FINAL))
            if at < 0:
                return -1
            low = at - base
            rank += self.outputs[low]
            state = self.targets[low]
        return rank if starts[state] & FINAL else -1

    def get(self, word: bytes):
        rank = self.rank(word)
        return None if rank < 0 else self.ids[self.lists[rank] : self.lists[rank + 1]].tolist()

    def ranks(self, words: list[bytes]) -> list[int]:
        """rank() of many words."""
        out = np.full(len(words), -1, dtype=np.int64)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        finals = np.frombuffer(self.starts, dtype="<u4") >= FINAL
        for n, places in by_length.items():
            index = np.array(places)
            raw = np.frombuffer(b"".join([words[i] for i in places]), dtype=np.uint8).reshape(-1, n).astype(np.uint32) if n else None
            state, rank = np.full(len(index), self.root, dtype=np.uint32), np.zeros(len(index), dtype=np.int64)
            for k in range(n if len(self.keys) else 0):
                key = state << np.uint32(8) | raw[:, k]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                on = self.keys[at] == key
                if not on.all():
                    index, raw, rank, at = index[on], raw[on], rank[on], at[on]
                state, rank = self.target_array[at], rank + self.output_array[at]
            if n and not len(self.keys):
                continue
            ends = finals[state]
            out[index[ends]] = rank[ends]
        return out.tolist()

    def get_many(self, words: list[bytes]) -> list:
        """get() of many words."""
        lists, ids = self.lists, self.ids
        return [None if r < 0 else ids[lists[r] : lists[r + 1]].tolist() for r in self.ranks(words)]
