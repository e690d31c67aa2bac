"""BPE encoding and decoding of whole texts with a word lexicon in front of exact merges.

1. Count the words of all documents (partial counts in Arrow batches, then a sum by word).
2. Encode the most frequent ``LEXICON_WORDS`` words once and compile them into a minimal acyclic transducer file.
3. Every Python worker memory-maps that file and encodes words by walking it; words it lacks are merged exactly by
   rank. A bounded memo keeps the results of recent white-space chunks.

The lexicon decides speed only: with an empty one the ids are the same. The tokenizer file is a parameter and its
parts are read from it: normaliser NFC, white space to one space, lower case; split by the pattern; byte-level
alphabet; merges with an end-of-word suffix. Special tokens in a text are found before the normaliser runs.

Cases: a null or empty text has no ids and decodes to the empty string; texts are never cut; rows may repeat; an empty table
gives an empty result and an empty lexicon; columns other than the two named are not read, or pass through encode() unchanged.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lexicon
from .shared import drop, new_path, remove, table

LEXICON_WORDS = 300_000
#: Chunks or words in one generation of a worker's memos; they stay with the worker, beside the next stages' ones.
MEMO = 90_000
#: Chunks in a partial count.
COUNTED = 200_000
#: Words that are merged, or read from the sorted table, together.
MERGED = 10_000
#: Words of more parts are merged a whole round at a time, which costs less than single steps there.
LONG = 100
#: Words of at most this many bytes are merged many at a time.
SHORT = 48
BATCH_CHARS = 2 << 20
# Parts of the tokenizer file that the code here stands for; files with others are refused.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def byte_alphabet() -> list[str]:
    """Byte -> printable character: printable Latin-1 stands for itself, the rest for U+0100 onwards."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class Bpe:
    """The tokenizer of one file, in plain Python."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        split, *rest = spec["pre_tokenizer"]["pretokenizers"]
        plain = all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
        if spec["normalizer"] != NORMALIZER or rest != [BYTE_LEVEL] or (split["type"], split["behavior"], split["invert"]) != ("Split", "Removed", True) or spec["decoder"] or not plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path}: a tokenizer of another kind")
        self.vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # A pair of ids is one integer: its rank and the id it merges to are found without making strings.
        self.ranks = {self.vocab[a] << 32 | self.vocab[b]: i for i, (a, b) in enumerate(merges)}
        self.merged = [self.vocab[a + b] for a, b in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        pattern = split["pattern"]["Regex"]
        self.find = regex.compile(pattern).findall
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        alphabet = byte_alphabet()
        self.inner, self.last = [self.vocab[c] for c in alphabet], [self.vocab[c + self.suffix] for c in alphabet]
        # The same as arrays: pairs in order, their ranks, and what a rank merges to.
        pairs = np.array(list(self.ranks), dtype=np.uint64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], order.astype(np.int32)
        self.merged_ids, self.first_ids, self.last_ids = (np.array(x, dtype=np.int32) for x in (self.merged, self.inner, self.last))
        self.spaces = regex.compile(r"\p{White_Space}+").split
        self.separators = regex.compile("[\x1c-\x1f]").search

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # Letter by letter as in the library: a final capital sigma becomes the plain small one.
        return text.replace("Σ", "σ").lower()

    def chunks(self, text: str) -> list[str]:
        """The normalised text between white space. str.split also splits at U+001C to U+001F, which are not white space here."""
        text = self.normal(text)
        return [c for c in self.spaces(text) if c] if self.separators(text) else text.split()

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word in UTF-8 by merging the pair of lowest rank, leftmost first, until none is left."""
        inner, merged = self.inner, self.merged
        parts = [inner[b] for b in word]
        if not parts:
            return []
        parts[-1] = self.last[word[-1]]
        rank, none = self.ranks.get, len(self.ranks)
        costs = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while len(costs) > LONG:
            best = min(costs)
            if best == none:
                break
            at, out, last = 0, [], len(costs)
            while at <= last:
                if at < last and costs[at] == best:
                    out.append(merged[best])
                    at += 2
                else:
                    out.append(parts[at])
                    at += 1
            parts = out
            costs = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while costs and (best := min(costs)) < none:
            at = costs.index(best)
            parts[at] = merged[best]
            del parts[at + 1], costs[at]
            if at:
                costs[at - 1] = rank(parts[at - 1] << 32 | parts[at], none)
            if at < len(costs):
                costs[at] = rank(parts[at] << 32 | parts[at + 1], none)
        return parts

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], np.int32(len(self.pairs)))

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """merge() of many words: those of a length step by step together, one merge a word and step, so that the words that
        are not done have equally many parts all the time."""
        out: list = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if 0 < len(word) <= SHORT:
                by_length.setdefault(len(word), []).append(i)
            else:
                out[i] = self.merge(word)
        none = len(self.pairs)
        for n, index in by_length.items():
            index = np.array(index)
            raw = np.frombuffer(b"".join([words[i] for i in index.tolist()]), dtype=np.uint8).reshape(-1, n)
            parts = self.first_ids[raw]
            parts[:, -1] = self.last_ids[raw[:, -1]]
            ranks = self._pair_ranks(parts[:, :-1], parts[:, 1:])
            while len(index):
                best = ranks.min(axis=1) if ranks.shape[1] else np.full(len(index), none)
                done = best == none
                for i, ids in zip(index[done].tolist(), parts[done].tolist()):
                    out[i] = ids
                if done.any():
                    index, parts, ranks, best = index[~done], parts[~done], ranks[~done], best[~done]
                if not len(index):
                    break
                at, rows, columns = ranks.argmin(axis=1), np.arange(len(index)), np.arange(parts.shape[1] - 1)
                parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
                parts[rows, at] = self.merged_ids[best]
                columns = columns[:-1]
                ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
                left, right = np.flatnonzero(at > 0), np.flatnonzero(at < len(columns))
                ranks[left, at[left] - 1] = self._pair_ranks(parts[left, at[left] - 1], parts[left, at[left]])
                ranks[right, at[right]] = self._pair_ranks(parts[right, at[right]], parts[right, at[right] + 1])
        return out


class Memo:
    """Chunk or word -> decimal ids, and -> decoded text, in two generations: when the young one is full it becomes the old one,
    and keys met again move back, so frequent ones stay and memory is bounded by two generations and one batch."""

    def __init__(self):
        self.ids: dict[str, str] = {}
        self.text: dict[str, str] = {}
        self.old: tuple[dict, dict] = {}, {}

    def age(self) -> None:
        if len(self.ids) > MEMO:
            self.old = self.ids, self.text
            self.ids, self.text = {}, {}

    def missing(self, keys: set) -> list:
        """The keys that neither generation holds; the old one's move to the young one."""
        found = keys - self.ids.keys()
        old = [k for k in found if k in self.old[0]]
        for young, before in zip((self.ids, self.text), self.old):
            young.update(zip(old, map(before.__getitem__, old)))
        return list(found.difference(old)) if old else list(found)


class Encoder:
    """Chunk by chunk: a chunk is what stands between white space, and no token spans white space. The unknown words of a
    whole batch of texts are looked up and merged together."""

    def __init__(self, bpe: Bpe, words: lexicon.Lexicon | None):
        self.bpe, self.words = bpe, words
        self.memo = Memo()  # of chunks and of their words: a word alone is a chunk of its own with the same ids

    def learn(self, chunks: set[str]) -> None:
        find, names, memo = self.bpe.find, self.bpe.names.__getitem__, self.memo
        new, split = [], []
        for c in memo.missing(chunks):
            if c.isalpha() or (words := find(c)) == [c]:  # letters alone are one word
                new.append(c)
            else:
                split.append((c, words))
        if split:
            new += memo.missing({w for _, ws in split for w in ws}.difference(new))
        raw = [w.encode() for w in new]
        found = self.words.get_many(raw) if self.words is not None else [None] * len(raw)
        rest = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(rest, self.bpe.merge_many([raw[k] for k in rest])):
            found[k] = ids
        ids_of, text_of = memo.ids, memo.text
        for word, ids in zip(new, found):
            ids_of[word], text_of[word] = " ".join(map(str, ids)), " ".join(map(names, ids))
        for chunk, words in split:  # every chunk has at least one word, and every word at least one id
            ids_of[chunk], text_of[chunk] = " ".join([ids_of[w] for w in words]), " ".join([text_of[w] for w in words])

    def encode_batch(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text the number of ids, the ids in decimal joined by one space, and the decoded text."""
        bpe, cut = self.bpe, []
        for text in texts:
            if bpe.split_special is not None and any(s in text for s in bpe.special):
                cut.append([p if p in bpe.special else bpe.chunks(p) for p in bpe.split_special(text)])
            else:
                cut.append([bpe.chunks(text)])
        self.memo.age()
        self.learn(set().union(*(p for parts in cut for p in parts if type(p) is list)))
        ids_of, text_of, out = self.memo.ids.__getitem__, self.memo.text.__getitem__, []
        for parts in cut:
            if len(parts) == 1:
                ids, decoded = " ".join(map(ids_of, parts[0])), " ".join(map(text_of, parts[0]))
            else:
                ids = " ".join([x for p in parts for x in (map(ids_of, p) if type(p) is list else [str(bpe.special[p])])])
                decoded = " ".join([x for p in parts for x in (map(text_of, p) if type(p) is list else [p])])
            out.append((ids.count(" ") + 1 if ids else 0, ids, decoded))
        return out

    def batches(self, texts: list[str]):
        """encode_batch over slices of bounded length."""
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= BATCH_CHARS:
                yield from self.encode_batch(texts[start : i + 1])
                start, size = i + 1, 0
        yield from self.encode_batch(texts[start:])

    def encode(self, text: str) -> tuple[int, str, str]:
        return self.encode_batch([text])[0]


@functools.lru_cache(maxsize=1)
def worker_encoder(tokenizer: str, lexicon_uri: str | None) -> Encoder:
    """The encoder of a Python worker, with its memo: tasks that run in one worker share it."""
    return Encoder(Bpe(tokenizer), open_lexicon(lexicon_uri) if lexicon_uri else None)


def word_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """word, n over all documents, as the tokenizer splits them."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        bpe, chunks = Bpe(tokenizer), Counter()

        def flush():
            words = Counter()
            for chunk, n in chunks.items():
                if chunk.isalpha():
                    words[chunk] += n
                else:
                    for w in bpe.find(chunk):
                        words[w] += n
            chunks.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                chunks.update(bpe.chunks(text))
                if len(chunks) > COUNTED:
                    yield flush()
        if chunks:
            yield flush()

    text = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return text.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Writes the transducer of the most frequent words to the shared folder; returns its URI.

    A histogram of counts (at most 2,048 bars) sets the least count, so that about ``words`` rows are sorted and merged by tasks
    and the driver writes the file from them as a stream; of the bar that does not fit whole, a share by the hash of the word is
    taken."""
    from .warc import _file_system

    counts = table(word_counts(docs, tokenizer, text_col).filter("n > 1").withColumn("bar", F.floor(32 * F.log2("n"))), "word-counts")
    least, share, total = 0, 0, 0
    for bar, n in counts.groupBy("bar").count().orderBy(F.desc("bar")).collect():
        if total + n > words:
            least, share = bar, (words - total) * 10_000 // n
            break
        total += n
    partly = (F.col("bar") == least) & (F.pmod(F.xxhash64("word"), F.lit(10_000)) < share)
    frequent = merged_words(counts.filter((F.col("bar") > least) | partly), tokenizer)
    path = new_path(docs.sparkSession, "frequent-words")
    frequent.write.parquet(path)
    uri = new_path(docs.sparkSession, "lexicon")
    files, base = _file_system(uri)
    files.create_dir(os.path.dirname(base), recursive=True)
    with files.open_output_stream(base) as out:
        for part in lexicon.sections(*_frequent(path)):
            out.write(part)
    remove(docs.sparkSession, path)
    drop(counts)
    return uri


def merged_words(words: DataFrame, tokenizer: str) -> DataFrame:
    """word in UTF-8 and ids, in order of the words: merged in the tasks, many words together."""

    def run(batches):
        import pyarrow as pa

        bpe, held = Bpe(tokenizer), []

        def flush():
            ids = pa.array(bpe.merge_many(held), pa.list_(pa.int32()))
            out = pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), ids], names=["word", "ids"])
            held.clear()
            return out

        for batch in batches:
            held += batch.column(0).to_pylist()
            if len(held) >= MERGED:
                yield flush()
        if held:
            yield flush()

    return words.select(F.col("word").cast("binary").alias("word")).sort("word").mapInArrow(run, "word binary, ids array<int>")


def _frequent(path: str) -> tuple:
    """Words of the sorted table in order, a batch at a time, where each one's ids begin, and the ids. Read file by file and not
    through the session, so that neither the driver's JVM nor Python holds a row object for each word."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    from .warc import _file_system

    files, base = _file_system(path)
    # Spark names part files in order of the partitions.
    parts = sorted(f.path for f in files.get_file_info(fs.FileSelector(base)) if f.base_name.startswith("part-"))
    lists, flat = [np.zeros(1, dtype=np.int64)], [np.zeros(0, dtype=np.int32)]

    def batches(column: str):
        for part in parts:
            with files.open_input_file(part) as f:
                for batch in pq.ParquetFile(f).iter_batches(MERGED, columns=[column]):
                    yield batch.column(0)

    for ids in batches("ids"):
        lists.append(lists[-1][-1] + np.asarray(ids.offsets)[1:].astype(np.int64) - ids.offsets[0].as_py())
        flat.append(np.asarray(ids.flatten()))
    return (w for column in batches("word") for w in column.to_pylist()), np.concatenate(lists), np.concatenate(flat)


def open_lexicon(uri: str) -> lexicon.Lexicon:
    """Memory-maps the file where it lies; from a remote store it is copied to an unnamed local file first."""
    from .warc import _file_system

    files, base = _file_system(uri)
    if files.type_name == "local":
        return lexicon.Lexicon(base)
    import tempfile

    with tempfile.NamedTemporaryFile() as local:
        with files.open_input_stream(base) as f:
            local.write(f.read())
        local.flush()
        return lexicon.Lexicon(local.name)  # the mapping outlives the name


ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, tokenizer: str, lexicon_uri: str | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row per document: number of ids and digests of the ids and of the decoded text."""

    def run(batches):
        import pyarrow as pa

        encoder = worker_encoder(tokenizer, lexicon_uri)
        for batch in batches:
            n, ids, decoded = [], [], []
            for size, a, b in encoder.batches(batch.column(1).to_pylist()):
                n.append(size)
                ids.append(hashlib.sha256(a.encode()).hexdigest())
                decoded.append(hashlib.sha256(b.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, ENCODED)


def encode(docs: DataFrame, tokenizer: str, lexicon_uri: str | None, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """docs with a column of token ids."""
    import pandas as pd

    def run(series):
        encoder = worker_encoder(tokenizer, lexicon_uri)
        for texts in series:
            yield pd.Series([list(map(int, ids.split())) for _, ids, _ in encoder.batches(texts.tolist())], dtype=object)

    from collections.abc import Iterator

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(out_col, F.pandas_udf(run, "array<int>")(F.coalesce(F.col(text_col), F.lit(""))))


def decode(tokens: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """tokens with a column of decoded text."""

    def run(series):
        names = Bpe(tokenizer).names
        for ids in series:
            yield ids.map(lambda x: " ".join(names[int(i)] for i in x))

    from collections.abc import Iterator

    import pandas as pd

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return tokens.withColumn(out_col, F.pandas_udf(run, "string")(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))
