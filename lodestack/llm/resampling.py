"""Target-distribution importance resampling: documents are drawn so that their hashed n-gram features resemble a target's.

Words (letters a to z, digits, all characters from U+0080) in runs of one to ``ORDER`` are features; a feature's bucket is the CRC-32 of its bytes
modulo ``BUCKETS``. Each task reads its texts into word tries: a node is a word below the node of the words before it, and holds how often the
path occurs and the CRC state of its bytes. The state of a child follows from its parent's state and the CRC of the word below it, as appending L
bytes moves a CRC by a linear map of its 32 bits, so no feature is ever spelled out. Counts are folded into bucket totals, which are summed over all
tasks. With both totals known, a bucket has a gain; each document is scored by walking its paths, where every node holds the gains from the root.

Scale: two scans of the texts (counts, then scores), no shuffle of text. A task sends BUCKETS numbers whatever it reads; the gains sent to all tasks
have BUCKETS numbers. A trie is built for at most ``PIECE`` bytes of text and then let go; a longer text is walked in several pieces that
overlap by ORDER - 1 words, so memory is bounded by PIECE and the longest single word. The draw is a global rank: narrow rows are
range-sorted, and the sizes of the ranges (not their rows) meet to give each range its first rank.

Cases: a null or wordless text has no features and weight 0; repeated rows stay and are scored alike; a null id is hashed as the empty string and
ranks after others of its score; ties of score go to the smaller id, ties of id are in any order; empty tables give an empty result or, as
target, only t = T = 0; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import small, table

ORDER, BUCKETS = 3, 10_000
#: Documents with fewer words are not drawn.
LEAST_WORDS = 20
#: Bytes of text that share a trie.
PIECE = 4 << 20
#: Rows in a range of the global sort, and the most ranges.
RANGE, MOST_RANGES = 100_000, 10_000

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[ord("0") : ord("9") + 1] = _WORD_BYTE[ord("A") : ord("Z") + 1] = _WORD_BYTE[ord("a") : ord("z") + 1] = _WORD_BYTE[0x80:] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class CrcShift:
    """The linear maps that move a CRC-32 past L more bytes: shift(crc(a), len(b)) ^ crc(b) == crc(a + b)."""

    def __init__(self):
        # One zero byte, from zlib itself: the map's columns are what it does to each bit of the state.
        zero = zlib.crc32(b"\0")
        self._powers = [np.array([self._past_zero(1 << k, zero) for k in range(32)], np.uint32)]
        self._tables: dict[int, np.ndarray] = {}

    @staticmethod
    def _past_zero(crc: int, zero: int) -> int:
        return zlib.crc32(b"\0", crc) ^ zero

    @staticmethod
    def _apply(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape, np.uint32)
        for k in range(32):
            out ^= np.where((x >> np.uint32(k)) & np.uint32(1), columns[k], np.uint32(0))
        return out

    def _columns(self, length: int) -> np.ndarray:
        columns, k = np.uint32(1) << np.arange(32, dtype=np.uint32), 0
        while length:
            if k == len(self._powers):
                self._powers.append(self._apply(self._powers[-1], self._powers[-1]))
            if length & 1:
                columns = self._apply(self._powers[k], columns)
            length, k = length >> 1, k + 1
        return columns

    def _table(self, length: int) -> np.ndarray:
        """Four tables of 256, one for each byte of the state."""
        if length not in self._tables:
            if len(self._tables) >= 1024:
                self._tables.clear()
            columns, x = self._columns(length), np.arange(256, dtype=np.uint32)
            self._tables[length] = np.concatenate([self._apply(columns, x << np.uint32(8 * b)) for b in range(4)])
        return self._tables[length]

    def tables(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tables of all lengths that occur, one after another, and where each length's begin."""
        distinct, which = np.unique(lengths, return_inverse=True)
        flat = np.concatenate([self._table(int(n)) for n in distinct]) if len(distinct) else np.zeros(0, np.uint32)
        return flat, which.astype(np.int32) << np.int32(10)


def appended(crc: np.ndarray, flat: np.ndarray, base: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """CRCs of a + b from those of a, where the tables of b's length begin, and b's CRCs."""
    out = tails ^ flat[base + (crc & np.uint32(255)).astype(np.int32)]
    for b in range(1, 4):
        out ^= flat[base + ((crc >> np.uint32(8 * b)) & np.uint32(255)).astype(np.int32) + np.int32(256 * b)]
    return out


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bytes of a text without its separators, the words' end offsets in them, and their starts in the text."""
    raw = np.frombuffer(data.translate(_LOWER), np.uint8)
    inside = _WORD_BYTE[raw]
    edges = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return raw[inside], np.cumsum(ends - starts), starts


class Trie:
    """The tries of a run of words; paths of a document never lead into the next one. Level k holds the paths of k + 1 words."""

    def __init__(self, letters: np.ndarray, ends: np.ndarray, doc: np.ndarray, shift: CrcShift):
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        coded = column.dictionary_encode()
        word = coded.indices.to_numpy(zero_copy_only=False)
        _, bounds, data = coded.dictionary.buffers()
        bounds = np.frombuffer(bounds, np.int32, len(coded.dictionary) + 1) if len(coded.dictionary) else np.zeros(1, np.int32)
        data, length = memoryview(data or b""), np.diff(bounds)
        edges = bounds.tolist()
        crc = np.fromiter((zlib.crc32(data[a:b]) for a, b in zip(edges, edges[1:])), np.uint32, len(length))
        # A word below another one comes after a space: " " + word, by the same rule as any other path.
        flat, base = shift.tables(length)
        spaced = appended(np.full(len(length), zlib.crc32(b" "), np.uint32), flat, base, crc)
        flat, base = shift.tables(length + 1)
        #: By level: the node at each position where such a path begins (-1: it would leave the document), the CRC state and the parent of each node.
        self.node, self.state, self.parent = [word], [crc], [None]
        for k in range(1, ORDER):
            n = max(0, len(doc) - k)
            key = (self.node[-1][:n].astype(np.int64) << 32) | word[k:]
            key[doc[k:] != doc[:n]] = -1
            at, paths = pd.factorize(key, use_na_sentinel=False)
            gone = np.flatnonzero(paths < 0)
            paths[gone] = 0
            parent, last = (paths >> 32).astype(np.int32), paths.astype(np.int32)
            if len(paths):
                self.state.append(appended(self.state[-1][parent], flat, base[last], spaced[last]))
            else:
                self.state.append(np.zeros(0, np.uint32))
            at = at.astype(np.int32)
            if len(gone):
                at[at == gone[0]] = -1
            self.node.append(at)
            self.parent.append(parent)

    def totals(self, fresh: np.ndarray) -> np.ndarray:
        """Features by bucket. A cut text's last words begin no feature here: they are counted in its next piece."""
        out = np.zeros(BUCKETS)
        for at, state in zip(self.node, self.state):
            here = fresh[: len(at)] & (at >= 0)
            count = np.bincount(at if here.all() else at[here], minlength=len(state))
            out += np.bincount(state % np.uint32(BUCKETS), weights=count, minlength=BUCKETS)
        return out.astype(np.int64)

    def gains(self, gain: np.ndarray) -> np.ndarray:
        """Per word position, the gains of all features that begin there: each node carries those of its whole path."""
        path = gain[self.state[0] % np.uint32(BUCKETS)]
        out = path[self.node[0]]
        for k in range(1, ORDER):
            path = path[self.parent[k]] + gain[self.state[k] % np.uint32(BUCKETS)]
            at = self.node[k]
            if len(at):
                # The longest path from a position holds all gains on it.
                out[: len(at)] = np.where(at >= 0, path[at], out[: len(at)])
        return out


def pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of words of about PIECE bytes: letters, word ends, the row of each word, and whether features begin at it.

    A text that is cut goes on in the next run, after the words that overlap."""
    held: list[bytes] = []
    rows: list[int] = []
    size = 0

    def run():
        letters, ends, starts = words_of(b" ".join(held))
        bounds = np.cumsum([len(x) + 1 for x in held])
        return letters, ends, np.array(rows, np.int64)[np.searchsorted(bounds, starts, side="right")], np.ones(len(ends), bool)

    for row, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if len(data) > PIECE:
            yield from _cut(data, row)
            continue
        if held and size + len(data) > PIECE:
            yield run()
            held, rows, size = [], [], 0
        held.append(data)
        rows.append(row)
        size += len(data) + 1
    if held:
        yield run()


def _cut(data: bytes, row: int):
    """One long text in pieces that end between words and overlap by ORDER - 1 words, at which no feature of the earlier piece begins."""
    start = 0
    while start < len(data):
        end = start + PIECE
        while end < len(data) and _WORD_BYTE[data[end]]:
            end += 1
        letters, ends, starts = words_of(data[start:end])
        fresh = np.ones(len(ends), bool)
        if end < len(data) and len(ends) > 2 * ORDER:
            fresh[1 - ORDER :] = False
            yield letters, ends, np.full(len(ends), row, np.int64), fresh
            start += int(starts[1 - ORDER])
        elif end < len(data):
            # Too few words to part with: take more text (long words, or hardly any words).
            letters, ends, starts, end = _longer(data, start, end)
            fresh = np.ones(len(ends), bool)
            last = end >= len(data)
            if not last:
                fresh[1 - ORDER :] = False
            yield letters, ends, np.full(len(ends), row, np.int64), fresh
            start = len(data) if last else start + int(starts[1 - ORDER])
        else:
            yield letters, ends, np.full(len(ends), row, np.int64), fresh
            return


def _longer(data: bytes, start: int, end: int):
    while True:
        end = min(len(data), end + (end - start))
        while end < len(data) and _WORD_BYTE[data[end]]:
            end += 1
        letters, ends, starts = words_of(data[start:end])
        if end >= len(data) or len(ends) > 2 * ORDER:
            return letters, ends, starts, end


def bucket_totals(texts: DataFrame, text_col: str) -> DataFrame:
    """bucket, n: features of all texts by bucket, merged from the tries of all tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, out = CrcShift(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for letters, ends, doc, fresh in pieces(batch.column(0).to_pylist()):
                out += Trie(letters, ends, doc, shift).totals(fresh)
        seen = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(out[seen], pa.int64())], ["bucket", "n"])

    parts = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each of the BUCKETS buckets, by the same logarithm that SQL takes."""
    spark = source.sparkSession
    both = spark.range(BUCKETS).withColumnRenamed("id", "bucket").join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in "st")
    all_s, all_t = (F.lit(float(x.agg(F.sum("n")).first()[0] or 0)) for x in (source, target))
    gain = F.floor(F.lit(1000.0) * F.log((t + 1.0) * (all_s + F.lit(float(BUCKETS))) / ((s + 1.0) * (all_t + F.lit(float(BUCKETS))))))
    found = np.zeros(BUCKETS, np.int64)
    for r in both.select("bucket", gain.cast("long").alias("gain")).collect():  # BUCKETS rows, whatever the input
        found[r["bucket"]] = r["gain"]
    return found


def weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_words, n_features, weight."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = CrcShift()
        for batch in batches:
            words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for letters, ends, doc, fresh in pieces(batch.column(1).to_pylist()):
                trie = Trie(letters, ends, doc, shift)
                np.add.at(total, doc[fresh], trie.gains(gain)[fresh])
                np.add.at(words, doc[fresh], 1)
            for k in range(ORDER):
                features += np.maximum(words - k, 0)
            columns = [batch.column(0), pa.array(words), pa.array(features), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(score, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id, seed: int):
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, keep: int) -> DataFrame:
    """Adds rank (1, 2, ... by falling score, then id; null beyond ``keep`` and where not drawn), without a task that sees all rows."""
    drawn = rows.filter("eligible")
    ranges = max(1, min(MOST_RANGES, -(-drawn.count() // RANGE)))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    line = drawn.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    line = table(line.select("row", "score", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("place")), "resample-line")
    sizes = line.groupBy("range").agg(F.count("*").alias("n"), F.min("place").alias("from"))  # at most MOST_RANGES rows
    sizes = sizes.select("range", "from", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    line = line.join(F.broadcast(table(sizes, "resample-ranges")), "range")
    line = line.select(F.col("row").alias("at"), (F.col("place") - F.col("from") + F.col("before") + 1).cast("long").alias("rank")).filter(F.col("rank") <= keep)
    return rows.join(small(line), F.col("row") == F.col("at"), "left").drop("at")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Row per document: doc_id, n_words, n_features, weight, score, rank (null: not drawn)."""
    source = table(bucket_totals(docs, text_col), "resample-source")
    gain = bucket_gains(source, table(bucket_totals(target, target_col), "resample-target"))
    rows = weights(docs, gain, id_col, text_col)
    rows = rows.select("*", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), (F.col("n_words") >= LEAST_WORDS).alias("eligible"), F.monotonically_increasing_id().alias("row"))
    rows = table(rows, "resample-scores")
    n = rows.filter("eligible").count()
    return ranked(rows, percent * n // 100).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The resampled ids in order of rank."""
    return resample(docs, target, **options).filter("rank IS NOT NULL").select("doc_id", "rank")
