"""Removal of repeated passages by blockwise suffix sorting with a difference cover.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts somewhere else. Only suffixes'
first ``LENGTH`` bytes matter, so suffixes are grouped to that depth, one bucket at a time, by fingerprints
of their prefixes taken from prefix sums over windows of the chunk (rolling polynomials).

1. The texts are written once as chunks in the shared folder: whole documents of about ``CHUNK`` bytes together. A longer
   document becomes several chunks that overlap by LENGTH - 1 bytes, so that each start lies in exactly one of them.
2. Cover sample: positions whose offset modulo ``PERIOD`` lies in a perfect difference cover (12 of 133 residues). For any two suffixes
   some shift below PERIOD takes both into the sample, so two equal strings of 200 bytes contain a pair of equal sampled strings of
   200 - 132 = 68 bytes. The sample is ranked bucket by bucket; what matters of a rank is whether it is shared. This is a filter: a
   fingerprint that two strings share by chance costs work and decides nothing.
3. Suffixes: only those with a shared cover sample within reach can tie to full depth. They are sorted bucket by bucket, and each
   chunk learns which of its suffixes are tied with another one.
4. Each chunk marks the bytes that tied suffixes cover; the parts of a long document are put together in order.

A bucket holds about ``BUCKET`` fingerprints whatever the input's size. Before anything leaves a chunk, equal strings
inside it are marked and sent once, so a passage or copy that a third of all documents hold costs one entry a chunk.
A bucket answers with one bit an entry.

A full-depth tie needs 64 equal bits of one polynomial and an equal bucket, which comes from a second one. With n entries in
n / BUCKET buckets about n * BUCKET / 2**65 pairs of different strings are expected to tie: 3e-4 at 30 GB, one at 100 TB.

Memory of a worker: one chunk, its entries (at most some 50 bytes a byte of the chunk, if every position is a
candidate) or one bucket, and one document's bytes while it is cut.

Cases: a null text is empty; texts shorter than LENGTH are kept whole; a document whose whole text is repeated
keeps nothing; repeated rows repeat each other; null ids pass through; texts of any length are judged whole; an empty table
gives an empty result; columns other than the two named are not read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, new_path, remove, table
from .warc import _file_system

LENGTH = 200
PERIOD = 133
# A perfect difference set: every residue modulo 133 is a difference of two of these.
COVER = (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)
SHORT = LENGTH - PERIOD + 1
CHUNK = 1 << 20
#: Positions whose prefix sums are held at a time.
WINDOW = 1 << 16
BUCKET = 1_500_000
LEAST_BITS = 7

_ODD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Polynomial:
    """Fingerprints modulo 2**64 from powers of an odd number and of its inverse; what they give doesn't depend on windows."""

    def __init__(self, seed: int):
        base = seed * 8 + 5
        self.values = _mix((np.arange(1, 257, dtype=np.uint64) + np.uint64(seed)) * np.uint64(_ODD))
        self.up, self.down = (self._powers(x) for x in (base, pow(base, -1, 1 << 64)))

    @staticmethod
    def _powers(x: int) -> np.ndarray:
        factors = np.full(WINDOW + LENGTH, x, dtype=np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    def prints(self, data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """Fingerprints of the strings of ``length`` bytes at the positions ``at``, which are in order."""
        out, low = np.empty(len(at), dtype=np.uint64), 0
        while low < len(at):
            start = int(at[low])
            high = int(np.searchsorted(at, start + WINDOW))
            piece = data[start : int(at[high - 1]) + length]
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(self.values[piece] * self.up[: len(piece)], out=sums[1:])
            here = at[low:high] - start
            out[low:high] = (sums[here + length] - sums[here]) * self.down[here]
            low = high
        return _mix(out)


@functools.cache
def polynomial(seed: int) -> Polynomial:
    return Polynomial(seed)


class Chunk:
    """Whole documents, or a part of one, one after the other."""

    def __init__(self, data: bytes, sizes):
        self.bytes = np.frombuffer(data, dtype=np.uint8)
        self.ends = np.cumsum(np.array(sizes, dtype=np.int64))
        self.starts = self.ends - np.array(sizes, dtype=np.int64)

    def sampled(self) -> np.ndarray:
        """Positions of the cover sample whose short string lies in the document."""
        found = []
        for start, end in zip(self.starts.tolist(), self.ends.tolist()):
            if end - start >= LENGTH:
                found.append(start + _cover(end - start - SHORT + 1))
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def reachable(self, shared: np.ndarray) -> np.ndarray:
        """Starts of full strings that hold one of the shared sampled positions at most PERIOD - 1 bytes on."""
        n = len(self.bytes)
        doc = np.searchsorted(self.ends, shared, "right")
        low = np.maximum(shared - (PERIOD - 1), self.starts[doc])
        high = np.minimum(shared, self.ends[doc] - LENGTH)
        ok = low <= high
        delta = np.bincount(low[ok], minlength=n + 1) - np.bincount(high[ok] + 1, minlength=n + 1)
        return np.flatnonzero(np.cumsum(delta[:-1]) > 0)


_COVERS: dict[int, np.ndarray] = {}


def _cover(n: int) -> np.ndarray:
    """Sampled offsets below n."""
    have = _COVERS.get(0)
    if have is None or have[-1] < n:
        rows = max(1000, n // PERIOD + 2)
        have = _COVERS[0] = (np.arange(rows)[:, None] * PERIOD + np.array(COVER)[None, :]).ravel()
    return have[: np.searchsorted(have, n)]


def packed(ordered: np.ndarray) -> bytes:
    """Differences of ordered fingerprints, byte by byte of their places: the leading bytes are nearly all zero, which
    the shuffle's compression removes."""
    steps = np.diff(ordered, prepend=ordered.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, steps.itemsize).T.tobytes()


def unpacked(data, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    steps = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).view(kind)
    return np.cumsum(steps.ravel(), dtype=kind)


class Entries:
    """Distinct entries of a chunk in order of bucket and fingerprint, which of them it holds more than once, and each
    position's place among them. ``kind`` is the form that a fingerprint travels in."""

    def __init__(self, bucket: np.ndarray, prints: np.ndarray):
        order = np.lexsort((prints, bucket))
        bucket, prints = bucket[order], prints[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (bucket[1:] != bucket[:-1]) | (prints[1:] != prints[:-1])
        rank = np.cumsum(fresh, dtype=np.int32) - 1
        self.place = np.empty(len(order), dtype=np.int32)
        self.place[order] = rank
        self.bucket, self.prints = bucket[fresh], prints[fresh]
        self.twice = np.bincount(rank, minlength=len(self.bucket)) > 1

    def rows(self, chunk_id: int):
        """(bucket, chunk, packed fingerprints)."""
        bucket = self.bucket
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))).tolist() if len(bucket) else []
        for a, b in zip(first, [*first[1:], len(bucket)]):
            yield int(bucket[a]), chunk_id, packed(self.prints[a:b])

    def tied(self, answers) -> np.ndarray:
        """For each position whether its string occurs elsewhere. answers: (bucket, bits) of all buckets sent to."""
        out, at = self.twice.copy(), 0
        for _, n, mask in sorted((a["bucket"], a["n"], a["mask"]) for a in answers or ()):
            out[at : at + n] |= np.unpackbits(np.frombuffer(mask, dtype=np.uint8), count=n).astype(bool)
            at += n
        if at != len(out):
            raise ValueError("a bucket's answer is missing")
        return out[self.place]


def sample_entries(chunk: Chunk, at: np.ndarray, bits: int) -> Entries:
    """Short strings: the leading bits of one fingerprint are the bucket, the next 32 travel."""
    prints = polynomial(1).prints(chunk.bytes, at, SHORT)
    return Entries((prints >> np.uint64(64 - bits)).astype(np.int32), (prints >> np.uint64(32 - bits) & np.uint64(0xFFFFFFFF)).astype(np.uint32))


def full_entries(chunk: Chunk, at: np.ndarray, bits: int) -> Entries:
    """Full strings: 64 bits travel, the bucket is of the second polynomial."""
    bucket = (polynomial(2).prints(chunk.bytes, at, LENGTH) >> np.uint64(64 - bits)).astype(np.int32)
    return Entries(bucket, polynomial(1).prints(chunk.bytes, at, LENGTH))


SENT = "bucket int, chunk_id long, prints binary"


def _batches(rows, names, kinds, size=64, room=4 << 20):
    """Record batches of at most ``size`` rows or about ``room`` bytes of binary."""
    import pyarrow as pa

    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, (bytes, list)))
        if len(held) >= size or weight >= room:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


LISTED = "chunk_id long, path string, offset long, packed long, doc_ids array<long>, sizes array<long>, n_bytes long, cut string, part int"


def write_chunks(docs: DataFrame, folder: str, id_col: str, text_col: str) -> DataFrame:
    """One file of chunks a task; returns where each chunk lies, its documents and their sizes. ``cut`` names the document
    that a chunk is the ``part``-th part of. A retried task writes a file under a new name, and only the committed attempt's rows
    name files."""
    _file_system(folder)[0].create_dir(_file_system(folder)[1], recursive=True)
    room = CHUNK

    def run(batches):
        import uuid

        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        files, base = _file_system(folder)
        pack = zstandard.ZstdCompressor(level=1)
        task, path = TaskContext.get().partitionId(), f"{base}/{uuid.uuid4().hex}"
        out, offset, number = None, 0, 0

        def save(ids, texts, cut=None, part=0):
            nonlocal out, offset, number
            data = texts[0] if len(texts) == 1 else b"".join(texts)
            packed = pack.compress(data)
            out = out or files.open_output_stream(path, compression=None)
            out.write(packed)
            row = (task << 32 | number, path, offset, len(packed), ids, [len(t) for t in texts], len(data), cut, part)
            offset, number = offset + len(packed), number + 1
            return row

        def rows():
            ids, texts, held = [], [], 0
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    doc_id, data = doc_id.as_py(), text.as_py()
                    if texts and held + len(data) > room:
                        yield save(ids, texts)
                        ids, texts, held = [], [], 0
                    if len(data) > room + LENGTH - 1:
                        key = f"{task}-{number}"
                        for part, a in enumerate(range(0, len(data) - LENGTH + 1, room)):
                            yield save([doc_id], [data[a : a + room + LENGTH - 1]], key, part)
                        continue
                    ids.append(doc_id)
                    texts.append(data)
                    held += len(data)
            if texts:
                yield save(ids, texts)
            if out is not None:
                out.close()

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.int32()]
        yield from _batches(rows(), [x.split()[0] for x in LISTED.split(", ")], kinds, 64)

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(run, LISTED)


def _load(files, row) -> bytes:
    import zstandard

    with files.open_input_file(row["path"]) as f:
        f.seek(row["offset"])
        return zstandard.ZstdDecompressor().decompress(f.read(row["packed"]))


def shared_prints(sent: DataFrame, kind: str) -> DataFrame:
    """chunk_id, answers: per bucket one bit for each entry, set where another chunk sent the same fingerprint."""

    def meet(group):
        import pyarrow as pa

        parts = [unpacked(x.as_buffer(), kind) for x in group.column("prints")]
        prints = np.concatenate(parts)
        order = np.argsort(prints)
        ordered = prints[order]
        same = ordered[1:] == ordered[:-1]
        many = np.zeros(len(prints), dtype=bool)
        many[order[1:][same]] = True
        many[order[:-1][same]] = True
        masks, at = [], 0
        for p in parts:
            masks.append(np.packbits(many[at : at + len(p)]).tobytes())
            at += len(p)
        return pa.table({"bucket": group.column("bucket").cast(pa.int32()), "chunk_id": group.column("chunk_id").cast(pa.int64()), "n": pa.array([len(p) for p in parts], pa.int32()), "mask": pa.array(masks, pa.binary())})

    answers = sent.groupBy("bucket").applyInArrow(meet, "bucket int, chunk_id long, n int, mask binary")
    return answers.groupBy("chunk_id").agg(F.collect_list(F.struct("bucket", "n", "mask")).alias("answers"))


def _marks(hit: np.ndarray, n: int) -> np.ndarray:
    """Which of n bytes the strings that start at ``hit`` cover."""
    delta = np.bincount(hit, minlength=n + 1) - np.bincount(hit + LENGTH, minlength=n + 1)
    return np.cumsum(delta[:-1]) > 0


def _edges(gone: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs, alternating."""
    return np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))


def _joined(parts: DataFrame, folder: str, emit: bool, schema: str) -> DataFrame:
    """The parts of cut documents put together: runs that meet or overlap at a border become one."""

    def join(group):
        import pyarrow as pa

        files, _ = _file_system(folder)
        digest, n, removed, spans, kept = hashlib.sha256(), 0, 0, [], []
        rows = sorted(group.to_pylist(), key=lambda r: r["part"])
        carry = np.zeros(0, dtype=bool)  # marks of the part before on the bytes that both hold
        for k, row in enumerate(rows):
            data = np.frombuffer(_load(files, row), dtype=np.uint8)
            gone = np.zeros(len(data), dtype=bool)
            for a, b in zip(row["spans"][::2], row["spans"][1::2]):
                gone[a:b] = True
            gone[: len(carry)] |= carry
            own = len(data) if k + 1 == len(rows) else len(data) - (LENGTH - 1)
            gone, carry = gone[:own], gone[own:]
            for a, b in (_edges(gone).reshape(-1, 2) + n).tolist():
                if spans and spans[-1] == a:
                    spans[-1] = b
                else:
                    spans += [a, b]
            left = data[:own][~gone].tobytes()
            digest.update(left)
            n, removed = n + own, removed + int(gone.sum())
            if emit:
                kept.append(left)
        out = {"doc_id": pa.array([rows[0]["doc_id"]], pa.int64()), "n_bytes": pa.array([n], pa.int64()), "n_removed": pa.array([removed], pa.int64()), "n_spans": pa.array([len(spans) // 2], pa.int64()), "kept_sha256": [digest.hexdigest()]}
        if emit:
            out |= {"kept": pa.array([b"".join(kept)], pa.binary()), "spans": pa.array([spans], pa.list_(pa.int64()))}
        return pa.table(out)

    return parts.select("cut", "part", "path", "offset", "packed", "doc_id", "spans").groupBy("cut").applyInArrow(join, schema)


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", emit: bool = False) -> DataFrame:
    """Row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with emit, the kept bytes and the
    removed spans as [start, end) pairs."""
    import pyarrow as pa

    folder = new_path(docs.sparkSession, "suffix-chunks")
    chunks = table(write_chunks(docs, folder, id_col, text_col), "suffix-list")
    total, count, cut = chunks.agg(F.sum("n_bytes"), F.count(F.lit(1)), F.count("cut")).first()

    def width(entries: float) -> int:
        bits = LEAST_BITS
        while (1 << bits) * BUCKET < entries:
            bits += 1
        return bits

    sample_bits, suffix_bits = width((total or 0) * len(COVER) / PERIOD), width((total or 0) / 4)

    def each(run, kinds, names):
        def go(batches):
            files, _ = _file_system(folder)

            def rows():
                for batch in batches:
                    for k in range(batch.num_rows):
                        row = batch.slice(k, 1).to_pylist()[0]
                        yield from run(Chunk(_load(files, row), row["sizes"]), row)

            yield from _batches(rows(), names, kinds, 1024)

        return go

    def sample(chunk: Chunk, row):
        yield from sample_entries(chunk, chunk.sampled(), sample_bits).rows(row["chunk_id"])

    def suffixes(chunk: Chunk, row) -> tuple[np.ndarray, Entries]:
        at = chunk.sampled()
        starts = chunk.reachable(at[sample_entries(chunk, at, sample_bits).tied(row["cover"])])
        return starts, full_entries(chunk, starts, suffix_bits)

    def suffix(chunk: Chunk, row):
        yield from suffixes(chunk, row)[1].rows(row["chunk_id"])

    def judge(chunk: Chunk, row):
        starts, entries = suffixes(chunk, row)
        gone = _marks(starts[entries.tied(row["full"])], len(chunk.bytes))
        for doc_id, a, b in zip(row["doc_ids"], chunk.starts.tolist(), chunk.ends.tolist()):
            edges, kept = _edges(gone[a:b]), chunk.bytes[a:b][~gone[a:b]].tobytes()
            spans = edges.tolist() if emit or row["cut"] is not None else []
            yield doc_id, b - a, int(gone[a:b].sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(), kept if emit else b"", spans, row["cut"], row["part"], row["path"], row["offset"], row["packed"]

    sent = [pa.int32(), pa.int64(), pa.binary()], ["bucket", "chunk_id", "prints"]
    # Chunks are few rows with much work each: they are dealt some to a task.
    dealt = lambda df: df.repartition(max(1, min(-(-count // 4), 100_000)), "chunk_id")
    places = chunks.select("chunk_id", "path", "offset", "packed", "doc_ids", "sizes", "cut", "part")
    cover = table(shared_prints(dealt(places).mapInArrow(each(sample, *sent), SENT), "u4"), "suffix-cover")
    covered = places.join(cover.withColumnRenamed("answers", "cover"), "chunk_id", "left")
    full = table(shared_prints(dealt(covered).mapInArrow(each(suffix, *sent), SENT), "u8"), "suffix-full")
    last = dealt(covered.join(full.withColumnRenamed("answers", "full"), "chunk_id", "left"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<long>" * emit
    judged = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<long>, cut string, part int, path string, offset long, packed long"
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.list_(pa.int64()), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    rows = table(last.mapInArrow(each(judge, kinds, [x.split()[0] for x in judged.split(", ")]), judged), "suffix-judged")
    out = rows.filter("cut is null").select([x.split()[0] for x in schema.split(", ")])
    if cut:
        out = out.unionByName(table(_joined(rows.filter("cut is not null"), folder, emit, schema), "suffix-cut"))
    remove(docs.sparkSession, folder)
    for done in (chunks, cover, full):
        drop(done)
    return out
