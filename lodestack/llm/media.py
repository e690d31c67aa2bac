"""Media columns: bytes kept as lossless WebP files in a binary column, with features of the decoded pixels.

Narrow per-row work in Arrow batches: no shuffle; a batch holds one text of any length at a time beside its
output. Cases: a null is stored as an empty text (one row of zero samples); texts over 1 MiB become several
images one after the other; equal texts give equal bytes; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import webp

#: Images are read together until their texts are so many or have so many bytes.
READ_ROWS, READ_BYTES = 4_000, 16 << 20
STORED = "doc_id long, n_bytes long, media binary"
DESCRIBED = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width int, height int"


def to_payload(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % webp.ROW if data else webp.ROW)


def feature(payload: bytes) -> str:
    """Means of the four channels and a 16-bin histogram of all samples, per mille."""
    samples = np.frombuffer(payload, dtype=np.uint8)
    # Whole rows are summed, which takes less than pixels; the sums are exact.
    means = samples.reshape(-1, webp.ROW).sum(axis=0, dtype=np.int64).reshape(-1, 4).sum(axis=0) * 4 / len(samples)
    bins = np.bincount(samples >> 4, minlength=16) * 1000 // len(samples)
    return ",".join(f"{x:.3f}" for x in means) + ";" + ",".join(map(str, bins.tolist()))


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row per document: id, length of the text in UTF-8 and the WebP files."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            data = texts.to_pylist()
            sizes = [len(x) for x in data]
            media = webp.encode_many([to_payload(x) for x in data])
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("data")).mapInArrow(run, STORED)


def _gathered(batches):
    """Ids, sizes and media of several batches at a time: images are read in common steps, which cost the same for few as for many."""
    held, n_bytes = ([], [], []), 0
    for batch in batches:
        for column, more in zip(held, batch.columns):
            column += more.to_pylist()
        n_bytes += sum(batch.column(1).to_pylist())
        if len(held[0]) >= READ_ROWS or n_bytes >= READ_BYTES:
            yield held
            held, n_bytes = ([], [], []), 0
    if held[0]:
        yield held


def describe(stored: DataFrame) -> DataFrame:
    """Reads the stored bytes back: digests, the form's own digest, and features of the pixels."""

    def run(batches):
        import pyarrow as pa

        for ids, sizes, media in _gathered(batches):
            rows = []
            for doc_id, n_bytes, data, (payload, images) in zip(ids, sizes, media, webp.decode_many(media)):
                rows.append((doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-webp.ROW :]), len(data), hashlib.sha256(data).hexdigest(), feature(payload), images[0].shape[1], sum(x.shape[0] for x in images)))
            names = [x.split()[0] for x in DESCRIBED.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32()]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, DESCRIBED)
