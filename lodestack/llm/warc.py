"""WARC archives with dictionary compression: a writer, a reader and the deduplicating archive operator.

Archive layout (the public .warc.zst form): one leading skippable frame (magic 0x184D2A5D) whose content is the
Zstandard dictionary, then one Zstandard frame per record. A record can therefore be read alone from its offset
once the archive's dictionary is known. The dictionary is trained from the archive's own first records
(at most ``SAMPLE_RECORDS`` of them, ``SAMPLE_BYTES`` in all); an archive too small to train one has an empty
dictionary frame and plain records.

The archives are written by the executors through the file system of the shared folder under a temporary name and then
renamed, so a retried task replaces its own file and no half-written archive is ever read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import new_path, small, table

DICTIONARY_MAGIC = 0x184D2A5D
SAMPLE_RECORDS = 256
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 32 << 10
ARCHIVE_BYTES = 64 << 20
LEAST = 100  # payloads below this are never revisits
LEVEL = 3


def header(lines: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def clean(value) -> str:
    """A header value on one line."""
    return " ".join(str(value or "").split())


def record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool) -> bytes:
    """One record; a revisit has an empty block and names the response it repeats."""
    block = b"" if is_revisit else payload
    lines = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Target-URI", clean(url)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", str(len(payload)))]
    if is_revisit:
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    return header(lines) + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    if not data.startswith(b"WARC/1."):
        raise ValueError("no WARC record")
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")[1:]
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    block = data[end + 4 : end + 4 + int(fields["Content-Length"])]
    if data[end + 4 + len(block) :] != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
        raise ValueError("a record is cut off")
    return fields, block


def train(samples: list[bytes]) -> bytes:
    import zstandard

    total = sum(map(len, samples))
    if len(samples) < 16 or total < 16 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 8), samples, k=256, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    """Writes records to a binary stream; holds back the first ones until the dictionary is trained."""

    def __init__(self, out):
        self.out, self.waiting, self.held, self.compressor, self.size = out, [], 0, None, 0

    def add(self, data: bytes) -> None:
        if self.compressor is None:
            self.waiting.append(data)
            self.held += len(data)
            if len(self.waiting) >= SAMPLE_RECORDS or self.held >= SAMPLE_BYTES:
                self._start()
        else:
            self._put(self.compressor.compress(data))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _start(self) -> None:
        import zstandard

        samples = [x[: SAMPLE_BYTES // 8] for x in self.waiting]
        words = train(samples)
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words)
        use = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_checksum=True, **use)
        for data in self.waiting:
            self._put(self.compressor.compress(data))
        self.waiting = []

    def close(self) -> None:
        if self.compressor is None:
            self._start()


def read_archive(stream, chunk: int = 1 << 20):
    """Records of an archive, one at a time: memory holds a chunk and a record."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    words = stream.read(size)
    use = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
    decompressor = zstandard.ZstdDecompressor(**use)
    rest = b""
    frame, parts = decompressor.decompressobj(), []
    while True:
        data = rest or stream.read(chunk)
        rest = b""
        if not data:
            break
        parts.append(frame.decompress(data))
        if frame.eof:
            yield parse(b"".join(parts))
            rest = frame.unused_data
            frame, parts = decompressor.decompressobj(), []
    if any(parts):
        raise ValueError("the archive is cut off")


def revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """digest, first_id for every payload of at least LEAST bytes that more than one record has.

    One pass over the payloads; only digests are shuffled, after partial aggregation, so a payload that a third
    of all records share is one row a task."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.filter(F.octet_length(payload) >= LEAST).select(F.sha2(payload, 256).alias("digest"), F.col(id_col).alias("id"))
    return rows.groupBy("digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first_id")


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> tuple[str, DataFrame]:
    """Archives all rows; returns the folder and a table (path, records) of its archives.

    The smallest id among equal payloads is the response (null ids after all others); rows that repeat that id with
    that payload are responses too. A null payload is empty, a null url an empty header."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    firsts = table(revisits(pages, id_col, html_col), "warc-firsts")
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.cast("binary").alias("payload"), F.sha2(payload, 256).alias("digest"))
    rows = rows.join(small(firsts), "digest", "left").select("id", "url", "payload", "digest", "first_id")
    _file_system(folder)[0].create_dir(_file_system(folder)[1], recursive=True)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        files, base = _file_system(folder)
        task, done, records, writer, out, name = TaskContext.get().partitionId(), [], 0, None, None, ""

        def finish():
            writer.close()
            out.close()
            final = f"{base}/part-{task:06d}-{len(done):04d}.warc.zst"
            files.move(name, final)
            done.append((final, records))

        for batch in batches:
            for id_, url, data, digest, first in zip(*batch.columns):
                if writer is None:
                    name = f"{base}/.{uuid.uuid4().hex}"
                    out, records = files.open_output_stream(name, compression=None), 0
                    writer = ArchiveWriter(out)
                id_, first = id_.as_py(), first.as_py()
                writer.add(record(id_, url.as_py(), data.as_py(), digest.as_py(), first, first is not None and first != id_))
                records += 1
                if writer.size >= ARCHIVE_BYTES:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["path", "records"])

    return folder, table(rows.mapInArrow(run, "path string, records long"), "warc-list")


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:/", "file:///", 1))


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Row per record of the archives, read back from the files; responses are checked against their digest."""

    def number(urn: str):
        digits = urn.strip("<>").removeprefix("urn:page:")
        return int(digits) if digits else None

    def run(batches):
        import pyarrow as pa

        files, _ = _file_system(folder)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = [x.split()[0] for x in READ.split(", ")]

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for fields, block in read_archive(stream):
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and (hashlib.sha256(block).hexdigest() != digest or len(block) != int(fields["WARC-Payload-Length"])):
                            raise ValueError(f"a payload in {path} is damaged")
                        refers = number(fields["WARC-Refers-To"]) if kind == "revisit" else None
                        rows.append((number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], int(fields["WARC-Payload-Length"]), digest, kind, refers, block if with_payload else None))
                        held += len(block) if with_payload else 0
                        if len(rows) >= 2000 or held > 16 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    # One task reads a few archives: they are dealt by path, not by size of content.
    n = max(1, min(archives.count(), 100_000))
    return archives.repartition(n, "path").select("path").mapInArrow(run, READ)
