"""File catalogs, tolerant readers and status sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCLIST = "applicationNumber string, documentId string, date string, title string, phase string, pages string"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_csv(spark: SparkSession, path: str, schema: str = DOCLIST) -> DataFrame:
    """CSV with header; a missing file is an empty table, a byte order mark is ignored, all columns are strings."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", True).csv(path)


def from_windows(content):
    """Windows-1252 by way of ISO-8859-1, whose control range 0x80 to 0x9F holds letters and signs there."""
    c1 = range(0x80, 0xA0)
    signs = "".join(bytes([i]).decode("cp1252", "replace") for i in c1)
    return F.translate(F.decode(content, "ISO-8859-1"), "".join(map(chr, c1)), signs)


def read_text(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """path, text of whole files: UTF-8 where valid, else Windows-1252."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    utf8 = F.try_validate_utf8(F.col("content").cast("string"))
    text = F.regexp_replace(F.coalesce(utf8, from_windows(F.col("content"))), "^﻿", "")
    return raw.select("path", (F.substring(text, 1, most) if most else text).alias("text"))


def catalog(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, name, length, modificationTime of all files below; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")


def read_manifest(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Records of {metadata, stats, records}; missing or malformed files give no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], record)
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.from_json("value", f"struct<records: array<struct<{_colon(record)}>>>").alias("m"))
    return parsed.select(F.inline("m.records"))


def _colon(schema: str) -> str:
    return ", ".join(f"{c.split(' ', 1)[0]}: {c.split(' ', 1)[1]}" for c in schema.split(", "))


def write_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One file with header, in order if given."""
    (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def valid_pdf(content, strict: bool = False):
    """First bytes %PDF, or %PDF- where strict."""
    head = b"%PDF-" if strict else b"%PDF"
    return F.substring(content, 1, len(head)) == F.lit(head)
