"""Shared folder, lineage cuts and small helpers of the llm operators.

Intermediate tables go to the folder named by ``spark.checkpoint.dir`` so that every executor can read
them after another executor is lost. Only where that setting is missing (tests, a laptop) a folder under
the system's temporary directory is set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and \\t \\n \\v \\f \\r.
BLANK = " \t\n\x0b\x0c\r"
#: Largest size of a relation that is ever broadcast, by its counted rows and the widths of its columns.
BROADCAST_BYTES = 32 << 20
#: Arrow batches to and from Python workers end at this many rows or bytes, so that long texts come few at a time.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package also where the driver found it by sys.path alone, in bounded batches.

    Workers are told to give freed memory back: they stay when a task has ended, beside the next stage's ones."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
        env |= {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_ARENA_MAX": "2"}


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that all executors share."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        where = "file://" + os.path.join(tempfile.gettempdir(), "lodestack-shared")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop(df: DataFrame) -> None:
    """Delete the files of a DataFrame made by table() that no later plan reads."""
    files = df.inputFiles()
    if files:
        remove(df.sparkSession, files[0].rsplit("/", 1)[0])


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast hint where a narrow table is small by its counted rows; else the join stays a shuffle join.

    A row costs 40 bytes in a hashed relation, a fixed-width column 8 and a binary key or name 48."""
    n = df.count() if rows is None else rows
    width = 40 + sum(48 if f.dataType.typeName() in ("string", "binary") else 8 for f in df.schema)
    return F.broadcast(df) if n * width <= BROADCAST_BYTES else df


def stripped(text):
    """The text without any of the contracts' white space."""
    return F.translate(F.coalesce(text, F.lit("")), BLANK, "")


def slices_of(rows: int, width: int) -> int:
    """Number of equal slices so that a slice holds about ``width`` rows (a power of two)."""
    n = 1
    while n * width < rows:
        n *= 2
    return n


def fresh(df: DataFrame, name: str) -> str:
    """A column name that neither a column of df nor a longer name of it begins with."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = "_" + name
    return name
