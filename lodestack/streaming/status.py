"""Status rows as a stream: the latest row per key and counts, over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, folder: str, schema, glob: str) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def latest(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Last write wins per key; state is one row a key (complete mode)."""
    rest = [c for c in stream.columns if c != key]
    return stream.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row")).select(key, "row.*")


def counts(stream: DataFrame, status: str) -> DataFrame:
    return stream.groupBy(F.coalesce(status, F.lit("")).alias(status)).agg(F.count(F.lit(1)).alias("n"))


def run_to_table(df: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Processes what is there and returns the result table; for tests and the driver's batch comparison."""
    query = df.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)


def windowed_counts(stream: DataFrame, ts: str, late: str, width: str, status: str) -> DataFrame:
    """Counts in event-time windows with a watermark: an addition, the reference workload has no late data."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), status).agg(F.count(F.lit(1)).alias("n"))
