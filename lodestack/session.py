"""Session builder with the settings the engine is tuned for."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

#: Arrow batches to Python workers end at this size, so that long texts come few at a time.
BATCH_BYTES = 4 << 20

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own master and shuffle width."""
    builder = SparkSession.builder.master(master).appName("lodestack").config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", memory)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package also where the driver found it by sys.path alone, in batches of bounded size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt over three tasks a core. Narrow tables lie in few splits, too few for work that is long for each row."""
    return rows.repartition(3 * rows.sparkSession.sparkContext.defaultParallelism)
