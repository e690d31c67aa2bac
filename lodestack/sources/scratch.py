"""Shared folder for tables that every executor reads, and its files by Arrow.

It is the one that ``spark.checkpoint.dir`` names; only where that is unset (tests, a laptop) a folder under the system's temporary
directory is set. Paths are fresh, so a lost executor's tasks read again what is written and nothing is overwritten.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def new_path(spark: SparkSession, name: str) -> str:
    """URI of a fresh path."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        where = "file://" + os.path.join(tempfile.gettempdir(), "lodestack-shared")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def opened(uri: str):
    """Arrow file system and path of a URI; Hadoop writes local ones with one slash, bare paths are local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:/", "file:///", 1))
