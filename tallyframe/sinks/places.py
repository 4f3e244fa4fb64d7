"""Folders for what a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str = "work") -> str:
    """A new folder below spark.checkpoint.dir; a temporary one of this machine only where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.gettempdir()}/tallyframe-work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
