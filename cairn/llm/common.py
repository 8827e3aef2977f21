"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources.scratch import shuffles_removed

#: A table of at most so many bytes, as written, may be broadcast.
BROADCAST_BYTES = 24 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    and Spark runs in one local process is a folder of our own used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: work before it is not repeated when an executor is
    lost, and several consumers read the table instead of the plan behind it.
    The shuffle files of that work are removed.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def _files(spark: SparkSession, path: str):
    """Hadoop's path and file system of a staged table."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later step reads; what was made from them must be written."""
    for t in tables:
        p, fs = _files(t.sparkSession, t.staged_path)
        fs.delete(p, True)


def write_file(path: str, blob: bytes, spark: SparkSession) -> str:
    """Write one file to the shared folder and return its path."""
    p, fs = _files(spark, path)
    out = fs.create(p)
    out.write(bytearray(blob))
    out.close()
    return path


def broadcast_if_small(table: DataFrame, most: int | None = None) -> DataFrame:
    """A staged table, marked for broadcast if its files have at most BROADCAST_BYTES (and ``most``); otherwise Spark shuffles."""
    p, fs = _files(table.sparkSession, table.staged_path)
    limit = BROADCAST_BYTES if most is None else min(most, BROADCAST_BYTES)
    return F.broadcast(table) if fs.getContentSummary(p).getLength() <= limit else table


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def small_batches(spark: SparkSession, rows: int = 512, size: str = "8m") -> None:
    """Hand texts to Python in batches that stay small even with long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
