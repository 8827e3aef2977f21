"""A folder for files that steps hand to each other."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes a statement's shuffle files at its end, not only once the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names; in one local process without it, in the temp folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def written(df: DataFrame, tag: str) -> DataFrame:
    """The rows as a table in that folder: what reads them several times does the work before them once."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of files that no later step reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no later step reads; what was made from them must be written."""
    for t in tables:
        delete(t.sparkSession, t.written_path)
