"""Incremental ingestion of new files by Structured Streaming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.partitions import merge_partitions
from cairn.sources.readers import DEATH_RECORD, MIN_LENGTH, safe_read, slice_fields, valid_length, with_lineage


def committed(spark: SparkSession, ledger: str) -> set[int]:
    """The numbers of the batches that a ledger holds."""
    held = safe_read(spark, ledger, ["batch"])
    return set() if held is None else {r["batch"] for r in held.distinct().collect()}


def ingest_available(spark: SparkSession, folder: str, target: str, checkpoint: str, keys: Sequence[str], by: Mapping[str, Column], positions: dict = DEATH_RECORD, min_len: int = MIN_LENGTH) -> None:
    """Merge the records of files not seen before into ``target`` by key, then stop.

    The table is partitioned by the columns ``by``, computed from a record's key. A batch
    looks for its keys only in the partitions that it has records for, and adds a record
    per new key, the least of several; null keys match each other. Its number is written
    to a ledger beside the checkpoint afterwards: a batch that Spark replays is left out
    if the ledger holds it, and if the run broke off before, merging it again adds nothing.
    """
    lines = spark.readStream.schema("value string").text(folder).select("value", F.col("_metadata.file_name").alias("_file"))
    records = slice_fields(lines.where(valid_length("value", min_len)), positions, keep=["_file"])
    ledger = f"{checkpoint.rstrip('/')}-batches"

    def add(batch: DataFrame, number: int) -> None:
        if number in committed(spark, ledger):
            return
        counts = merge_partitions(spark, target, with_lineage(batch).withColumns(dict(by)), keys, list(by))
        total = counts.agg(F.coalesce(F.sum("inserted"), F.lit(0)).alias("inserted"), F.coalesce(F.sum("ignored"), F.lit(0)).alias("ignored"))
        total.select(F.lit(number).cast("long").alias("batch"), "inserted", "ignored").write.mode("append").parquet(ledger)

    records.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
