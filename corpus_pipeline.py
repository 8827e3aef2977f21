"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read
again before the next stage. All but the last return the columns of ``documents``; other
columns of their input are dropped, whatever they are called. Rows may have nulls in any
column: a null text has no lines, is no near-duplicate, holds no personal data and is
one piece of one token; rows without an id take part like others. Equal rows (same id or
none, same text) are all kept but by the third stage, which keeps one of them. An empty
table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import lines, minhash, packing, pii, quality
from cairn.llm.common import discard, small_batches, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below 0.7 go; a null text is scored as an empty one."""
    small_batches(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, model, keep=COLUMNS).where("score >= 0.7").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first in the corpus stays; documents keep their other lines, and a null text stays null."""
    return _documents(lines.without_repeated_lines(docs.select(*COLUMNS)))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents (five words, similarity 0.8) the one with the smallest id stays, and one of equal rows."""
    small_batches(spark)
    return minhash.without_near_duplicates(docs.select(*COLUMNS), words=5, percent=80)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind in brackets; a null text stays null."""
    table = pii.with_candidates(docs, keep=COLUMNS)
    found = pii.with_spans(table, pii.fit(table))
    return _documents(found.withColumn("text", pii.redacted(F.col("text"), F.col("pii_spans"))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048 tokens; each row of docs has its own pieces, also a repeated one."""
    small_batches(spark)
    return packing.pack(packing.pieces(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), 2048), 2048)


STAGES = [("quality", classify), ("lines", dedup_lines), ("near-duplicates", dedup_documents), ("pii", redact), ("packing", pack)]

#: The stages learn models and pack sequences, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; a stage's table is deleted once the next one is written, but for the last, which the result reads."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
