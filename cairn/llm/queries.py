"""The queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binpack, bpe, lexical, lines, minhash, negatives, packing, pii, quality, suffix, tiff, vafile, warc
from .common import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 vectors with the largest integer inner product, for each query vector."""
    vectors = vafile.quantised(_table(spark, sf_dir, "embeddings"))
    return vafile.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    table = pii.with_candidates(docs, keep=["doc_id"])
    found = pii.with_spans(table, pii.fit(table))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii_base", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *(count(k) for k in pii.BASE), F.sha2(pii.joined(F.col("pii_base")), 256).alias("base_sha256"), pii.joined(F.col("pii_spans")).alias("spans"), F.size("pii_spans").cast("long").alias("n_spans"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    small_batches(spark, 4096)
    docs = _table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    lexicon = bpe.lexicon_file(docs, "text", path)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("ids").to_pylist(), b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return bpe.encode_and_decode(docs, "doc_id", "text", path, lexicon, digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back through the chunked record table."""
    small_batches(spark)
    typed = warc.with_record_types(_table(spark, sf_dir, "pages"), "page_id", "html", "url")
    back = warc.records(warc.read_chunks(warc.write_archives(typed)))
    return back.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of strings of 400 bytes that occur again."""
    small_batches(spark)
    return suffix.without_repeats(_table(spark, sf_dir, "documents"), length=400).drop("kept")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on shingles of four words."""
    small_batches(spark)
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def op7_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a one-page TIFF and read back, with features of the page."""
    small_batches(spark)
    media = tiff.to_tiff(_table(spark, sf_dir, "documents"), "doc_id", "text", predictor=2)
    return tiff.with_features(tiff.pages(media)).withColumnRenamed("id", "doc_id").drop("page")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that are similar to an earlier line of the corpus, as digests."""
    found = lines.without_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return found.select("doc_id", "n_lines_removed", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces packed into sequences of at most 2048 tokens."""
    small_batches(spark, 4096)
    packed = packing.pack(packing.pieces(_table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), 2048), 2048)
    return packed.withColumns({c: F.col(c).cast("long") for c in ("length", "offset")})


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from the labels outside the held-out part."""
    small_batches(spark)
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, keep=["doc_id"]).select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item by weighted terms."""
    small_batches(spark)
    return lexical.search(lexical.build(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"), k=20)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors, from all vectors with a label; every seventh row has a wrong one."""
    small_batches(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.labelled(_table(spark, sf_dir, "embeddings"), label=label), F.col("vec_id") % 100 == 0)


def op13_instruction_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of 2048 tokens, at most 256 segments each."""
    small_batches(spark, 4096)
    limits = binpack.Limits(tokens=2048, segments=256, loss=2048)
    table = binpack.pieces(_table(spark, sf_dir, "documents"), "doc_id", public_tokenizers.path("byte_bpe_50k.json"), text_col="text", limits=limits, end_id=1)
    return binpack.pack(table, limits)


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper, upper(sha1(h)) AS hex FROM p),
bits AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789ABCDEF', hex[i]) - 1), 4, '0')), 'string_agg', '') AS b FROM k)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda j:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST(list_sum(list_transform(range(1, 6), lambda i: CAST(b[5 * j + i] AS INTEGER) * CAST(pow(2, 5 - i) AS INTEGER))) AS INTEGER)]), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM bits
"""

OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
t AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
m AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM n, t),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, t GROUP BY term, docs),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
r AS (SELECT item_id, term, count(*) AS r FROM i GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM r JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20
"""

OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.e) = len(c.e)),
g AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM g JOIN p USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_top_k": op1_top_k, "op2_pii": op2_pii, "op3_bpe": op3_bpe, "op4_warc": op4_warc, "op5_repeats": op5_repeats, "op6_minhash": op6_minhash, "op7_tiff": op7_tiff, "op8_lines": op8_lines, "op9_packing": op9_packing, "op10_quality": op10_quality, "op11_lexical": op11_lexical, "op12_negatives": op12_negatives, "op13_instruction_packing": op13_instruction_packing}


def oracle_sql() -> dict[str, str]:
    return {"op1_top_k": OP1_SQL, "op4_warc": OP4_SQL, "op11_lexical": OP11_SQL, "op12_negatives": OP12_SQL}
