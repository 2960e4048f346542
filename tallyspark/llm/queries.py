"""Registered queries of the corpus operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import bpe, collocations, hard_negatives, langid, license_scan, mixing, paragraph_dedup, pstable_lsh, quality_mcd, secret_scan, setsketch, suffix_dedup, warc
from tallyspark.llm.shared import table
from tallyspark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    out = bpe.decode(ids.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids"))
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op2_paragraph_dedup")
def op2_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.passages(table(spark, sf_dir, "documents"))


@query("op3_pstable_lsh")
def op3_pstable_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable_lsh.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op4_setsketch")
def op4_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.classes(table(spark, sf_dir, "documents"), n=2, percent=80).drop("node")


@query("op5_mixing", r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
classed AS (
  SELECT *, CASE WHEN size < 16 THEN size
       ELSE (length(bin(size)) - 4) * 8 + (size >> CAST(length(bin(size)) - 4 AS INTEGER)) END AS class FROM sized),
per AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
         CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2 * source_size / weight AS ratio,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM per
  WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT source, source_size, CASE WHEN level >= ratio THEN 2 * source_size
         ELSE (SELECT arg_min(level, ratio) FROM levels WHERE level < ratio) * weight END AS target
  FROM levels),
ranked AS (
  SELECT c.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS step,
         CAST(row_number() OVER (PARTITION BY c.source ORDER BY class, md5(CAST(doc_id AS VARCHAR)), size) - 1 AS DOUBLE) AS r,
         CAST(CAST('0x' || substr(md5('mix-1:' || c.source), 1, 5) AS BIGINT) AS DOUBLE) / 1048576 AS u
  FROM classed c JOIN goal g ON c.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(least(floor((r + 1) * step + u) - floor(r * step + u), 2) AS BIGINT) * size AS taken
FROM ranked""")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_counts(table(spark, sf_dir, "documents"))
    return out.selectExpr("doc_id", "size", "source_size", "target", "copies * size AS taken")


@query("op6_langid")
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = langid.fold(F.col("doc_id"))
    model = langid.train(docs, fold != 1)
    out = langid.detect(docs.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "text"), model)
    return out.drop("text")


@query("op7_license_scan", license_scan.oracle())
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "sentence_ids", F.array_join("licences", ",").alias("licences"))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_chars", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


@query("op9_quality_mcd")
def op9_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mcd.assess(table(spark, sf_dir, "documents")).drop("distance2")


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                      F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query("op11_collocations", collocations.oracle())
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_hard_negatives", r"""
WITH kept AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY score DESC, vec_id) <= 3""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


@query("op13_warc", r"""
WITH sized AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digested AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS digest, payload FROM sized),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM digested),
-- 40 hexadecimal digits as 32 characters of five bits each
coded AS (
  SELECT *, list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST(('0x' || substr(digest || '00', 1 + CAST(floor(i * 5 / 4) AS INTEGER), 3)) AS BIGINT) >> (7 - (i * 5) % 4)) & 31 AS INTEGER), 1)),
           lambda x, y: x || y) AS payload_digest FROM firsts)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM coded""")
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.register(spark)
    warc.archive_pages(pages, path, "2024-01-01T00:00:00Z")
    return warc.read_pages(spark, path)
