"""The corpus pipeline: quality rules, near-dedup, secret scan, mixing, tokenising.

Each stage works on all that the one before kept, and its decisions take
effect; between stages the documents are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import bpe, mixing, quality_mcd, secret_scan, setsketch
from tallyspark.llm.shared import reach_workers, table, written

#: The fit of the quality rules, the forest and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_mcd.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates (five words, similarity 0.8)."""
    return setsketch.keep_first(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document of the mix."""
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"))
    return ids.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [("quality rules", quality), ("near-dedup", near_dedup), ("secret scan", secrets), ("mixing", mixed), ("BPE", tokenised)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
