"""Readers for the driver's synthetic parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Table names of the generated test data.
BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class BaseTables:
    """Lazy accessor: ``BaseTables(spark, dir).lineitem`` is a parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in BASE_TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)
