"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words of ``text``; a null text has none.

    Texts whose only white space is blanks and line feeds, nearly all, take the split by one character."""
    text = F.coalesce(text, F.lit(""))
    other = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in "\t\x0b\f\r"])
    plain = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")
    return F.array_remove(F.when(other, F.split(text, GAP)).otherwise(plain), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete the folders of ``written`` tables that no later step reads."""
    for df in tables:
        removed(df.sparkSession, df.folder)


def removed(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that no later step reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def cleaned_shuffles(spark: SparkSession):
    """Inside, the shuffle files of a job go when it has ended: for steps that each write their result."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def reach_workers(spark: SparkSession) -> None:
    """Python workers that start from now on find this package where the driver does."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer form of it that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
