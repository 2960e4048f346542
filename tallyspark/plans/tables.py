"""Table folders used by the file jobs: merge-on-read keyed tables.

Loads append their rows tagged with a load id and never overwrite what they
read; readers take the latest load per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.upsert import latest_per_key
from tallyspark.sinks import files as FS


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


# ---------------------------------------------------------------- merge-on-read keyed tables
#
# A keyed table that receives upserts is stored as the union of all loads,
# each row tagged with its load id; the table's content is the row of the
# latest load per key.  A load appends only its own rows (no rewrite of the
# table), and a reader's filter on a key column (e.g. one posting date) is
# pushed below the per-key aggregate and prunes partition folders.

LOAD_COL = "_load"


def new_load_id(spark: SparkSession, root: str, tables: list[str]) -> int:
    """A load id above every stored one: the clock (microseconds since the epoch, UTC) unless that has fallen back.

    Loads are folders (``_load=<id>``), so stored ids come from a listing; no data file is opened."""
    now = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1_000_000)
    for table in tables:
        path = table_path(root, table)
        names = FS.folder_names(spark, path) if FS.exists(spark, path) else []
        now = max([now, *(int(n.partition("=")[2]) + 1 for n in names if n.startswith(f"{LOAD_COL}="))])
    return now


def stored_rows(spark: SparkSession, root: str, table: str, schema=None) -> DataFrame | None:
    """All stored records of a table, or None before its first load."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(table_path(root, table))
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def append_load(df: DataFrame, root: str, table: str, load_id: int, partition_by: list[str] | None = None) -> int:
    """Append the rows of a load in a folder of its own, below it by ``partition_by``."""
    out = df.withColumn(LOAD_COL, F.lit(load_id).cast("bigint"))
    if partition_by:
        # Few files per folder; AQE still splits a folder holding a hot date.
        out = out.hint("rebalance", *partition_by)
    out.write.mode("append").partitionBy(LOAD_COL, *(partition_by or [])).parquet(table_path(root, table))
    return load_id


def read_latest(spark: SparkSession, root: str, table: str, keys: list[str], schema=None, where=None, null_keys: bool = True
                ) -> DataFrame | None:
    """Current rows of a merge-on-read table (latest load per key; NULL-key rows all kept, or none without ``null_keys``).

    A load holds a key once, so a key has as many records as loads sent it: rows are shuffled as they are, without a
    partial aggregate that would find nothing to combine.

    ``where`` filters the stored records before the per-key step; it must only
    test columns that are equal in every record of a key (so it selects whole
    keys), and on partition columns it prunes folders.
    """
    df = stored_rows(spark, root, table, _with_load(schema) if schema is not None else None)
    if df is None:
        return None
    if where is not None:
        df = df.filter(where)
    cols = schema.names if schema is not None else [c for c in df.columns if c != LOAD_COL]
    return latest_per_key(df, keys, LOAD_COL, null_keys, combine=False).select(*cols)


def _with_load(schema):
    return T.StructType(list(schema.fields) + [T.StructField(LOAD_COL, T.LongType(), True)])
