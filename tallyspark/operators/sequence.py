"""Previous / next row of the same key, without putting a whole key in one task.

``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to one task;
a key holding a large share of the rows makes that task do most of the work.
Here rows are windowed by (key, seq div B): a group holds at most B rows
(``seq`` values are distinct integers), so a hot key is spread over many
tasks.  ``lag``/``lead`` inside a bucket give the neighbours; the first and
last row of each bucket take their neighbour from the adjacent non-empty
bucket of the same key, found on a table with one row per (key, bucket).

The key is carried as one struct column (``_kk``): a struct is never NULL
itself, so plain equality on it is null-safe, and the window, the per-bucket
edge table and the edge join all use the same (``_kk``, ``_b``) hash
partitioning; only the small edge table moves.  Edges are taken from the
window's own output and ask for the columns that the rows have, so both read
one shuffle and the input is derived once.

Everything is a deterministic function of the data (no sampling, no
partition ids), so re-running a lost task gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET = 1 << 20
KEY = "_kk"
BUCKET = "_b"


def by_bucket(df: DataFrame, keys: list[str], seq_col: str, bucket_width: int = DEFAULT_BUCKET) -> DataFrame:
    """``df`` with the key as one struct and the bucket of its sequence number."""
    return df.withColumns({KEY: F.struct(*[F.col(k) for k in keys]), BUCKET: F.floor(F.col(seq_col) / F.lit(bucket_width)).cast("bigint")})


def neighbours_in_key(df: DataFrame, keys: list[str], seq_col: str, value_cols: list[str],
                      prev_col: str | None = "_prev", next_col: str | None = "_next",
                      bucket_width: int = DEFAULT_BUCKET) -> DataFrame:
    """Add ``prev_col`` / ``next_col``: struct of ``value_cols`` of the previous / next row of the
    same key in ``seq_col`` order (NULL for the first / last row of the key).

    ``seq_col`` must be an integer column, distinct within a key.  NULL keys
    form one key (null-safe grouping).
    """
    value = F.struct(*[F.col(c) for c in value_cols])
    grouped = by_bucket(df, keys, seq_col, bucket_width)
    w = Window.partitionBy(KEY, BUCKET).orderBy(seq_col)
    local = grouped.withColumns({"_lp": F.lag(value).over(w), "_ln": F.lead(value).over(w)})
    # One row per (key, bucket); the hash asks for all columns, so both sides share the shuffle below the window.
    edges = local.groupBy(KEY, BUCKET).agg(F.min_by(value, seq_col).alias("_first"), F.max_by(value, seq_col).alias("_last"),
                                           F.max(F.hash(*df.columns)).alias("_all"))
    ew = Window.partitionBy(KEY).orderBy(BUCKET)
    edges = edges.select(KEY, BUCKET, F.lag("_last").over(ew).alias("_bp"), F.lead("_first").over(ew).alias("_bn"), "_all").filter("_all IS NOT NULL")
    out = local.join(edges.drop("_all"), [KEY, BUCKET])
    if prev_col:
        out = out.withColumn(prev_col, F.coalesce("_lp", "_bp"))
    if next_col:
        out = out.withColumn(next_col, F.coalesce("_ln", "_bn"))
    return out.drop(KEY, BUCKET, "_lp", "_ln", "_bp", "_bn")
