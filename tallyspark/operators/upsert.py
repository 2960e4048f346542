"""Keyed upsert and per-key row selection.

``keyed_upsert`` returns the next version of a table: rows of the target whose
key is not in the incoming data, plus every incoming row cast to the target's
column types (an ``INSERT ... ON CONFLICT DO UPDATE`` of all incoming
columns).  Target columns that the incoming data lacks keep their old value
on a match.  NULL keys never match (SQL equality), so such rows are kept from
both sides.

Plan: the incoming rows are grouped on the key (a partial aggregate, so a hot
key is combined map-side) which both enforces uniqueness and hash-partitions
them on the key; the left-anti join with the target reuses that partitioning,
and when the incoming data is small Spark broadcasts its keys so the target is
streamed without a shuffle.
A duplicate key fails the job lazily through ``raise_error`` inside the same
job, so the check costs no extra pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _any_null(keys: list[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def _by_key(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with a column that keeps every row with a NULL key in a group of its own, and the grouping columns.

    One read and one shuffle serve both kinds of rows, and NULL keys spread over all tasks."""
    apart = F.when(_any_null(keys), F.monotonically_increasing_id())
    return df.withColumn("_apart", apart), [*keys, "_apart"]


def _unpacked(df: DataFrame, keys: list[str], others: list[str], columns: list[str]) -> DataFrame:
    return df.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*columns)


def unique_on(df: DataFrame, keys: list[str], what: str = "incoming") -> DataFrame:
    """``df`` itself, failing the job if a non-NULL key occurs twice (NULL-key rows pass through).

    One aggregate on the key: duplicates are found while the rows are being
    shuffled to their key's partition anyway.  The check is a filter, so it
    also runs when only the keys or a count are asked for.
    """
    others = [c for c in df.columns if c not in keys]
    rows, by = _by_key(df, keys)
    grouped = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(0).alias("_"), *others)).alias("_r"))
    msg = F.concat(F.lit(f"{what} rows are not unique on {keys}: "),
                   F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    checked = grouped.filter(F.when(F.col("_n") > 1, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))
    return _unpacked(checked, keys, others, df.columns)


def latest_per_key(df: DataFrame, keys: list[str], order_col: str, null_keys: bool = True, combine: bool = True) -> DataFrame:
    """The row with the greatest ``order_col`` per key (an aggregate: hot keys combine map-side).

    Rows with a NULL key are returned unchanged (they never match anything); without ``null_keys`` they are left out, and
    the result is partitioned on the keys.  Without ``combine`` plain rows are shuffled and aggregated after that: for
    keys that have a few rows each.
    """
    others = [c for c in df.columns if c not in keys]
    rows, by = _by_key(df, keys) if null_keys else (df.dropna(subset=keys), keys)
    if not combine:
        rows = rows.repartition(*by)
    best = rows.groupBy(*by).agg(F.max_by(F.struct(F.lit(0).alias("_"), *others), F.col(order_col)).alias("_r"))
    return _unpacked(best, keys, others, df.columns)


def keyed_upsert(target: DataFrame, incoming: DataFrame, keys: list[str], on_duplicate: str = "error",
                 order_col: str | None = None) -> DataFrame:
    """Next version of ``target`` after upserting ``incoming`` on ``keys``.

    ``on_duplicate``: ``'error'`` (default) fails the job when the incoming data
    holds a key twice; ``'last'`` keeps the row with the greatest ``order_col``.
    """
    if on_duplicate == "error":
        incoming = unique_on(incoming, keys)
    elif on_duplicate == "last":
        if order_col is None:
            raise ValueError("on_duplicate='last' needs order_col")
        incoming = latest_per_key(incoming, keys, order_col)
    else:
        raise ValueError(f"on_duplicate must be 'error' or 'last', not {on_duplicate!r}")
    cols = target.columns
    given = [c for c in cols if c in incoming.columns]
    missing = [c for c in cols if c not in incoming.columns]
    if not set(keys) <= set(given):
        raise ValueError(f"incoming data lacks key columns {sorted(set(keys) - set(given))}")
    inc = incoming.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in given])
    if missing:
        # Old values of the columns the file lacks, for matched keys only: the
        # semi-join streams the target past the (broadcastable) incoming keys.
        matched = target.select(*keys, *missing).join(inc.select(*keys), keys, "left_semi")
        inc = inc.join(matched, keys, "left")
    kept = target.join(inc.select(*keys), keys, "left_anti")
    return kept.unionByName(inc.select(*cols))
