"""Data checks re-aimed from the database constraints (primary keys, NOT NULL, varchar lengths).

Each check returns a DataFrame of findings (empty = clean); all are one pass
with map-side partial aggregation, so a hot key costs one row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def null_violations(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column: how many rows hold NULL there."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
        for c in columns])))


def length_violations(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """One row per column with a limit: how many values are longer than it."""
    present = {c: n for c, n in limits.items() if c in df.columns}
    counts = df.agg(*[F.count_if(F.length(F.col(c)) > n).alias(c) for c, n in present.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(n).alias("max_length"),
                 F.col(c).alias("n_too_long"))
        for c, n in present.items()])))


def constraint_findings(df: DataFrame, table: str, keys: list[str], not_null: list[str], limits: dict[str, int]) -> DataFrame:
    """All findings of a table from one scan: (table_name, rule, column_name, n_rows).

    ``key``: keys without NULL that occur more than once, under the names of the key columns; ``not null``: rows with NULL,
    for each key and NOT NULL column; ``length``: values over their limit.  Rows are grouped by key once, NULL and
    length counts ride along as sums, and a second aggregate with one row per task adds them up."""
    nulls = [c for c in [*keys, *not_null] if c in df.columns]
    long = {c: n for c, n in limits.items() if c in df.columns}
    flags = [F.count_if(F.col(c).isNull()) for c in nulls] + [F.count_if(F.length(c) > n) for c, n in long.items()]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[f.alias(f"_f{i}") for i, f in enumerate(flags)])
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    found = grouped.agg(F.count_if((F.col("_n") > 1) & whole).alias("_k"), *[F.coalesce(F.sum(f"_f{i}"), F.lit(0)).alias(f"_f{i}") for i in range(len(flags))])
    rules = [("key", ",".join(keys), "_k")] + [("not null", c, f"_f{i}") for i, c in enumerate(nulls)]
    rules += [("length", c, f"_f{i}") for i, c in enumerate(long, len(nulls))]
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(c).alias("column_name"), F.col(n).alias("n_rows"))
        for rule, c, n in rules])))


def enforced(df: DataFrame, table: str, not_null: list[str], limits: dict[str, int]) -> DataFrame:
    """``df`` itself, failing the job at a NULL in ``not_null`` or a text over its limit (a filter: never optimised away)."""
    fault = F.lit(None).cast("string")
    for c, n in limits.items():
        if c in df.columns:
            fault = F.when(F.length(c) > n, F.lit(f"{table}.{c} is longer than {n}")).otherwise(fault)
    for c in not_null:
        if c in df.columns:
            fault = F.when(F.col(c).isNull(), F.lit(f"{table}.{c} is NULL")).otherwise(fault)
    return df.filter(F.when(fault.isNotNull(), F.raise_error(fault).cast("boolean")).otherwise(F.lit(True)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
