"""Count by category, then lower-case the category and join a small dimension.

Counts are taken on the original spelling (``Judo`` and ``JUDO`` stay two
rows) and only then lower-cased, as in the reference.  The count is a partial
aggregate; the dimension join is left to Spark's size-checked broadcast
(static estimate or AQE's measured size), with a shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_counts(df: DataFrame, column: str = "Discipline") -> DataFrame:
    return df.groupBy(column).count().orderBy(F.desc("count"))


def category_join(counts: DataFrame, dimension: DataFrame, column: str = "Discipline",
                  key: str = "discipline") -> DataFrame:
    """Replace the category by its lower-case form (same column, case-insensitive name) and join."""
    lowered = counts.withColumn(key, F.lower(F.col(column)))
    return lowered.join(dimension, on=key, how="inner").select(key, "count")
