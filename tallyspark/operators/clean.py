"""Clean-up steps applied to detail files before they are loaded.

* ``posting_preagg``: duplicate postings are summed per table key; rows with a
  NULL key are dropped and an all-NULL sum becomes 0 (the load's rules), but in
  exact decimals instead of floats.  Partial aggregation runs map-side, so a
  hot key is collapsed before the shuffle.
* ``rate_dedupe``: whole-row distinct.
* ``clean_ledger``: blank text instead of NULL in string columns only (a blank
  in an integer or date column stays NULL), and the float ``pair_account``
  printed as an integer text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.money import checked, checked_sum
from tallyspark.schemas import KEYS


def posting_preagg(raw: DataFrame, keys: list[str] | None = None, amounts: list[str] | None = None) -> DataFrame:
    keys = keys or KEYS["ft_posting_f"]
    amounts = amounts or [c for c in raw.columns if c not in keys]
    aggs = []
    for c in amounts:
        t = raw.schema[c].dataType
        # The stored column keeps the detail money type.
        target = T.DecimalType(15, 2) if isinstance(t, T.DecimalType) else t
        total = F.coalesce(checked_sum(F.col(c)), F.lit(0)) if isinstance(t, T.DecimalType) else F.coalesce(F.sum(c), F.lit(0))
        aggs.append(checked(total, target).alias(c))
    return raw.dropna(subset=keys).groupBy(*keys).agg(*aggs)


def rate_dedupe(raw: DataFrame) -> DataFrame:
    return raw.dropDuplicates()


def int_text(c: F.Column) -> F.Column:
    """Float -> integer text, truncating toward zero as Python ``int()`` does."""
    return c.cast("bigint").cast("string")


def clean_ledger(raw: DataFrame, pair_column: str = "pair_account") -> DataFrame:
    cols = []
    for f in raw.schema.fields:
        if f.name == pair_column:
            cols.append(F.coalesce(int_text(F.col(f.name)), F.lit("")).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.coalesce(F.col(f.name), F.lit("")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return raw.select(*cols)
