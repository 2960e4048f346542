"""Decimal helpers.

Spark decimals are bounded (38 digits); products are kept exact by choosing
input precisions whose product fits: DECIMAL(19,2) x DECIMAL(18,6) is
DECIMAL(38,8) with no scale loss.  Results are cast to the mart type once,
after aggregation.  Casts and sums are checked: an overflow fails the job
instead of becoming NULL (or 0 behind a default) where ANSI mode is off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.schemas import AMOUNT, MART

# Digits of the widest decimal.
MAX_DIGITS = 38


def amount_for(rate: T.DecimalType) -> T.DecimalType:
    """Widest amount whose product with a rate of this type is exact: DECIMAL(19,2) for a DECIMAL(18,6)."""
    if rate.precision + 1 + AMOUNT.scale >= MAX_DIGITS:
        raise ValueError(f"no room for amounts beside a rate of {rate.simpleString()}")
    return T.DecimalType(MAX_DIGITS - 1 - rate.precision, AMOUNT.scale)


def checked(c: Column, kind: T.DataType) -> Column:
    """``c`` as ``kind``; a value that it cannot hold fails the job, with ANSI mode on or off."""
    error = F.raise_error(F.lit(f"a value is not a {kind.simpleString()}"))
    return F.coalesce(c.try_cast(kind), F.when(c.isNotNull(), error))


def checked_sum(c: Column) -> Column:
    """Sum that fails where it overflows, with ANSI mode on or off; NULL if there is nothing to sum."""
    return F.coalesce(F.sum(c), F.when(F.count(c) > 0, F.raise_error(F.lit("a sum of amounts overflows"))))


def to_mart(c: Column) -> Column:
    return checked(c, MART)


def zero_mart() -> Column:
    return F.lit(0).cast(MART)


def decimal_text(c: Column, scale: int) -> Column:
    """Plain decimal text with exactly ``scale`` fraction digits (``0.00000000``, never ``0E-8``).

    A cast to string prints small values in scientific form when ANSI mode is
    off; ``format_number`` at the column's own scale is exact (no rounding)
    in every mode, and only its thousands separators need removing.
    """
    return F.regexp_replace(F.format_number(c, scale), ",", "")
