"""Date expressions: month bounds, validity intervals, date-text checks.

All bounds stay in DATE; the reference's timestamp round trip is exact at
midnight, so no timestamp arithmetic is needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = "str | dt.date | Column"

# Fixed value: accepted shape of a date text (digits only, no range check).
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"


def as_date(d) -> dt.date:
    """Driver-side parse of a date parameter (``YYYY-MM-DD`` text or date)."""
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def date_col(d) -> Column:
    """A DATE column for a parameter: literal for a Python value, as-is for a Column."""
    if isinstance(d, Column):
        return d
    return F.lit(as_date(d))


def month_start(d) -> Column:
    return F.trunc(date_col(d), "MM")


def month_end(d) -> Column:
    return F.last_day(date_col(d))


def prev_month_end(d) -> Column:
    return F.date_sub(month_start(d), 1)


# Driver-side twins used to build literals (so the optimizer sees constants and
# can push them into scans and partition filters).
def month_bounds_py(d) -> tuple[dt.date, dt.date]:
    d = as_date(d)
    start = d.replace(day=1)
    nxt = (start.replace(year=start.year + 1, month=1) if start.month == 12
           else start.replace(month=start.month + 1))
    return start, nxt - dt.timedelta(days=1)


def prev_month_end_py(d) -> dt.date:
    return month_bounds_py(d)[0] - dt.timedelta(days=1)


def valid_on(d, start: str | Column, end: str | Column) -> Column:
    """``d BETWEEN start AND end`` (both inclusive; a NULL bound drops the row)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return date_col(d).between(s, e)


def date_shape_ok(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return c.rlike(DATE_SHAPE)


def parse_date(text: str | Column) -> Column:
    """Real calendar date or NULL (``2018-13-45`` passes the shape, not this)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_date(c, "yyyy-MM-dd")


def naive_timestamp(value) -> Column:
    """A TIMESTAMP_NTZ literal for a Python date/datetime, independent of any time zone.

    ``lit(datetime)`` would build a zone-aware timestamp (shifted by the
    session zone when cast); going through the text keeps the wall-clock value.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


# ---------------------------------------------------------------- dyadic days

# Days are counted from 0001-01-01, so that every date of the calendar (up to 9999-12-31) has a number below 2**22.
EPOCH_SHIFT = 719162
LEVELS = 23


def day_number(d: Column) -> Column:
    return F.unix_date(d) + F.lit(EPOCH_SHIFT)


def dyadic_cover(start: Column, end: Column) -> Column:
    """The interval [start, end] as disjoint dyadic ranges: array of (level, bin), ``bin`` = day >> level.

    At most two ranges a level, so 44 for any interval, one day or open to year 9999; none if a bound is NULL or
    start lies after end.  A day lies in the interval exactly if one of its ``dyadic_path`` ranges is in the cover."""
    lo, hi = day_number(start), day_number(end) + F.lit(1)

    def at(level: Column) -> Column:
        # First whole range from lo on, and the first one that is not whole before hi.
        a, b = -_shifted(-lo, level), _shifted(hi, level)
        take = lambda odd, value: F.when((a < b) & (odd % 2 == 1), F.struct(level.cast("int").alias("level"), value.cast("int").alias("bin")))
        return F.array(take(a, a), take(b, b - 1))
    ranges = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), at))
    return F.filter(ranges, lambda r: r.isNotNull())


def dyadic_path(day: Column) -> Column:
    """Every dyadic range that holds the day: array of (level, bin), one for each level."""
    number = day_number(day)
    return F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)),
                       lambda level: F.struct(level.cast("int").alias("level"), _shifted(number, level).cast("int").alias("bin")))


def _shifted(n: Column, level: Column) -> Column:
    """``n`` divided by 2**level, rounded down."""
    return F.call_function("shiftright", n, level)
