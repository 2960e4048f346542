"""Audit log rows and the long-message log.

``audit_log`` maps a status word to the stored status and drops unknown ones.
``split_messages`` cuts each message into 4,000-character pieces (one row
each, message type 1) and numbers the rows consecutively in (message order,
piece) order without a single-partition window: messages, not pieces, are
numbered, inside buckets of about equally many messages, and shifted by the
pieces of all earlier buckets (a table with one row per bucket).  Bucket
bounds are quantiles of the first order column, so far outliers and gaps make
no large bucket.  The text is read once and cut last.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.dates import naive_timestamp

# Status words and the stored status they map to.
AUDIT_STATUS = {"begin": "BEGIN_LOADING", "error": "ERROR", "finish": "FINISH_LOADING", "inform": "INFORM_MESS"}
# Buckets of messages, and the accuracy of their bounds (ranks are right to 1 / ACCURACY of all rows).
BUCKETS = 1024
ACCURACY = 100_000
# Stored description limit and message piece size.
DESCRIPTION_LIMIT = 255
PIECE_SIZE = 4000
NOTICE = 1


def _status_map(status: Column) -> Column:
    out = F.lit(None).cast("string")
    for k in reversed(list(AUDIT_STATUS)):
        out = F.when(status == k, F.lit(AUDIT_STATUS[k])).otherwise(out)
    return out


def audit_log(messages: DataFrame, at=None, status_col: str = "status", text_col: str = "description") -> DataFrame:
    """``log_data`` rows: (date_and_time, status, description); unknown status writes nothing."""
    when = F.localtimestamp() if at is None else naive_timestamp(at)
    return (messages.select(when.alias("date_and_time"), _status_map(F.col(status_col)).alias("status"),
                            F.substring(F.col(text_col), 1, DESCRIPTION_LIMIT).alias("description"))
            .filter(F.col("status").isNotNull()))


def piece_count(text: Column, size: int = PIECE_SIZE) -> Column:
    """Number of pieces of a text: none of an empty or NULL one."""
    return F.coalesce(F.ceil(F.length(text) / F.lit(size)), F.lit(0)).cast("bigint")


def message_pieces(messages: DataFrame, text_col: str, size: int = PIECE_SIZE) -> DataFrame:
    """One row per piece: ``piece_no`` from 0, ``message`` = characters [piece_no*size+1, +size)."""
    n = piece_count(F.col(text_col), size).cast("int")
    pieces = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    exploded = messages.withColumn("piece_no", F.explode(pieces))
    start = F.col("piece_no") * F.lit(size) + F.lit(1)
    return exploded.withColumn("message", F.substr(F.col(text_col), start, F.lit(size))).drop(text_col)


def quantile_bounds(df: DataFrame, column: str, buckets: int = BUCKETS) -> list:
    """Distinct quantiles of a numeric or date column: at most ``buckets`` - 1 values, read from that column alone.

    They are taken before the numbering plan is made, so all its branches have the same buckets."""
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(F.col(column), shares, ACCURACY).alias("q")).first()["q"] if shares else None
    return sorted(set(found or []))


def bucket_of(value: Column, bounds: list) -> Column:
    """Number of ``bounds`` (sorted) that are not above the value, by bisection; NULL values come first, in bucket 0."""
    if not bounds:
        return F.lit(0)
    # One constant, not a literal for each bound.
    array = F.from_json(F.lit(json.dumps([str(b) for b in bounds])), F.lit("array<string>")).cast(f"array<{_kind(bounds[0])}>")
    steps = F.sequence(F.lit(len(bounds).bit_length() - 1), F.lit(0))

    def step(low: Column, i: Column) -> Column:
        probe = low + F.call_function("shiftleft", F.lit(1), i)
        return F.when((probe <= len(bounds)) & (F.get(array, probe - 1) <= value), probe).otherwise(low)
    return F.coalesce(F.aggregate(steps, F.lit(0), step), F.lit(0))


def _kind(value) -> str:
    return {int: "bigint", float: "double", dt.datetime: "timestamp", dt.date: "date"}.get(type(value), "decimal(38,18)")


def numbered(df: DataFrame, order_cols: list[str], weight: Column, id_col: str, start: int = 1, bounds: list | None = None) -> DataFrame:
    """Add ``id_col``: ``start`` plus the sum of ``weight`` over all earlier rows in ``order_cols`` order, fully distributed.

    The first order column must be numeric or a date, ``order_cols`` must identify rows uniquely.  Rows of one bucket
    are summed in one task; the bucket totals, one row each, are summed over.  Both read one shuffle of the rows, and
    nothing depends on partition ids or on sampling inside the plan, so a re-run task numbers the same rows the same way.
    """
    if bounds is None:
        bounds = quantile_bounds(df, order_cols[0])
    # ``weight`` is computed behind the shuffle, so both branches ask for the same columns and share it.
    dealt = df.withColumn("_b", bucket_of(F.col(order_cols[0]), bounds)).repartition("_b")
    within = Window.partitionBy("_b").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_w", weight.cast("bigint")).withColumn("_before", F.coalesce(F.sum("_w").over(within), F.lit(0)))
    # The hash asks for all columns, as the rows themselves do.
    totals = dealt.groupBy("_b").agg(F.sum(weight.cast("bigint")).alias("_n"), F.max(F.hash(*df.columns)).alias("_all"))
    offsets = totals.filter(F.col("_all").isNotNull()).select("_b", F.coalesce(
        F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (local.join(offsets, "_b").withColumn(id_col, F.col("_off") + F.col("_before") + F.lit(start))
            .drop("_b", "_w", "_before", "_off"))


def consecutive_ids(df: DataFrame, order_cols: list[str], id_col: str = "record_id", start: int = 1, bounds: list | None = None) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... in ``order_cols`` order, fully distributed."""
    return numbered(df, order_cols, F.lit(1), id_col, start, bounds)


def split_messages(messages: DataFrame, text_col: str, order_cols: list[str], first_id: int = 1,
                   message_type: int = NOTICE, size: int = PIECE_SIZE, bounds: list | None = None) -> DataFrame:
    """``lg_messages``-style rows: record_id, order columns, piece_no, message, message_type.

    A message's first id is that of its first piece; its text is cut when it has been numbered."""
    rows = numbered(messages.select(*order_cols, text_col), order_cols, piece_count(F.col(text_col), size), "_first", first_id, bounds)
    pieces = message_pieces(rows, text_col, size)
    return pieces.select((F.col("_first") + F.col("piece_no")).alias("record_id"), *order_cols, "piece_no", "message",
                         F.lit(message_type).alias("message_type"))
