"""Posting statistics for a date and the labelled text report built from them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.dates import DATE_SHAPE, as_date

# Labels of the five report lines, in output order (the
# inconsistent spelling is the report's own).
REPORT_LABELS = ["On date: ", "min credit >> ", "min debet >> ", "max_credit >> ", "max_debet >> "]
STAT_COLUMNS = ["oper_date", "min_credit", "min_debet", "max_credit", "max_debet"]


def posting_stats(postings: DataFrame, on_date) -> DataFrame:
    """Min / max credit and debit amounts of one date; no row when the date has no postings."""
    d = as_date(on_date)
    return (postings.filter(F.col("oper_date") == F.lit(d))
            .groupBy("oper_date")
            .agg(F.min("credit_amount").alias("min_credit"), F.min("debet_amount").alias("min_debet"),
                 F.max("credit_amount").alias("max_credit"), F.max("debet_amount").alias("max_debet")))


def posting_report(stats: DataFrame) -> DataFrame:
    """Five ``(line_no, line)`` rows per stats row; a NULL value prints as ``None``."""
    parts = []
    for i, (label, col) in enumerate(zip(REPORT_LABELS, STAT_COLUMNS), start=1):
        text = F.coalesce(F.col(col).cast("string"), F.lit("None"))
        parts.append(F.struct(F.lit(i).alias("line_no"), F.concat(F.lit(label), text).alias("line")))
    return stats.select("oper_date", F.inline(F.array(*parts)))


def report_file_name(on_date) -> str:
    return f"output_{as_date(on_date).isoformat()}.csv"


def write_posting_report(postings: DataFrame, folder: str, date_text: str) -> str | None:
    """Stats of the date written as the five-line text file ``output_{date}.csv``.

    No file when the date text does not have the ``YYYY-MM-DD`` shape or the
    date has no postings.
    """
    if not re.fullmatch(DATE_SHAPE, date_text or ""):
        return None
    try:
        on_date = as_date(date_text)
    except ValueError:
        return None
    lines = posting_report(posting_stats(postings, on_date))
    if not lines.take(1):
        return None
    path = f"{folder.rstrip('/')}/{report_file_name(on_date)}"
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)
    return path
