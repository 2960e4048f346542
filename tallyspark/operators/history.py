"""Row-version import (SCD type 2 with an ``actuality`` flag).

For each incoming row in file order: when the current version of its key has
the same measures (compared at the stored scale, NULL as 0) the row is
skipped; otherwise the current version is closed (``actuality = false``) and
the row becomes the new current version.  Keys absent from the file are left
alone; one file may carry several versions of a key.

Set-based form, which windows the file only:

1. a row of the file is a change if its measures differ from those of the row
   before it in (key, file order); the first row of a key is one if they differ
   from the open version's, or there is none (a skipped row equals the state, so
   comparing with the previous row equals comparing with the state);
2. the last change of a key is its new current version;
3. an open version is closed if its key has a change.

Rows are windowed by (key, bucket of the file order), so a key with very many
versions is spread over many tasks; a table with one row per (key, bucket)
carries the last measures of a bucket into the next one, the key's last change
and the open version.  The file is read and shuffled once for all of this.  Of
the history only open versions are joined on the key; closed rows are carried
over untouched.  Text that does not parse is split off as a rejected row with a
``BAD ROW: <k0:k1:...>`` message and an error text cut to 250 characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.dates import naive_timestamp
from tallyspark.operators.sequence import BUCKET, DEFAULT_BUCKET, KEY, by_bucket

# Fixed value: length limit of the logged error text.
ERROR_TEXT_LIMIT = 250


def month_filter(months: DataFrame):
    """A function that keeps the rows whose ``from_date`` is one of ``months`` (one column; NULL equals NULL)."""
    side = months.select(F.col("from_date").alias("_month"))

    def keep(rows: DataFrame) -> DataFrame:
        return rows.join(side, F.col("from_date").eqNullSafe(F.col("_month")), "left_semi")
    return keep


def parse_measure(text: Column, type_name: str) -> Column:
    """Blank (or missing) -> 0, otherwise the parsed number; NULL when unparsable."""
    return (F.when(text.isNull() | (F.trim(text) == ""), F.lit(0).cast(type_name))
            .otherwise(text.try_cast(type_name)))


def key_text_column(key: str) -> str:
    """Column that holds the text a parsed key came from, where the caller keeps it."""
    return f"{key}_text"


def parse_incoming(incoming: DataFrame, measures: dict[str, str], text_columns: dict[str, str] | None = None
                   ) -> DataFrame:
    """Add parsed measure columns and a ``_bad`` column naming the first unparsable measure or key.

    A key is unparsable when it is NULL while its text column (``key_text_column``) is not."""
    text_columns = text_columns or {m: m for m in measures}
    out = incoming
    bad = F.lit(None).cast("string")
    for m in reversed(list(measures)):
        src = F.col(text_columns[m])
        out = out.withColumn(f"_p_{m}", parse_measure(src, measures[m]))
        bad = F.when(F.col(f"_p_{m}").isNull(), F.lit(m)).otherwise(bad)
    for k in reversed(incoming.columns):
        if key_text_column(k) in incoming.columns:
            bad = F.when(F.col(k).isNull() & F.col(key_text_column(k)).isNotNull(), F.lit(k)).otherwise(bad)
    return out.withColumn("_bad", bad)


def bad_rows(incoming: DataFrame, keys: list[str], measures: dict[str, str], target_name: str,
             text_columns: dict[str, str] | None = None, seq_col: str = "seq") -> DataFrame:
    """Rejected rows with the log message and the cut error text."""
    text_columns = text_columns or {m: m for m in measures}
    p = parse_incoming(incoming, measures, text_columns).filter(F.col("_bad").isNotNull())
    bad_text = F.lit(None).cast("string")
    for m in reversed(list(measures)):
        bad_text = F.when(F.col("_bad") == m, F.col(text_columns[m])).otherwise(bad_text)
    texts = {k: key_text_column(k) for k in keys if key_text_column(k) in incoming.columns}
    for k, text in texts.items():
        bad_text = F.when(F.col("_bad") == k, F.col(text)).otherwise(bad_text)
    key_text = F.concat_ws(":", *[F.coalesce(F.col(texts.get(k, k)).cast("string"), F.lit("")) for k in keys])
    kind = F.when(F.col("_bad").isin(list(texts)), F.lit("date")).otherwise(F.lit("number"))
    error = F.concat(F.lit(f"INSERT_ERROR: {target_name} - invalid "), kind, F.lit(" in "), F.col("_bad"), F.lit(": "),
                     F.coalesce(bad_text, F.lit("")))
    return p.select(*keys, seq_col,
                    F.concat(F.lit("BAD ROW: <"), key_text, F.lit(">")).alias("log_message"),
                    F.substring(error, 1, ERROR_TEXT_LIMIT).alias("error_text"))


def _version_scan(history: DataFrame, incoming: DataFrame, keys: list[str], measures: dict[str, str],
                  text_columns: dict[str, str] | None, seq_col: str, flag_col: str, bucket_width: int):
    """Shared scan: new versions (keys, measures, ``_seq``, flag) and the open versions of the history, their flag renewed."""
    names = list(measures)
    parsed = parse_incoming(incoming, measures, text_columns).filter(F.col("_bad").isNull())
    rows = by_bucket(parsed.select(*keys, F.col(seq_col).cast("bigint").alias("_seq"),
                                   F.struct(*[F.col(f"_p_{m}").alias(m) for m in names]).alias("_s")), keys, "_seq", bucket_width)
    local = (rows.select(KEY, BUCKET, "_seq", "_s")
             .withColumn("_lp", F.lag("_s").over(Window.partitionBy(KEY, BUCKET).orderBy("_seq"))))
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    # One row per (key, bucket).
    edges = local.groupBy(KEY, BUCKET).agg(
        F.min_by("_s", "_seq").alias("_first"), F.max_by("_s", "_seq").alias("_last"), F.min("_seq").alias("_from"),
        F.max(F.when(F.col("_lp").isNotNull() & differs("_lp", "_s"), F.col("_seq"))).alias("_changed"))
    in_order, whole = Window.partitionBy(KEY).orderBy(BUCKET), Window.partitionBy(KEY)
    edges = edges.withColumns({"_bp": F.lag("_last").over(in_order), "_head": F.min_by("_first", "_from").over(whole), "_start": F.min("_from").over(whole)})
    at_edge = F.when(F.col("_bp").isNotNull() & differs("_bp", "_first"), F.col("_from"))
    edges = edges.withColumn("_later", F.max(F.coalesce("_changed", at_edge)).over(whole))
    stored = history.filter(F.col(flag_col)).withColumn(KEY, F.struct(*keys))
    state = F.struct(*[F.coalesce(F.col(m).cast(measures[m]), F.lit(0).cast(measures[m])).alias(m) for m in names])
    edges = edges.join(stored.groupBy(KEY).agg(F.max(state).alias("_open")), KEY, "left")
    begins = F.col("_open").isNull() | differs("_open", "_head")
    edges = edges.select(KEY, BUCKET, "_bp", "_from", "_start", begins.alias("_begins"),
                         F.coalesce("_later", F.when(begins, F.col("_start"))).alias("_current"))
    seen = local.join(edges, [KEY, BUCKET]).withColumn("_prev", F.coalesce("_lp", "_bp"))
    kept = seen.filter(F.when(F.col("_prev").isNull(), F.col("_begins")).otherwise(differs("_prev", "_s")))
    new = kept.select(f"{KEY}.*", "_s.*", "_seq", (F.col("_seq") == F.col("_current")).alias(flag_col))
    # One row per key with a change.
    changed = edges.filter((F.col("_from") == F.col("_start")) & F.col("_current").isNotNull()).select(KEY, F.lit(True).alias("_closed"))
    open_rows = stored.join(changed, KEY, "left").withColumn(flag_col, F.col("_closed").isNull()).drop(KEY, "_closed")
    return new, open_rows


def _typed(measures: dict[str, str]) -> list[Column]:
    """Stored measures at their types."""
    return [F.col(m).cast(measures[m]).alias(m) for m in measures]


def versioned_import(history: DataFrame, incoming: DataFrame, keys: list[str], measures: dict[str, str],
                     insert_date, text_columns: dict[str, str] | None = None, seq_col: str = "seq",
                     date_col: str = "insert_date", flag_col: str = "actuality",
                     bucket_width: int = DEFAULT_BUCKET) -> DataFrame:
    """Next version of the history table after importing ``incoming`` (valid rows only)."""
    new, open_rows = _version_scan(history, incoming, keys, measures, text_columns, seq_col, flag_col, bucket_width)
    date = _date_literal(insert_date, history.schema[date_col].dataType).alias(date_col)
    closed = history.filter(~F.coalesce(F.col(flag_col), F.lit(False)))
    return (new.select(*keys, *measures, date, flag_col)
            .unionByName(open_rows.select(*keys, *_typed(measures), date_col, flag_col))
            .unionByName(closed.select(*keys, *_typed(measures), date_col, flag_col)))


def versioned_changes(history: DataFrame, incoming: DataFrame, keys: list[str], measures: dict[str, str],
                      insert_date, row_cols: tuple[str, str], load_id: int,
                      text_columns: dict[str, str] | None = None, seq_col: str = "seq",
                      date_col: str = "insert_date", flag_col: str = "actuality",
                      bucket_width: int = DEFAULT_BUCKET) -> DataFrame:
    """Only the rows an import changes, for an append-only history.

    ``row_cols`` = (creating load, file position) identify a history row.
    Returned: every new version (identity = ``load_id`` and its file position)
    and, for each open version the import closes, the same identity with
    ``actuality = false``.  The history's content is the latest record per
    identity, so appending these equals rewriting the table with
    ``versioned_import``.
    """
    rload, rseq = row_cols
    new, open_rows = _version_scan(history, incoming, keys, measures, text_columns, seq_col, flag_col, bucket_width)
    date = _date_literal(insert_date, history.schema[date_col].dataType).alias(date_col)
    own = [F.lit(load_id).cast("bigint").alias(rload), F.col("_seq").alias(rseq)]
    ended = open_rows.filter(~F.col(flag_col))
    return (new.select(*keys, *measures, date, flag_col, *own)
            .unionByName(ended.select(*keys, *_typed(measures), date_col, flag_col, F.col(rload).cast("bigint").alias(rload),
                                      F.col(rseq).cast("bigint").alias(rseq))))


def _date_literal(value, date_type) -> Column:
    """The import's date/time as a literal of the history column's type (zone-free for NTZ)."""
    if isinstance(date_type, T.TimestampNTZType):
        return naive_timestamp(value)
    return F.lit(value).cast(date_type)


def current_versions(history: DataFrame, flag_col: str = "actuality") -> DataFrame:
    return history.filter(F.col(flag_col))
