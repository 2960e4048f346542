"""End-to-end jobs over files: load + calculate, export + versioned import, mirror.

These wire the operators the way the reference's scheduled tasks do, with
Spark reads and writes in place of database round trips.  Every step writes
new files; nothing is read and overwritten in one step.
"""

from __future__ import annotations

import datetime as dt
import threading
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas as S
from tallyspark.functions.dates import as_date, month_bounds_py
from tallyspark.operators import audit as AU
from tallyspark.operators import checks as CK
from tallyspark.operators import clean as CL
from tallyspark.operators import history as HI
from tallyspark.operators import mirror as MI
from tallyspark.operators import report as RP
from tallyspark.operators import turnover as TO
from tallyspark.operators import upsert as UP
from tallyspark.plans import tables as TB
from tallyspark.sinks import files as FS
from tallyspark.sources import csv as CSV

LOG_TABLE = "log_data"
MESSAGE_TABLE = "lg_messages"
RESERVE_TRIES = 1000
RESERVING = threading.Lock()


def _append_log(spark: SparkSession, root: str, status: str, text: str, at=None) -> None:
    msg = spark.createDataFrame([(status, text)], "status STRING, description STRING")
    AU.audit_log(msg, at=at).write.mode("append").parquet(f"{root.rstrip('/')}/{LOG_TABLE}")


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{LOG_TABLE}")


def read_messages(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/{MESSAGE_TABLE}").drop("call")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise


def reserve_ids(spark: SparkSession, root: str, n: int) -> int:
    """The first of ``n`` record ids of the message log that no other writer gets.

    A reservation is a small file named after its first id that holds the last one; two writers cannot make the same
    file, and the one that comes second goes on behind the other.  The log itself is not read."""
    folder = f"{root.rstrip('/')}/{MESSAGE_TABLE}_ids"
    for _ in range(RESERVE_TRIES):
        names = FS.file_names(spark, folder)
        held = FS.first_lines(spark, [f"{folder}/{max(names)}"])[0] if names else "0"
        # An empty file is being written.
        with RESERVING:
            won = held and FS.created(spark, f"{folder}/{int(held) + 1:020d}", str(int(held) + n))
        if won:
            return int(held) + 1
        if not held:
            time.sleep(0.05)
    raise RuntimeError(f"no record ids could be reserved in {folder}")


def writelog(spark: SparkSession, root: str, texts: list[str], message_type: int = AU.NOTICE) -> None:
    """Append messages to the message log: 4,000-character pieces, with consecutive ids behind those of earlier calls."""
    n = sum(-(-len(t or "") // AU.PIECE_SIZE) for t in texts)
    if not n:
        return
    first = reserve_ids(spark, root, n)
    msgs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "msg_no BIGINT, message_text STRING")
    pieces = AU.split_messages(msgs, "message_text", ["msg_no"], first_id=first, message_type=message_type, bounds=[])
    # A folder for each call: writers at the same time do not meet in one job folder.
    (pieces.select("record_id", F.localtimestamp().alias("date_time"), "message", "message_type")
     .write.parquet(f"{root.rstrip('/')}/{MESSAGE_TABLE}/call={first}"))


# ---------------------------------------------------------------- E-1: load detail files, then calculate

def clean_detail(table: str, df: DataFrame) -> DataFrame:
    if table == "ft_posting_f":
        return CL.posting_preagg(df)
    if table == "md_exchange_rate_d":
        return CL.rate_dedupe(df)
    if table == "md_ledger_account_s":
        return CL.clean_ledger(df)
    return df


# Fact-like tables are stored by date so a daily job reads one folder.
PARTITION_BY = {"ft_posting_f": ["oper_date"], "ft_balance_f": ["on_date"]}


def load_detail(spark: SparkSession, csv_folder: str, detail_root: str, log_root: str,
                date_format: str = "yyyy-MM-dd", partition_by: dict[str, list[str]] | None = None,
                tables: list[str] | None = None) -> dict[str, str]:
    """Load the detail files (all six, or the listed ones) as keyed upserts; a failing table is logged and the next one loads.

    Each load appends only the file's rows (merge-on-read): the table's
    current content is the latest load per key, so a load costs the size of
    the file, not of the table.
    """
    results = {}
    layout = PARTITION_BY if partition_by is None else partition_by
    files = [(t, s) for t, s in CSV.DETAIL_FILES if tables is None or t in tables]
    load_id = TB.new_load_id(spark, detail_root, [t for t, _ in files])
    for table, schema in files:
        _append_log(spark, log_root, "begin", f"Start loading table {table}")
        try:
            df = CSV.read_detail_csv(spark, f"{csv_folder.rstrip('/')}/{table}.csv", schema,
                                     date_format=date_format,
                                     ledger_pair_as_float=(table == "md_ledger_account_s"))
            df = _with_old_values(spark, clean_detail(table, df), detail_root, table, schema)
            # A duplicate key, a NULL or a text over its limit fails the write job, which is logged below.
            df = CK.enforced(UP.unique_on(df, S.KEYS[table], table), table, S.KEYS[table] + S.NOT_NULL.get(table, []),
                             S.MAX_LENGTH.get(table, {}))
            TB.append_load(df, detail_root, table, load_id, layout.get(table))
        except Exception as e:  # the table is skipped, the load goes on
            _append_log(spark, log_root, "error", _error_line(spark, log_root, table, e))
            results[table] = "error"
            continue
        _append_log(spark, log_root, "finish", f"Finish loading table {table}")
        results[table] = "ok"
    return results


def _with_old_values(spark: SparkSession, df: DataFrame, detail_root: str, table: str, schema: T.StructType) -> DataFrame:
    """``df`` with every column of the table; columns that the file lacks keep the stored value of the key."""
    lacking = [c for c in schema.names if c not in df.columns]
    keys = S.KEYS[table]
    if not set(keys) <= set(df.columns):
        raise ValueError(f"{table}: the file lacks key columns {sorted(set(keys) - set(df.columns))}")
    if lacking:
        # Only the columns that are needed; a NULL key matches nothing.
        part = T.StructType([f for f in schema.fields if f.name in keys or f.name in lacking])
        stored = TB.read_latest(spark, detail_root, table, keys, part, null_keys=False)
        if stored is None:
            df = df.withColumns({c: F.lit(None).cast(schema[c].dataType) for c in lacking})
        else:
            df = df.join(stored.select(*keys, *lacking), keys, "left")
    return df.select(*schema.names)


def _error_line(spark: SparkSession, log_root: str, what: str, e: Exception) -> str:
    """First line of an error for the load log; the whole text goes to the message log."""
    writelog(spark, log_root, [f"ERROR: {what} {e}"])
    return f"ERROR: {what} {str(e).splitlines()[0]}"[:255]


def detail_tables(spark: SparkSession, detail_root: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    return {t: TB.read_latest(spark, detail_root, t, S.KEYS[t], schema) for t, schema in CSV.DETAIL_FILES if tables is None or t in tables}


def fill_turnover(spark: SparkSession, detail: dict[str, DataFrame], mart_root: str, on_date,
                  log_root: str | None = None) -> int:
    """Replace one day of the turnover mart; returns the row count of the day."""
    d = as_date(on_date)
    if log_root:
        writelog(spark, log_root, [f"[BEGIN] fill(i_OnDate => date '{d.isoformat()}');",
                                   f"delete on_date = {d.isoformat()}", "insert"])
    obs = Observation(f"turnover_{d.isoformat()}")
    turn = TO.account_turnover(detail["ft_posting_f"], detail["md_account_d"], detail["md_exchange_rate_d"], d)
    FS.replace_partition(turn.observe(obs, F.count(F.lit(1)).alias("rows")),
                         f"{mart_root.rstrip('/')}/dm_account_turnover_f", {"on_date": d})
    n = int(obs.get["rows"])
    if log_root:
        writelog(spark, log_root, [f"[END] inserted {n} rows."])
    return n


def _existing_days(spark: SparkSession, root: str, schema, column: str, a, b) -> set:
    """Partition values of ``column`` already stored in [a, b] (bounded by the range length)."""
    try:
        stored = FS.read_partitioned(spark, root, schema)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return set()
        raise
    days = stored.filter(F.col(column).between(F.lit(a), F.lit(b))).select(column).distinct()
    return {r[0] for r in days.collect()}


def fill_turnover_range(spark: SparkSession, detail: dict[str, DataFrame], mart_root: str, first_day, last_day,
                        log_root: str | None = None) -> dict:
    """Replace every day of [first_day, last_day] in the turnover mart with one computation.

    The days with rows are written in one job and then exchanged one by one;
    stored days of the range that now come out empty are cleared (as the
    one-day job clears an empty day).
    """
    a, b = as_date(first_day), as_date(last_day)
    root = f"{mart_root.rstrip('/')}/dm_account_turnover_f"
    stored = _existing_days(spark, root, S.DM_ACCOUNT_TURNOVER_F, "on_date", a, b)
    turn = TO.account_turnover_range(detail["ft_posting_f"], detail["md_account_d"], detail["md_exchange_rate_d"],
                                     a, b)
    obs = Observation(f"turnover_{a.isoformat()}_{b.isoformat()}")
    written = {as_date(d) for d in FS.replace_partitions(turn.observe(obs, F.count(F.lit(1)).alias("rows")), root, "on_date", sorted(stored))}
    cleared = sorted(stored - written)
    n = int(obs.get["rows"])
    if log_root:
        writelog(spark, log_root, [f"[END] inserted {n} rows for {a.isoformat()} .. {b.isoformat()}."])
    return {"rows": n, "days_with_rows": len(written), "days_cleared": len(cleared)}


def fill_report(spark: SparkSession, detail: dict[str, DataFrame], mart_root: str, on_date,
                log_root: str | None = None) -> int:
    """Replace the month of ``on_date`` in the report mart (reads the turnover mart)."""
    d = as_date(on_date)
    ms, me = month_bounds_py(d)
    if log_root:
        writelog(spark, log_root, [f"[BEGIN] fill(i_OnDate => date '{d.isoformat()}');",
                                   f"delete on_date = {d.isoformat()}", "insert"])
    try:
        turn = FS.read_partitioned(spark, f"{mart_root.rstrip('/')}/dm_account_turnover_f", S.DM_ACCOUNT_TURNOVER_F)
    except Exception as e:  # no turnover stored yet: opening balances only
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        turn = spark.createDataFrame([], S.DM_ACCOUNT_TURNOVER_F)
    rep = RP.ledger_report(detail["md_account_d"], detail["md_currency_d"], detail["md_ledger_account_s"],
                           detail["ft_balance_f"], detail["md_exchange_rate_d"], turn, d)
    obs = Observation(f"report_{d.isoformat()}")
    FS.replace_partition(rep.observe(obs, F.count(F.lit(1)).alias("rows")),
                         f"{mart_root.rstrip('/')}/dm_f101_round_f", {"from_date": ms, "to_date": me})
    n = int(obs.get["rows"])
    if log_root:
        writelog(spark, log_root, [f"[END] inserted {n} rows."])
    return n


def calculate(spark: SparkSession, detail_root: str, mart_root: str, on_date, log_root: str) -> dict[str, object]:
    """Turnover of the date, then the month report; a failure is logged and the next step still runs."""
    detail = detail_tables(spark, detail_root)
    out: dict[str, object] = {}
    for name, step in (("turnover", fill_turnover), ("report", fill_report)):
        _append_log(spark, log_root, "begin", f"Start calculating {name}")
        try:
            out[name] = step(spark, detail, mart_root, on_date, log_root)
            _append_log(spark, log_root, "finish", f"Finish calculating {name}")
        except Exception as e:
            _append_log(spark, log_root, "error", _error_line(spark, log_root, name, e))
            out[name] = "error"
    return out


# ---------------------------------------------------------------- E-2: export the report, import versions

def export_report(spark: SparkSession, mart_root: str, path: str) -> str:
    rep = FS.read_partitioned(spark, f"{mart_root.rstrip('/')}/dm_f101_round_f", S.DM_F101_ROUND_F)
    return FS.export_csv(rep, path)


HISTORY_ROW = ("_rload", "_rseq")


def history_schema() -> T.StructType:
    """Stored history rows: report columns, version columns, row identity."""
    return T.StructType(S.DM_F101_ROUND_F.fields + [
        T.StructField("insert_date", T.TimestampNTZType()), T.StructField("actuality", T.BooleanType()),
        T.StructField(HISTORY_ROW[0], T.LongType()), T.StructField(HISTORY_ROW[1], T.LongType())])


def read_history(spark: SparkSession, history_root: str, table: str = "dm_f101_round_f_v2",
                 with_identity: bool = False, where=None) -> DataFrame | None:
    """The versioned report table: the latest record of every history row."""
    hist = TB.read_latest(spark, history_root, table, list(HISTORY_ROW), history_schema(), where)
    if hist is None or with_identity:
        return hist
    return hist.drop(*HISTORY_ROW)


def import_report_versions(spark: SparkSession, csv_path: str, history_root: str, log_root: str,
                           insert_date=None, table: str = "dm_f101_round_f_v2") -> int:
    """Import an exported report into the versioned history table; returns rows inserted.

    The history is append-only: an import appends its new versions and one
    closing record for each version it closes (same row identity,
    ``actuality = false``); readers take the latest record per row.
    """
    _append_log(spark, log_root, "begin", f"Start loading table {table}")
    try:
        raw = CSV.read_text_rows(spark, csv_path)
    except Exception as e:
        _append_log(spark, log_root, "error", f"ERROR: {table} - Cannot read file *.csv")
        writelog(spark, log_root, [str(e)])
        _append_log(spark, log_root, "inform", str(e).splitlines()[0][:255])
        raise
    keys = S.REPORT_KEYS
    measures = {c: "decimal(23,8)" for c in S.REPORT_COLUMNS[5:]}
    typed = raw.select(*[F.col(c).try_cast("date").alias(c) for c in keys[:2]],
                       *[F.col(c).alias(HI.key_text_column(c)) for c in keys[:2]], *keys[2:], *measures, "seq")
    # Keys include the report month, so only the history of the file's months can change, and the store is
    # partitioned by it: a semi-join, pruned to those folders at run time.
    months = typed.select("from_date").distinct()
    in_months = HI.month_filter(months)
    stored = TB.stored_rows(spark, history_root, table, TB._with_load(history_schema()))
    history = None
    if stored is not None:
        history = UP.latest_per_key(in_months(stored), list(HISTORY_ROW), TB.LOAD_COL).drop(TB.LOAD_COL)
    if history is None:
        history = spark.createDataFrame([], history_schema())
    when = insert_date or dt.datetime.now()
    bad = HI.bad_rows(typed, keys, measures, f"dm.{table}")
    bad_log = bad.select(F.lit("inform").alias("status"), F.col("log_message").alias("description"))
    err_log = bad.select(F.lit("error").alias("status"), F.col("error_text").alias("description"))
    AU.audit_log(err_log.unionByName(bad_log)).write.mode("append").parquet(f"{log_root.rstrip('/')}/{LOG_TABLE}")
    load_id = TB.new_load_id(spark, history_root, [table])
    changes = HI.versioned_changes(history, typed, keys, measures, when, HISTORY_ROW, load_id)
    TB.append_load(changes, history_root, table, load_id, ["from_date"])
    # Rows this load created (its own records, read back from the months it wrote).
    stored = in_months(TB.stored_rows(spark, history_root, table, TB._with_load(history_schema())))
    n = stored.filter((F.col(TB.LOAD_COL) == load_id) & (F.col(HISTORY_ROW[0]) == load_id)).count()
    _append_log(spark, log_root, "finish", f"Finish loading table {table} - Inserted: {n}")
    return n


# ---------------------------------------------------------------- E-3: mirror from delta folders

def run_mirror(spark: SparkSession, deltas_path: str, table: str, keys: list[str], mirror_root: str,
               log_path: str, export_path: str, schema) -> list[str]:
    """Apply every unloaded delta folder (string order) to the mirror, export it, append the load log.

    Batches are found by listing folders; only pending ones are opened, and an
    empty one is logged like any other.  The mirror store keeps every applied
    batch row with its batch id (one folder per batch), and a batch replaces
    its own folder, so a run repeated after a failure adds no row; the mirror
    itself is the row of the greatest batch id per key.
    """
    begin = dt.datetime.now()
    folders = FS.folder_names(spark, deltas_path)
    listed = spark.createDataFrame([(i,) for i in folders], f"{MI.BATCH_COL} STRING")
    pending = MI.pending_batches(listed, MI.read_load_log(spark, log_path), table)
    # Folder names only: bounded by the number of delta folders.
    ids = [r[MI.BATCH_COL] for r in pending.collect()]
    if not ids:
        return []
    apply_batches(spark, deltas_path, table, keys, mirror_root, log_path, schema, ids, ids, begin)
    export_mirror(spark, table, keys, mirror_root, export_path, schema)
    return ids


def apply_batches(spark: SparkSession, deltas_path: str, table: str, keys: list[str], mirror_root: str, log_path: str, schema,
                  ids: list[str], unlogged: list[str], begin: dt.datetime) -> None:
    """Store the listed batches whole, then append the load log of those that it lacks: a repeated run adds nothing."""
    write_batches(MI.read_batches(spark, deltas_path, table, schema, ids), keys, mirror_root, table)
    if unlogged:
        rows = spark.createDataFrame([(i,) for i in unlogged], f"{MI.BATCH_COL} STRING")
        # Every part file carries its own header, so appended parts read back cleanly.
        (MI.batch_log(rows, table, begin, dt.datetime.now()).coalesce(1).write.mode("append").option("header", True)
         .option("sep", ";").csv(log_path))


def export_mirror(spark: SparkSession, table: str, keys: list[str], mirror_root: str, export_path: str, schema) -> None:
    """The current mirror as ';' CSV with a header, in the place of the last export."""
    read_mirror(spark, mirror_root, table, keys, store_schema(schema)).write.mode("overwrite").csv(export_path, header=True, sep=";")


def store_schema(schema) -> T.StructType:
    """Columns of the mirror store: those of the mirror and the batch id."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([f for f in schema.fields if f.name != MI.BATCH_COL] + [T.StructField(MI.BATCH_COL, T.StringType(), True)])


def write_batches(rows: DataFrame, keys: list[str], mirror_root: str, table: str) -> None:
    """Store the rows of whole batches; a batch holding a key twice fails, a batch written again replaces itself."""
    (UP.unique_on(rows, keys + [MI.BATCH_COL], "batch").hint("rebalance", MI.BATCH_COL).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(MI.BATCH_COL).parquet(TB.table_path(mirror_root, table)))


def read_mirror(spark: SparkSession, mirror_root: str, table: str, keys: list[str], schema) -> DataFrame:
    """Current mirror rows: per key, the row of the greatest batch id."""
    store = spark.read.schema(schema).parquet(TB.table_path(mirror_root, table))
    cols = [c for c in schema.names if c != MI.BATCH_COL]
    return UP.latest_per_key(store, keys, MI.BATCH_COL).select(*cols)
