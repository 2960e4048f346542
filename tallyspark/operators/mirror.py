"""Table mirror built from ordered delta batches (keyed merge, no deletes).

The reference applies batches one by one in string order of their folder
names (update all columns on a key match, insert otherwise).  Applying N
batches in sequence equals, for each key, taking the row of the greatest
batch id among the snapshot and all batches; that is one aggregate
(``max_by``), which combines map-side, so a hot key does not land whole in
one task.  Rows with a NULL key never match and are always appended.

Two rows of one key inside one batch: Delta raises for a matched key and
inserts both for a new one; here the default ``on_duplicate='error'`` fails
the job in both cases, ``'last'`` keeps the row with the greatest
``order_col``.
"""

from __future__ import annotations

import csv
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.dates import naive_timestamp
from tallyspark.operators.upsert import latest_per_key, unique_on
from tallyspark.schemas import LOAD_LOG
from tallyspark.sinks import files as FS
from tallyspark.sources.csv import parsed

BATCH_COL = "delta_id"
# Start of a local file's address, which has one or three slashes.
LOCAL = re.compile("^file:/+")


def pending_batches(batch_ids: DataFrame, load_log: DataFrame, table: str) -> DataFrame:
    """Batch ids (strings, sorted as strings) not yet recorded in the load log for ``table``."""
    loaded = load_log.filter(F.col("TABLE") == table).select(F.col("ID").cast("string").alias(BATCH_COL))
    return (batch_ids.select(F.col(BATCH_COL).cast("string").alias(BATCH_COL)).distinct()
            .join(loaded, BATCH_COL, "left_anti").orderBy(BATCH_COL))


def mirror_apply(snapshot: DataFrame | None, batches: DataFrame, keys: list[str], on_duplicate: str = "error",
                 order_col: str | None = None) -> DataFrame:
    """Next mirror snapshot after merging ``batches`` (rows carrying ``delta_id``) in batch-id order.

    ``snapshot`` None means the mirror does not exist yet: it is created with
    the schema of the batches (without ``delta_id``).
    """
    cols = [c for c in batches.columns if c != BATCH_COL]
    if on_duplicate == "error":
        # Fails the job (lazily, in the same pass) if a batch holds a key twice.
        ranked = unique_on(batches, keys + [BATCH_COL], "batch")
    elif on_duplicate == "last":
        if order_col is None:
            raise ValueError("on_duplicate='last' needs order_col")
        ranked = latest_per_key(batches, keys + [BATCH_COL], order_col)
    else:
        raise ValueError(f"on_duplicate must be 'error' or 'last', not {on_duplicate!r}")
    if snapshot is not None:
        # The snapshot comes before every batch: the empty id sorts first.
        kinds = ranked.schema
        snap = snapshot.select(*[F.col(c).cast(kinds[c].dataType).alias(c) for c in cols], F.lit("").alias(BATCH_COL))
        ranked = snap.unionByName(ranked)
    return latest_per_key(ranked, keys, BATCH_COL).select(*cols)


def batch_log(pending: DataFrame, table: str, begin, end) -> DataFrame:
    """Load-log rows (BEGIN, END, ID, TABLE) for the applied batches."""
    return pending.select(naive_timestamp(begin).alias("BEGIN"), naive_timestamp(end).alias("END"),
                          F.col(BATCH_COL).alias("ID"), F.lit(table).alias("TABLE"))


# ---------------------------------------------------------------- file layout of the reference

def read_batches(spark: SparkSession, path: str, table: str, schema, ids: list[str], sep: str = ";") -> DataFrame | None:
    """The rows of ``{path}/{id}/{table}.csv`` for the listed batch folders, with the folder name as ``delta_id``.

    One plan with one scan, however many batches there are.  Columns are matched by header name in any case and order:
    the header of each file (folders may hold several part files) is a row (file, place of each column) that the rows
    of the file join; a value that its type cannot hold fails the job, a column that a file lacks is NULL there.  Only
    the listed folders are opened.  None if no folder is listed."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not ids:
        return None
    files, batches = [], []
    root = path.rstrip("/")
    for i, found in zip(ids, FS.files_of_each(spark, [f"{root}/{i}/{table}.csv" for i in ids])):
        files += found
        batches += [i] * len(found)
    wanted = [f.name.lower() for f in schema.fields]
    heads, width = [], 1
    for (_, address), batch, line in zip(files, batches, FS.first_lines(spark, [path for path, _ in files])):
        names = [n.strip().lower() for n in next(csv.reader([line], delimiter=sep), [])]
        width = max(width, len(names))
        heads.append((LOCAL.sub("file:/", address), batch, [names.index(n) if n in names else None for n in wanted]))
    places = spark.createDataFrame(heads, f"_file STRING, {BATCH_COL} STRING, _places ARRAY<INT>")
    if not files:
        return places.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], BATCH_COL)
    texts = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    rows = spark.read.schema(texts).option("header", True).option("sep", sep).csv([path for path, _ in files])
    rows = rows.select(F.array(*texts.names).alias("_values"), F.regexp_replace("_metadata.file_path", LOCAL.pattern, "file:/").alias("_file")).join(places, "_file")
    value = lambda i: F.get(F.col("_values"), F.col("_places")[i])
    return rows.select(*[parsed(value(i), f.dataType, f.name).alias(f.name) for i, f in enumerate(schema.fields)], BATCH_COL)


def read_batch_folders(spark: SparkSession, root: str, schema) -> DataFrame:
    """Parquet batches stored as ``root/delta_id=<id>/``; the id stays text (no type inference)."""
    return spark.read.schema(schema).parquet(root)


def read_load_log(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """The load log with ids as text; an empty log when the file does not exist yet."""
    try:
        return spark.read.schema(LOAD_LOG).option("header", True).option("sep", sep).csv(path)
    except Exception as e:  # path does not exist
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], LOAD_LOG)
        raise
