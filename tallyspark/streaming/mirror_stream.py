"""Mirror maintained by Structured Streaming over the delta folders.

The file source finds new files ``{path}/{batch}/{table}.csv`` and keeps in its
checkpoint which ones it has seen; only their paths are taken from it.  Inside
``foreachBatch`` the folders of a micro-batch are read as the batch job reads
them, whole and by header name, with values that do not parse failing the
micro-batch, and stored one folder per batch; then the load log gets the
batches that it lacks.  So the mirror and the log are those of ``run_mirror``,
in whatever order the folders arrive: the mirror is the row of the greatest
batch id per key.  A replayed epoch stores the same batches again in their own
folders and finds them logged, so it adds nothing; a folder that gets another
part file later is stored again as a whole.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.operators import mirror as MI
from tallyspark.plans import jobs as JB


def start_mirror_stream(spark: SparkSession, deltas_path: str, table: str, keys: list[str], schema,
                        mirror_root: str, checkpoint_location: str, available_now: bool = True, log_path: str | None = None,
                        export_path: str | None = None, files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops (scheduled runs).

    The load log is that of the batch job if ``log_path`` is, else one below the mirror's root."""
    log_path = log_path or f"{mirror_root.rstrip('/')}/load_log"
    files = spark.readStream.schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY").format("binaryFile")
    if files_per_trigger:
        files = files.option("maxFilesPerTrigger", files_per_trigger)
    # Only the path is asked for: no content is read here.
    folder = F.regexp_extract("path", rf"/([^/]+)/{re.escape(table)}\.csv(/[^/]+)?$", 1)
    found = files.load(f"{deltas_path.rstrip('/')}/*/{table}.csv").select(folder.alias(MI.BATCH_COL))

    def apply(batch_df: DataFrame, epoch_id: int) -> None:
        apply_epoch(batch_df, deltas_path, table, keys, mirror_root, log_path, schema)
        if export_path:
            JB.export_mirror(batch_df.sparkSession, table, keys, mirror_root, export_path, schema)

    writer = found.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def apply_epoch(batch_df: DataFrame, deltas_path: str, table: str, keys: list[str], mirror_root: str, log_path: str, schema) -> None:
    """Apply the batches named in a micro-batch (``delta_id``): stored whole, logged once."""
    spark, begin = batch_df.sparkSession, dt.datetime.now()
    named = batch_df.select(MI.BATCH_COL).distinct()
    # Folder names of one micro-batch.
    ids = sorted(r[0] for r in named.collect())
    if ids:
        listed = spark.createDataFrame([(i,) for i in ids], f"{MI.BATCH_COL} STRING")
        unlogged = [r[0] for r in MI.pending_batches(listed, MI.read_load_log(spark, log_path), table).collect()]
        JB.apply_batches(spark, deltas_path, table, keys, mirror_root, log_path, schema, ids, unlogged, begin)


def read_mirror(spark: SparkSession, mirror_root: str, table: str, keys: list[str], schema) -> DataFrame:
    """Current mirror rows (``schema`` without the batch id)."""
    return JB.read_mirror(spark, mirror_root, table, keys, JB.store_schema(schema))
