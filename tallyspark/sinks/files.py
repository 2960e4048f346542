"""File sinks: period replace, snapshots, CSV exports.

Period replace writes the new rows beside the table (``{root}.swap``) and, once
they are complete, moves the partition directory (``root/on_date=YYYY-MM-DD``)
away and the new one into its place.  The old copy stays until the new one is
there, so at every moment the period has its old or its new rows:

* the write fails: nothing was moved;
* a move fails: the old copy is moved back;
* the process ends between the two moves: ``read_partitioned`` reads the old
  copy in place of the missing period, and the next replace of the period moves
  it back first.

An empty result clears the period, other periods are never touched, and
re-running a period is idempotent.  One job at a time may replace a period.
Moving a folder is one step on HDFS and local disks; on object stores, where
it is a copy, the old copy in the swap folder covers the time it takes.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.money import decimal_text


# Folders and files looked into at a time.
LISTERS = 16


def _partition_value(v) -> str:
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()[:10]
    return str(v)


def partition_dir(root: str, spec: dict) -> str:
    path = root.rstrip("/")
    for k, v in spec.items():
        path += f"/{k}={_partition_value(v)}"
    return path


def _moved(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its file system (any Hadoop one)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    if not a.getFileSystem(conf).rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def moved_into(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to ``target``, whose parent folders are made."""
    _parents(spark, target)
    _moved(spark, source, target)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _deleted(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _parents(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p.getParent())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path`` (a listing, no file is opened)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def swap_root(root: str) -> str:
    """Where new rows and old copies of a table's periods lie while they are exchanged."""
    return f"{root.rstrip('/')}.swap"


def _old_copies(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(swap folder, period path below the table) of every old copy that an exchange has left: a listing."""
    base = swap_root(root)
    out = []
    for name in folder_names(spark, base) if exists(spark, base) else []:
        if name.startswith("old-"):
            path, inner = f"{base}/{name}", []
            while inner_names := [n for n in folder_names(spark, path) if "=" in n]:
                inner.append(inner_names[0])
                path += f"/{inner_names[0]}"
            if inner:
                out.append((f"{base}/{name}", "/".join(inner)))
    return out


def _recover(spark: SparkSession, root: str, period: str) -> None:
    """End an exchange of the period that was cut off: the old copy goes back, or goes if the new rows are in place."""
    for folder, inner in _old_copies(spark, root):
        if inner == period:
            if not exists(spark, f"{root}/{period}"):
                _parents(spark, f"{root}/{period}")
                _moved(spark, f"{folder}/{inner}", f"{root}/{period}")
            _deleted(spark, folder)


def _exchange(spark: SparkSession, root: str, period: str, new: str) -> None:
    """Put folder ``new`` in the place of the period; a failure leaves the old rows in place."""
    path, old = f"{root}/{period}", f"{swap_root(root)}/old-{uuid.uuid4().hex}"
    _parents(spark, path)
    if exists(spark, path):
        _parents(spark, f"{old}/{period}")
        _moved(spark, path, f"{old}/{period}")
        try:
            _moved(spark, new, path)
        except Exception:
            _moved(spark, f"{old}/{period}", path)
            _deleted(spark, old)
            raise
        _deleted(spark, old)
    else:
        _moved(spark, new, path)


def files_of_each(spark: SparkSession, paths: list[str]) -> list[list[tuple[str, str]]]:
    """(path, address as rows' ``_metadata.file_path`` has it) of the files at each of ``paths`` (a file, or a folder of
    part files), hidden ones left out: listings, no file is opened."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def files(path: str) -> list[tuple[str, str]]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        shown = [s for s in p.getFileSystem(conf).listStatus(p) if s.isFile()]
        return [(s.getPath().toString(), s.getPath().toUri().toString()) for s in shown if not s.getPath().getName().startswith(("_", "."))]
    with ThreadPoolExecutor(LISTERS) as pool:
        return list(pool.map(files, paths))


def first_lines(spark: SparkSession, files: list[str], limit: int = 1 << 16) -> list[str]:
    """The first line of each file, read from its first ``limit`` bytes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def line(path: str) -> str:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(conf).open(p)
        try:
            head = bytes(stream.readNBytes(limit))
        finally:
            stream.close()
        return head.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")
    with ThreadPoolExecutor(LISTERS) as pool:
        return list(pool.map(line, files))


def created(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file with the text unless it is there already: one of several writers makes it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, False)
    except Exception as e:
        if "AlreadyExists" in str(e):
            return False
        raise
    stream.writeBytes(text)
    stream.close()
    return True


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path``, none if it does not exist."""
    return [p.rpartition("/")[2] for p, _ in files_of_each(spark, [path])[0]] if exists(spark, path) else []


def replace_partition(df: DataFrame, root: str, spec: dict) -> str:
    """Replace one period of a partitioned parquet table with ``df`` (may be empty)."""
    spark, root = df.sparkSession, root.rstrip("/")
    period = partition_dir("", spec).strip("/")
    new = f"{swap_root(root)}/new-{uuid.uuid4().hex}"
    _recover(spark, root, period)
    try:
        df.drop(*spec.keys()).write.parquet(new)
        _exchange(spark, root, period, new)
    except Exception:
        _deleted(spark, new)
        raise
    # Readers of this session list the folder again.
    spark.catalog.refreshByPath(root)
    return f"{root}/{period}"


def replace_partitions(df: DataFrame, root: str, column: str, clear=()) -> list[str]:
    """Replace every period of ``column`` that ``df`` holds, written in one job, and empty those in ``clear``; the periods written.

    Each period is exchanged for itself: after a failure some have their new rows and the others their old ones, and
    running it again ends it."""
    spark, root = df.sparkSession, root.rstrip("/")
    new = f"{swap_root(root)}/new-{uuid.uuid4().hex}"
    try:
        df.hint("rebalance", column).write.partitionBy(column).parquet(new)
        # As many as periods were written.
        written = [n for n in folder_names(spark, new) if n.startswith(f"{column}=")]
        for period in written:
            _recover(spark, root, period)
            _exchange(spark, root, period, f"{new}/{period}")
    finally:
        _deleted(spark, new)
    empty = df.limit(0)
    for value in clear:
        if partition_dir("", {column: value}).strip("/") not in written:
            replace_partition(empty, root, {column: value})
    spark.catalog.refreshByPath(root)
    return [n.partition("=")[2] for n in written]


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Read a period-partitioned table with the partition columns typed by ``schema``.

    A period whose exchange was cut off between its two moves is read from its old copy."""
    root = root.rstrip("/")
    while True:
        copies = _old_copies(spark, root)
        missing = [(folder, inner) for folder, inner in copies if not exists(spark, f"{root}/{inner}")]
        if copies == _old_copies(spark, root):
            break
    parts = [spark.read.schema(schema).parquet(root).select(*schema.names)] if exists(spark, root) or not missing else []
    for folder, inner in missing:
        parts.append(spark.read.schema(schema).option("basePath", folder).parquet(f"{folder}/{inner}").select(*schema.names))
    return reduce(DataFrame.unionByName, parts)


def to_text_columns(df: DataFrame) -> DataFrame:
    """Every column as text; decimals print in plain digits (``0.00000000``, not ``0E-8``)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(decimal_text(F.col(f.name), f.dataType.scale).alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*cols)


def export_csv(df: DataFrame, path: str, sep: str = ";", single_file: bool = False) -> str:
    """CSV with a header; NULL as an empty field.  ``single_file`` only for bounded output."""
    out = to_text_columns(df)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("sep", sep).option("emptyValue", "").csv(path)
    return path


def read_text_csv(spark: SparkSession, path: str, columns: list[str], sep: str = ";") -> DataFrame:
    """Read an exported CSV back as all-text columns (empty field -> NULL)."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)
