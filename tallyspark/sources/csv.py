"""CSV readers of the detail files and of exported reports.

Detail files are ``;``-separated with a header and a leading row-number
column, which is dropped.  Columns are matched by header name, whatever their
order and case, and parsed from text with the table's types, so codes keep
leading zeros and the text ``NA`` stays text; only an empty field is NULL.  A
value that its type cannot hold exactly fails the job.  A file may lack
columns.  The date format is a parameter (the files' format is not fixed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas as S

# Bits of the row number inside a task (as ``monotonically_increasing_id`` has them).
ROW_BITS = 33

# The six detail files, in load order, with their table schema.
DETAIL_FILES = [
    ("ft_balance_f", S.FT_BALANCE_F),
    ("ft_posting_f", S.FT_POSTING_F),
    ("md_account_d", S.MD_ACCOUNT_D),
    ("md_currency_d", S.MD_CURRENCY_D),
    ("md_exchange_rate_d", S.MD_EXCHANGE_RATE_D),
    ("md_ledger_account_s", S.MD_LEDGER_ACCOUNT_S),
]

def parsed(text: Column, kind: T.DataType, name: str, date_format: str = "yyyy-MM-dd") -> Column:
    """``text`` as ``kind``; an empty field is NULL, a value that ``kind`` cannot hold exactly fails the job."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DateType):
        value = F.try_to_timestamp(text, F.lit(date_format)).cast(kind)
    elif isinstance(kind, T.DecimalType):
        exact = text.try_cast("decimal(38,18)")
        value = F.when(text.try_cast(kind) == exact, text.try_cast(kind))
    else:
        value = text.try_cast(kind)
    error = F.raise_error(F.concat(F.lit(f"{name}: not a {kind.simpleString()}: "), text)).cast(kind)
    return F.when(text.isNull(), F.lit(None).cast(kind)).when(value.isNotNull(), value).otherwise(error)


def by_name(df: DataFrame, schema: T.StructType, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """The columns of ``schema`` that the text rows of ``df`` have, matched by name in any case, parsed."""
    names = {c.strip().lower(): c for c in df.columns}
    given = [f for f in schema.fields if f.name.lower() in names]
    return df.select(*[parsed(F.col(f"`{names[f.name.lower()]}`"), f.dataType, f.name, date_format).alias(f.name) for f in given])


def read_detail_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                    date_format: str = "yyyy-MM-dd", ledger_pair_as_float: bool = False) -> DataFrame:
    """A detail file: header line, leading row-number column (dropped), the other columns by name."""
    if ledger_pair_as_float:
        schema = T.StructType([T.StructField(f.name, T.DoubleType()) if f.name == "pair_account" else f for f in schema.fields])
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    return by_name(df.drop(df.columns[0]), schema, date_format)


def read_text_rows(spark: SparkSession, path: str, sep: str = ";", seq_col: str = "seq") -> DataFrame:
    """A CSV as raw text (first line = column names) with a file-order column.

    A task may hold several pieces of files, the largest first, so rows are
    ordered by file name, then by the start of their piece, then as they stand
    in it.  The list of pieces is as long as the input has splits.
    """
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    columns = df.columns
    # The row number in its task grows inside every piece that the task reads.
    rows = df.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                     (F.monotonically_increasing_id() % (1 << ROW_BITS)).alias("_row"))
    pieces = rows.select("_file", "_start").distinct().withColumn(
        "_piece", F.row_number().over(Window.orderBy("_file", "_start")).cast("bigint") - 1)
    return rows.join(pieces, ["_file", "_start"]).select(*columns, (F.col("_piece") * (1 << ROW_BITS) + F.col("_row")).alias(seq_col))


def write_detail_csv(df: DataFrame, path: str, sep: str = ";", compression: str = "none") -> str:
    """Write a table in the detail-file layout (row-number column first, upper-case header), a part file for each task."""
    out = df.select(F.monotonically_increasing_id().cast("string").alias(""),
                    *[F.col(c).cast("string").alias(c.upper()) for c in df.columns])
    out.write.mode("overwrite").option("header", True).option("sep", sep).option("compression", compression).csv(path)
    return path
