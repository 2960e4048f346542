"""SQL entry points: detail tables as temporary views and the posting-stats table function.

After ``register(spark, tables)`` a SQL user can run

    SELECT * FROM posting_data(DATE '1998-09-15')

which returns the date's min / max credit and debit amounts (no row when the
date has no postings), like the set-returning function of the source system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSTINGS_VIEW = "ft_posting_f"


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Register each DataFrame as a temporary view and create the SQL table functions."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    if POSTINGS_VIEW in tables:
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION posting_data(i_date DATE)
            RETURNS TABLE (oper_date DATE, min_credit DECIMAL(15,2), min_debet DECIMAL(15,2),
                           max_credit DECIMAL(15,2), max_debet DECIMAL(15,2))
            RETURN SELECT oper_date, min(credit_amount), min(debet_amount), max(credit_amount), max(debet_amount)
                   FROM {POSTINGS_VIEW} WHERE oper_date = i_date GROUP BY oper_date""")
