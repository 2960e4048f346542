"""Every registered query against its DuckDB oracle on the smallest data set."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from tallyspark import registry
from tallyspark.sources.testdata import BASE_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (decimal.Decimal, float, int)):
        d = decimal.Decimal(str(v)) if isinstance(v, float) else decimal.Decimal(v)
        return format(d.normalize(), "f") if d != 0 else "0"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_listed():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(registry.ORACLE[name])
    ocols = [d[0] for d in res.description]
    want = _rows(ocols, res.fetchall())
    assert sorted(df.columns) == sorted(ocols)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["on_date", "account_rk", "credit_amount", "credit_amount_rub", "debet_amount",
                          "debet_amount_rub"]
    assert df.count() >= 0
