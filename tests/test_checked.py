"""Money that overflows fails, with ANSI mode on and off; load ids without reading; findings of all rules in one pass."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas as S
from tallyspark.functions import money as M
from tallyspark.operators import checks as CK
from tallyspark.operators import clean as CL
from tallyspark.operators import turnover as TO
from tallyspark.plans import tables as TB

DAY = dt.date(1998, 9, 15)


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def turnover(spark, amounts, rate="2", kind="DECIMAL(18,6)"):
    post = spark.createDataFrame([(DAY, 1, None, Decimal(a), None) for a in amounts],
                                 "oper_date DATE, credit_account_rk INT, debet_account_rk INT, credit_amount DECIMAL(30,2), debet_amount DECIMAL(15,2)")
    acc = spark.createDataFrame([(dt.date(1998, 9, 1), dt.date(2050, 1, 1), 1, 5)], "data_actual_date DATE, data_actual_end_date DATE, account_rk INT, currency_rk INT")
    rates = spark.createDataFrame([(DAY, dt.date(9999, 12, 31), 5, rate)], "data_actual_date DATE, data_actual_end_date DATE, currency_rk INT, r STRING")
    rates = rates.withColumn("reduced_cource", F.col("r").cast(kind)).drop("r")
    return [TO.account_turnover(post, acc, rates, DAY).collect(), TO.account_turnover_range(post, acc, rates).collect()]


def test_amounts_in_range(spark, ansi):
    for rows in turnover(spark, ["1.25", "2.50"], "3.5"):
        assert [(r.credit_amount, r.credit_amount_rub) for r in rows] == [(Decimal("3.75"), Decimal("13.125"))]


@pytest.mark.parametrize("amounts, rate", [(["1" * 14], "2"), (["9" * 13] * 200, "2"), (["9" * 13], "999999999999")])
def test_overflow_fails(spark, ansi, amounts, rate):
    """An amount over its column's digits, a sum over the mart's, a product over the mart's."""
    with pytest.raises(Exception, match="not a dec|overflow|NUMERIC_VALUE_OUT_OF_RANGE|ARITHMETIC"):
        turnover(spark, amounts, rate)


def test_rate_type_is_carried_through(spark, ansi):
    for rows in turnover(spark, ["1.25"], "0.0000000001234567", "DECIMAL(20,16)"):
        # Rounded once, at the mart's scale.
        assert [r.credit_amount_rub for r in rows] == [Decimal("0E-8")]
    for rows in turnover(spark, ["1000000.00"], "0.0000000001234567", "DECIMAL(20,16)"):
        assert [r.credit_amount_rub for r in rows] == [Decimal("0.00012346")]
    assert M.amount_for(T.DecimalType(18, 6)) == T.DecimalType(19, 2)
    with pytest.raises(ValueError):
        M.amount_for(T.DecimalType(35, 6))


def test_sums_of_the_largest_decimals(spark, ansi):
    df = spark.createDataFrame([("9" * 38,), ("9" * 38,), (None,)], "t STRING").select(F.col("t").cast("decimal(38,0)").alias("v"))
    with pytest.raises(Exception, match="overflow|OUT_OF_RANGE|ARITHMETIC"):
        df.agg(M.checked_sum(F.col("v"))).collect()
    assert df.filter("v IS NULL").agg(M.checked_sum(F.col("v"))).first()[0] is None


def test_preaggregated_postings_fail_on_overflow(spark, ansi):
    rows = spark.createDataFrame([(DAY, 1, 2, Decimal("9" * 13), None)] * 2, S.FT_POSTING_F)
    with pytest.raises(Exception, match="not a dec|OUT_OF_RANGE"):
        CL.posting_preagg(rows).collect()


def test_load_ids_open_no_data_file(spark, tmp_path):
    df = spark.createDataFrame([(1, DAY)], "k INT, d DATE")
    TB.append_load(df, str(tmp_path), "t", 9_000_000_000_000_000, ["d"])
    for f in (tmp_path / "t").rglob("*.parquet"):
        f.write_bytes(b"unreadable")
    assert TB.new_load_id(spark, str(tmp_path), ["t", "none"]) == 9_000_000_000_000_001


def test_loads_lie_below_their_id_and_dates(spark, tmp_path):
    schema = spark.createDataFrame([], "k INT, v STRING, d DATE").schema
    for load, v in ((5, "old"), (6, "new")):
        TB.append_load(spark.createDataFrame([(1, v, DAY)], schema), str(tmp_path), "t", load, ["d"])
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if "=" in p.name) == ["_load=5", "_load=6"]
    latest = TB.read_latest(spark, str(tmp_path), "t", ["k", "d"], schema, F.col("d") == F.lit(DAY))
    assert list(map(tuple, latest.collect())) == [(1, "new", DAY)]
    assert "PartitionFilters: [isnotnull(d" in latest._jdf.queryExecution().executedPlan().toString()


def test_findings_of_a_table(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (1, "a", None), (2, "b", "xxx"), (None, "c", "xxxx"), (None, "c", "x"), (3, None, None)], "k INT, s STRING, t STRING")
    found = CK.constraint_findings(df, "t", ["k", "s"], ["t", "gone"], {"t": 2, "gone": 1})
    assert sorted(map(tuple, found.collect())) == sorted([
        ("t", "key", "k,s", 1), ("t", "not null", "k", 2), ("t", "not null", "s", 1), ("t", "not null", "t", 2), ("t", "length", "t", 2)])
    assert all(r.n_rows == 0 for r in CK.constraint_findings(df.limit(0), "t", ["k", "s"], ["t"], {"t": 2}).collect())
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") <= 2
