"""Hand-made rows for every behaviour kept from the reference (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators import categories as CA
from tallyspark.operators import history as HI
from tallyspark.operators import mirror as MI
from tallyspark.operators import report as RP
from tallyspark.operators import stats as ST
from tallyspark.operators import turnover as TO
from tallyspark.operators import upsert as UP
from tallyspark.sinks import files as FS

D = dt.date
DAY = D(2024, 3, 15)
FAR = D(2099, 12, 31)


def dec(x):
    return Decimal(str(x))


def accounts(spark, rows):
    """rows: (account_rk, account_number, char_type, currency_rk, start)"""
    return spark.createDataFrame(
        [(start, FAR, rk, num, ct, cur, "x") for rk, num, ct, cur, start in rows], S.MD_ACCOUNT_D)


def currencies(spark, rows):
    return spark.createDataFrame([(rk, D(2000, 1, 1), FAR, code, "XXX") for rk, code in rows], S.MD_CURRENCY_D)


def rates(spark, rows):
    return spark.createDataFrame([(start, end, rk, dec(r), None) for rk, r, start, end in rows],
                                 S.MD_EXCHANGE_RATE_D)


def ledger(spark, accts):
    return spark.createDataFrame([("A", None, None, None, None, None, None, a, None, None, None, None, None, None,
                                   None, None, None, None, D(2000, 1, 1), FAR, None, None, None, None, None, None,
                                   None, None) for a in accts], S.MD_LEDGER_ACCOUNT_S)


def postings(spark, rows):
    return spark.createDataFrame([(d, c, db, dec(ca), dec(da)) for d, c, db, ca, da in rows], S.FT_POSTING_F)


def balances(spark, rows):
    return spark.createDataFrame([(D(2024, 2, 29), rk, cur, dec(b)) for rk, cur, b in rows], S.FT_BALANCE_F)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()


def test_missing_rate_counts_as_one_in_turnover_but_null_in_report(spark):
    acc = accounts(spark, [(1, "30001840000000000001", "A", 23, D(2024, 3, 1)),
                           (2, "30001840000000000002", "A", 23, D(2024, 3, 1))])
    post = postings(spark, [(DAY, 2, 1, 10, 10)])
    turn = TO.account_turnover(post, acc, rates(spark, []), DAY)
    r = {row.account_rk: row for row in turn.collect()}
    assert r[1].debet_amount_rub == dec(10)
    rep = RP.report_rows(acc, currencies(spark, [(23, "978")]), ledger(spark, [30001]),
                         balances(spark, [(1, 23, 100)]), rates(spark, []), turn, DAY)
    row = [x for x in rep.collect() if x.account_rk == 1][0]
    assert row.balance_in_val is None


def test_missing_opening_balance_loses_closing_balance_only(spark):
    acc = accounts(spark, [(1, "30001840000000000001", "A", 5, D(2024, 3, 1)),
                           (2, "30001840000000000002", "A", 5, D(2024, 3, 1))])
    post = postings(spark, [(DAY, 2, 1, 10, 10)])
    rt = rates(spark, [(5, 1, D(2000, 1, 1), FAR)])
    turn = TO.account_turnover(post, acc, rt, DAY)
    rep = RP.report_rows(acc, currencies(spark, [(5, "643")]), ledger(spark, [30001]),
                         balances(spark, [(2, 5, 50)]), rt, turn, DAY)
    row = [x for x in rep.collect() if x.account_rk == 1][0]
    assert row.turn_deb_rub == dec(10) and row.turn_deb_total == dec(10)
    assert row.balance_out_rub is None


def _two_day_setup(spark):
    acc = accounts(spark, [(1, "30001840000000000001", "A", 5, D(2024, 3, 1)),
                           (2, "30001840000000000002", "P", 5, D(2024, 3, 1))])
    rt = rates(spark, [(5, 1, D(2000, 1, 1), FAR)])
    post = postings(spark, [(D(2024, 3, 14), 2, 1, 5, 5), (DAY, 2, 1, 7, 7)])
    turn = TO.account_turnover_range(post, acc, rt, D(2024, 3, 14), DAY)
    return acc, rt, turn


def test_two_turnover_days_count_opening_balance_twice_by_default(spark):
    acc, rt, turn = _two_day_setup(spark)
    args = (acc, currencies(spark, [(5, "643")]), ledger(spark, [30001]), balances(spark, [(1, 5, 100)]), rt, turn,
            DAY)
    by_day = RP.ledger_report(*args).filter(F.col("characteristic") == "A")
    by_month = RP.ledger_report(*args, turnover_grain="month").filter(F.col("characteristic") == "A")
    assert one(by_day)["balance_in_rub"] == dec(200)
    assert one(by_month)["balance_in_rub"] == dec(100)
    assert one(by_month)["turn_deb_rub"] == dec(12)


def test_null_currency_code(spark):
    acc = accounts(spark, [(1, "30001840000000000001", "A", 24, D(2024, 3, 1))])
    rt = rates(spark, [(24, 2, D(2000, 1, 1), FAR)])
    turn = TO.account_turnover(postings(spark, []), acc, rt, DAY)
    rep = RP.ledger_report(acc, currencies(spark, [(24, None)]), ledger(spark, [30001]),
                           balances(spark, [(1, 24, 100)]), rt, turn, DAY)
    r = one(rep)
    assert r["balance_in_rub"] == 0 and r["balance_in_val"] == 0 and r["balance_in_total"] == dec(200)


def test_char_type_other_than_a_or_p_closes_at_zero(spark):
    acc = accounts(spark, [(1, "30001840000000000001", "X", 5, D(2024, 3, 1))])
    rt = rates(spark, [(5, 1, D(2000, 1, 1), FAR)])
    turn = TO.account_turnover(postings(spark, []), acc, rt, DAY)
    rep = RP.ledger_report(acc, currencies(spark, [(5, "643")]), ledger(spark, [30001]),
                           balances(spark, [(1, 5, 100)]), rt, turn, DAY)
    r = one(rep)
    assert r["balance_in_rub"] == dec(100)
    assert r["balance_out_rub"] == 0 and r["balance_out_total"] == 0
    assert all(r[c] == 0 for c in S.REPORT_COLUMNS if c.startswith("r_"))


def test_overlapping_rates_fan_out(spark):
    acc = accounts(spark, [(1, "30001840000000000001", "A", 7, D(2024, 3, 1)),
                           (2, "30001840000000000002", "A", 7, D(2024, 3, 1))])
    rt = rates(spark, [(7, 2, D(2000, 1, 1), FAR), (7, 3, D(2024, 1, 1), FAR)])
    post = postings(spark, [(DAY, 2, 1, 10, 10)])
    r = {x.account_rk: x for x in TO.account_turnover(post, acc, rt, DAY).collect()}
    assert r[1].debet_amount == dec(20) and r[1].debet_amount_rub == dec(50)
    ranged = {x.account_rk: x for x in TO.account_turnover_range(post, acc, rt, DAY, DAY).collect()}
    assert ranged[1].debet_amount_rub == dec(50)


def test_account_must_start_in_month_unless_disabled(spark):
    acc = accounts(spark, [(1, "30001840000000000001", "A", 7, D(2024, 2, 1)),
                           (2, "30001840000000000002", "A", 7, D(2024, 3, 1))])
    post = postings(spark, [(DAY, 2, 1, 10, 10)])
    rt = rates(spark, [])
    assert {x.account_rk for x in TO.account_turnover(post, acc, rt, DAY).collect()} == {2}
    assert {x.account_rk for x in TO.account_turnover(post, acc, rt, DAY, account_start_in_month=False)
            .collect()} == {1, 2}


def test_empty_replacement_clears_the_day(spark, tmp_dir):
    acc = accounts(spark, [(1, "30001840000000000001", "A", 7, D(2024, 3, 1)),
                           (2, "30001840000000000002", "A", 7, D(2024, 3, 1)),
                           (3, "30001840000000000003", "A", 7, D(2024, 3, 1))])
    full = postings(spark, [(DAY, 1, 2, 1, 1), (DAY, 2, 3, 1, 1), (D(2024, 3, 14), 1, 2, 1, 1)])
    rt = rates(spark, [])
    root = f"{tmp_dir}/turn"
    for d in (D(2024, 3, 14), DAY):
        FS.replace_partition(TO.account_turnover(full, acc, rt, d), root, {"on_date": d})
    before = FS.read_partitioned(spark, root, S.DM_ACCOUNT_TURNOVER_F)
    assert before.filter(F.col("on_date") == DAY).count() == 3
    empty = TO.account_turnover(postings(spark, []), acc, rt, DAY)
    FS.replace_partition(empty, root, {"on_date": DAY})
    after = FS.read_partitioned(spark, root, S.DM_ACCOUNT_TURNOVER_F)
    assert after.filter(F.col("on_date") == DAY).count() == 0
    assert after.filter(F.col("on_date") == D(2024, 3, 14)).count() == 2


def test_versions_in_one_file(spark):
    hist = spark.createDataFrame([(1, dec(1), D(2024, 1, 1), True)],
                                 "id INT, amount DECIMAL(23,8), insert_date DATE, actuality BOOLEAN")
    inc = spark.createDataFrame([(1, 1, "1"), (1, 2, "2"), (1, 3, "2.00000000"), (1, 4, "1")],
                                "id INT, seq BIGINT, amount STRING")
    out = HI.versioned_import(hist, inc, ["id"], {"amount": "decimal(23,8)"}, D(2024, 2, 1))
    rows = sorted((r.amount, r.insert_date, r.actuality) for r in out.collect())
    assert rows == [(dec(1), D(2024, 1, 1), False), (dec(1), D(2024, 2, 1), True), (dec(2), D(2024, 2, 1), False)]


def test_blank_measure_is_zero_and_bad_text_is_rejected(spark):
    hist = spark.createDataFrame([(1, dec(0), D(2024, 1, 1), True)],
                                 "id INT, amount DECIMAL(23,8), insert_date DATE, actuality BOOLEAN")
    inc = spark.createDataFrame([(1, 1, ""), (2, 2, "abc")], "id INT, seq BIGINT, amount STRING")
    out = HI.versioned_import(hist, inc, ["id"], {"amount": "decimal(23,8)"}, D(2024, 2, 1))
    assert out.count() == 1  # blank equals the stored 0: skipped; 'abc' rejected
    bad = one(HI.bad_rows(inc, ["id"], {"amount": "decimal(23,8)"}, "t"))
    assert bad["log_message"] == "BAD ROW: <2>" and len(bad["error_text"]) <= 250


def test_null_merge_key_never_matches(spark):
    target = spark.createDataFrame([(None, "a")], "k STRING, v STRING")
    delta = spark.createDataFrame([("001", None, "b")], "delta_id STRING, k STRING, v STRING")
    out = MI.mirror_apply(target, delta, ["k"])
    assert sorted(r.v for r in out.collect()) == ["a", "b"]


def test_pending_batches_by_text_id(spark):
    ids = spark.createDataFrame([("001",), ("002",), ("010",), ("9",)], "delta_id STRING")
    log = spark.createDataFrame([(None, None, "001", "t"), (None, None, "002", "other")], S.LOAD_LOG)
    assert [r.delta_id for r in MI.pending_batches(ids, log, "t").collect()] == ["002", "010", "9"]


def test_mirror_later_batch_wins_in_string_order(spark):
    delta = spark.createDataFrame([("10", "k", 1), ("9", "k", 2), ("2", "j", 3)], "delta_id STRING, k STRING, v INT")
    out = {r.k: r.v for r in MI.mirror_apply(None, delta, ["k"]).collect()}
    assert out == {"k": 2, "j": 3}


def test_mirror_duplicate_key_in_one_batch_fails(spark):
    delta = spark.createDataFrame([("1", "k", 1), ("1", "k", 2)], "delta_id STRING, k STRING, v INT")
    with pytest.raises(Exception, match="not unique"):
        MI.mirror_apply(None, delta, ["k"]).collect()


def test_case_variants_are_counted_before_lower_casing(spark):
    ath = spark.createDataFrame([("Judo",), ("Judo",), ("JUDO",)], "Discipline STRING")
    dim = spark.createDataFrame([(1, "judo", "summer")], S.DISCIPLINES)
    rows = sorted(r["count"] for r in CA.category_join(CA.category_counts(ath), dim).collect())
    assert rows == [1, 2]
    assert CA.category_join(CA.category_counts(ath), dim).columns == ["discipline", "count"]


def test_upsert_twice_equals_once_and_keeps_unsent_columns(spark):
    target = spark.createDataFrame([(1, "a", dec(1)), (2, "b", dec(2))], "id INT, s STRING, amount DECIMAL(15,2)")
    inc = spark.createDataFrame([(2, "B"), (3, "C")], "id INT, s STRING")
    once = UP.keyed_upsert(target, inc, ["id"])
    twice = UP.keyed_upsert(once, inc, ["id"])
    rows = sorted(tuple(r) for r in once.collect())
    assert rows == sorted(tuple(r) for r in twice.collect())
    assert rows == [(1, "a", dec(1)), (2, "B", dec(2)), (3, "C", None)]


def test_upsert_duplicate_incoming_key_fails_or_keeps_last(spark):
    target = spark.createDataFrame([(1, "a", 0)], "id INT, s STRING, n INT")
    inc = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "id INT, s STRING, n INT")
    with pytest.raises(Exception, match="not unique"):
        UP.keyed_upsert(target, inc, ["id"]).collect()
    assert [r.s for r in UP.keyed_upsert(target, inc, ["id"], "last", "n").collect()] == ["y"]


def test_posting_report_prints_none_for_missing_values(spark):
    post = spark.createDataFrame([(DAY, 1, 2, None, None)], S.FT_POSTING_F)
    lines = [r.line for r in ST.posting_report(ST.posting_stats(post, DAY)).orderBy("line_no").collect()]
    assert lines == ["On date: 2024-03-15", "min credit >> None", "min debet >> None", "max_credit >> None",
                     "max_debet >> None"]
    assert ST.posting_stats(post, D(2024, 3, 16)).count() == 0


def test_report_rub_plus_val_equals_total_when_code_known(spark):
    from tallyspark.sources.fixtures import Fixtures
    f = Fixtures(spark, "/root/testdata/sf0.01")
    turn = TO.account_turnover(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d, D(1998, 9, 15))
    rows = RP.report_rows(f.md_account_d, f.md_currency_d, f.md_ledger_account_s, f.ft_balance_f,
                          f.md_exchange_rate_d, turn, D(1998, 9, 15)).filter(F.col("cur_code").isNotNull())
    for side in ("turn_deb", "turn_cre"):
        bad = rows.filter(F.col(f"{side}_rub") + F.col(f"{side}_val") != F.col(f"{side}_total"))
        assert bad.count() == 0
    assert rows.count() > 0


def test_report_totals_match_the_published_figures(spark):
    """Sum of balance_in_total over the sf0.01 report: one turnover day vs three."""
    from tallyspark import registry as R
    one_day = R.QUERIES["ledger_report"](spark, "/root/testdata/sf0.01").agg(F.sum("balance_in_total")).first()[0]
    three = R.QUERIES["ledger_report_3d"](spark, "/root/testdata/sf0.01").agg(F.sum("balance_in_total")).first()[0]
    assert one_day == dec("68540272.653")
    assert three == dec("69033680.3668")


def test_replace_day_twice_equals_once(spark, tmp_dir):
    acc = accounts(spark, [(1, "30001840000000000001", "A", 7, D(2024, 3, 1)),
                           (2, "30001840000000000002", "A", 7, D(2024, 3, 1))])
    post = postings(spark, [(DAY, 1, 2, 3, 3)])
    turn = TO.account_turnover(post, acc, rates(spark, []), DAY)
    root = f"{tmp_dir}/t"
    FS.replace_partition(turn, root, {"on_date": DAY})
    once = sorted(tuple(r) for r in FS.read_partitioned(spark, root, S.DM_ACCOUNT_TURNOVER_F).collect())
    FS.replace_partition(turn, root, {"on_date": DAY})
    assert sorted(tuple(r) for r in FS.read_partitioned(spark, root, S.DM_ACCOUNT_TURNOVER_F).collect()) == once


def test_explicit_schema_keeps_code_leading_zeros(spark, tmp_dir):
    from tallyspark.sources import csv as CSV
    rates_df = spark.createDataFrame([(D(2024, 1, 1), FAR, 5, dec("1.5"), "036")], S.MD_EXCHANGE_RATE_D)
    path = CSV.write_detail_csv(rates_df, f"{tmp_dir}/rates.csv")
    typed = CSV.read_detail_csv(spark, path, S.MD_EXCHANGE_RATE_D)
    assert typed.first().code_iso_num == "036"
    inferred = spark.read.csv(path, header=True, inferSchema=True, sep=";")
    assert inferred.first().CODE_ISO_NUM == 36  # what type inference does to codes


def test_sql_table_function_matches_posting_stats(spark):
    from tallyspark import sql_api
    from tallyspark.sources.fixtures import Fixtures
    post = Fixtures(spark, "/root/testdata/sf0.001").ft_posting_f
    sql_api.register(spark, {"ft_posting_f": post})
    got = [tuple(r) for r in spark.sql("SELECT * FROM posting_data(DATE '1998-09-15')").collect()]
    want = [tuple(r) for r in ST.posting_stats(post, D(1998, 9, 15)).collect()]
    assert got == want and len(got) == 1
    assert spark.sql("SELECT * FROM posting_data(DATE '1970-01-01')").count() == 0
