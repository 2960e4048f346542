"""End-to-end file jobs: load + calculate, export + versioned import, mirror from delta folders."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators import mirror as MI
from tallyspark.operators import report as RP
from tallyspark.operators import turnover as TO
from tallyspark.plans import jobs as J
from tallyspark.plans import tables as TB
from tallyspark.sources import csv as CSV
from tallyspark.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"
DAY = dt.date(1998, 9, 15)


def _ledger_full(f):
    led = f.md_ledger_account_s.join(f.ledger_raw.select("ledger_account", "pair_account", "section_name"),
                                     "ledger_account", "left")
    cols = []
    for name, typ in S.LEDGER_COLUMNS:
        if name in led.columns:
            cols.append(F.col(name))
        else:
            cols.append(F.lit(None).cast(typ).alias(name))
    return led.select(*cols)


def _write_inputs(spark, f, folder):
    src = {
        "ft_balance_f": f.ft_balance_f,
        "ft_posting_f": f.posting_raw.select(*S.FT_POSTING_F.names),
        "md_account_d": f.md_account_d,
        "md_currency_d": f.md_currency_d,
        "md_exchange_rate_d": f.exchange_rate_raw.withColumn("code_iso_num", F.lit("036")),
        "md_ledger_account_s": _ledger_full(f),
    }
    for name, df in src.items():
        CSV.write_detail_csv(df, f"{folder}/{name}.csv")


def test_load_then_calculate(spark, tmp_dir):
    f = Fixtures(spark, SF)
    _write_inputs(spark, f, f"{tmp_dir}/in")
    detail, marts, logs = f"{tmp_dir}/ds", f"{tmp_dir}/dm", f"{tmp_dir}/logs"
    assert set(J.load_detail(spark, f"{tmp_dir}/in", detail, logs).values()) == {"ok"}
    # A second load upserts the same rows: same content, two loads stored.
    assert set(J.load_detail(spark, f"{tmp_dir}/in", detail, logs).values()) == {"ok"}
    assert spark.read.parquet(f"{detail}/ft_posting_f").select("_load").distinct().count() == 2
    tables = J.detail_tables(spark, detail)
    assert tables["ft_posting_f"].count() == f.ft_posting_f.count()
    assert tables["ft_posting_f"].exceptAll(f.ft_posting_f).count() == 0
    assert tables["md_exchange_rate_d"].count() == f.md_exchange_rate_d.count()
    assert tables["md_exchange_rate_d"].select("code_iso_num").distinct().collect()[0][0] == "036"
    n_turn = J.fill_turnover(spark, tables, marts, DAY, logs)
    assert n_turn == TO.account_turnover(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d, DAY).count()
    n_rep = J.fill_report(spark, tables, marts, DAY, logs)
    want = RP.ledger_report(f.md_account_d, f.md_currency_d, f.md_ledger_account_s, f.ft_balance_f,
                            f.md_exchange_rate_d,
                            TO.account_turnover(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d, DAY), DAY)
    assert n_rep == want.count()
    log = J.read_log(spark, logs)
    assert log.filter(F.col("status") == "FINISH_LOADING").count() == 12
    msgs = J.read_messages(spark, logs).orderBy("record_id").collect()
    assert [m.record_id for m in msgs] == list(range(1, len(msgs) + 1))
    assert msgs[0].message == "[BEGIN] fill(i_OnDate => date '1998-09-15');"
    assert msgs[3].message == f"[END] inserted {n_turn} rows."
    # The calculate step repeats both and logs; ids keep counting.
    assert J.calculate(spark, detail, marts, DAY, logs) == {"turnover": n_turn, "report": n_rep}
    assert J.read_messages(spark, logs).count() == 16

    # E-2: export the report, import it twice into the versioned history.
    path = J.export_report(spark, marts, f"{tmp_dir}/report_csv")
    first = J.import_report_versions(spark, path, f"{tmp_dir}/hist", logs, dt.datetime(2024, 1, 1))
    assert first == n_rep
    again = J.import_report_versions(spark, path, f"{tmp_dir}/hist", logs, dt.datetime(2024, 1, 2))
    assert again == 0
    hist = J.read_history(spark, f"{tmp_dir}/hist")
    assert hist.count() == n_rep and hist.filter("actuality").count() == n_rep
    # The second import appended nothing.
    stored = spark.read.parquet(f"{tmp_dir}/hist/dm_f101_round_f_v2")
    assert stored.count() == n_rep


def test_failed_table_is_logged_and_next_loads(spark, tmp_dir):
    f = Fixtures(spark, SF)
    _write_inputs(spark, f, f"{tmp_dir}/in")
    # Duplicate keys in the balance file: that table fails, the others load.
    dup = f.ft_balance_f.unionByName(f.ft_balance_f)
    CSV.write_detail_csv(dup, f"{tmp_dir}/in/ft_balance_f.csv")
    res = J.load_detail(spark, f"{tmp_dir}/in", f"{tmp_dir}/ds", f"{tmp_dir}/logs", partition_by={})
    assert res["ft_balance_f"] == "error" and res["ft_posting_f"] == "ok"
    assert J.read_log(spark, f"{tmp_dir}/logs").filter(F.col("status") == "ERROR").count() == 1


def test_mirror_job_applies_only_pending_folders(spark, tmp_dir):
    f = Fixtures(spark, SF)
    deltas = f.mirror_delta
    ids = sorted(r.delta_id for r in deltas.select("delta_id").distinct().collect())[:4]
    for i in ids[:3]:
        (deltas.filter(F.col("delta_id") == i).drop("delta_id").coalesce(1)
         .write.option("header", True).option("sep", ";").csv(f"{tmp_dir}/deltas/{i}/events.csv"))
    schema = "user_id BIGINT, event_type STRING, event_id BIGINT, value DECIMAL(15,2)"
    keys = ["user_id", "event_type"]
    args = (f"{tmp_dir}/deltas", "events", keys, f"{tmp_dir}/mirror", f"{tmp_dir}/log.csv", f"{tmp_dir}/export")
    assert J.run_mirror(spark, *args, schema=schema) == ids[:3]
    assert J.run_mirror(spark, *args, schema=schema) == []
    (deltas.filter(F.col("delta_id") == ids[3]).drop("delta_id").coalesce(1)
     .write.option("header", True).option("sep", ";").csv(f"{tmp_dir}/deltas/{ids[3]}/events.csv"))
    assert J.run_mirror(spark, *args, schema=schema) == [ids[3]]
    want = MI.mirror_apply(None, deltas.filter(F.col("delta_id").isin(ids)), keys)
    got = J.read_mirror(spark, f"{tmp_dir}/mirror", "events", keys,
                        MI.read_batches(spark, f"{tmp_dir}/deltas", "events", schema, ids).schema)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    log = MI.read_load_log(spark, f"{tmp_dir}/log.csv")
    assert sorted(r.ID for r in log.collect()) == ids
    exported = spark.read.option("header", True).option("sep", ";").csv(f"{tmp_dir}/export")
    assert exported.count() == want.count()


def test_posting_report_file(spark, tmp_dir):
    from tallyspark.operators import stats as ST
    post = Fixtures(spark, SF).ft_posting_f
    path = ST.write_posting_report(post, tmp_dir, "1998-09-15")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert path.endswith("output_1998-09-15.csv") and len(lines) == 5 and lines[0] == "On date: 1998-09-15"
    assert ST.write_posting_report(post, tmp_dir, "2018-13-45") is None
    assert ST.write_posting_report(post, tmp_dir, "15.09.1998") is None
    assert ST.write_posting_report(post, tmp_dir, "1970-01-01") is None


def test_turnover_range_fill_replaces_days_and_clears_empty_ones(spark, tmp_dir):
    f = Fixtures(spark, SF)
    detail = {"ft_posting_f": f.ft_posting_f, "md_account_d": f.md_account_d,
              "md_exchange_rate_d": f.md_exchange_rate_d}
    marts = f"{tmp_dir}/dm"
    root = f"{marts}/dm_account_turnover_f"
    # A stale day inside the range and a day outside it.
    stale = TO.account_turnover(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d, DAY)
    from tallyspark.sinks import files as FS
    FS.replace_partition(stale, root, {"on_date": dt.date(1998, 7, 20)})
    FS.replace_partition(stale, root, {"on_date": dt.date(1998, 10, 20)})
    res = J.fill_turnover_range(spark, detail, marts, dt.date(1998, 7, 15), dt.date(1998, 9, 30))
    got = FS.read_partitioned(spark, root, S.DM_ACCOUNT_TURNOVER_F)
    want = TO.account_turnover_range(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d,
                                     dt.date(1998, 7, 15), dt.date(1998, 9, 30))
    inside = got.filter(F.col("on_date") <= dt.date(1998, 9, 30))
    assert inside.count() == want.count() == res["rows"]
    assert inside.exceptAll(want).count() == 0
    assert got.filter(F.col("on_date") == dt.date(1998, 10, 20)).count() == stale.count()
    assert res["days_cleared"] == 1  # the stale 1998-07-20 folder
    assert got.filter(F.col("on_date") == dt.date(1998, 7, 20)).count() == 0


def test_second_load_shuffles_stored_rows_once_and_uncombined(spark, tmp_path, request):
    key = "spark.sql.autoBroadcastJoinThreshold"
    request.addfinalizer(lambda before=spark.conf.get(key): spark.conf.set(key, before))
    spark.conf.set(key, "-1")
    schema = dict(CSV.DETAIL_FILES)["ft_balance_f"]
    rows = [(dt.date(2018, 1, 31), i, 643, Decimal(i)) for i in range(20)]
    TB.append_load(spark.createDataFrame(rows, schema), str(tmp_path), "ft_balance_f", 1)
    late = [(d, rk, 840, b + 1) for d, rk, _, b in rows[::2]]
    TB.append_load(spark.createDataFrame(late, schema), str(tmp_path), "ft_balance_f", 2)
    file = spark.createDataFrame([(*r[:2], Decimal(7)) for r in [*rows, (None, 1, 0, 0)]], "on_date date, account_rk int, balance_out decimal(23,8)")
    out = J._with_old_values(spark, file.repartition("on_date", "account_rk"), str(tmp_path), "ft_balance_f", schema)
    # The stored rows carry no column that the file has, and the aggregate's partitions serve the join.
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") <= 2 and "partial_max_by" in plan
    scan = next(line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line)
    assert "balance_out" not in scan
    assert {(r.account_rk, r.currency_rk) for r in out.collect() if r.on_date} == {(i, 643 if i % 2 else 840) for i in range(20)}
    latest = TB.read_latest(spark, str(tmp_path), "ft_balance_f", ["on_date", "account_rk"], schema)
    assert {(r.account_rk, r.balance_out) for r in latest.collect()} == {(i, i + (i % 2 == 0)) for i in range(20)}
