"""What the file jobs do with odd files: column order, missing columns, bad values, failed writes, replays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators import mirror as MI
from tallyspark.operators import upsert as UP
from tallyspark.plans import jobs as J
from tallyspark.plans import tables as TB
from tallyspark.session import ensure_checkpoint_dir
from tallyspark.sinks import files as FS
from tallyspark.sources import csv as CSV

HEAD = {"ft_posting_f": ";OPER_DATE;DEBET_ACCOUNT_RK;CREDIT_ACCOUNT_RK;DEBET_AMOUNT;CREDIT_AMOUNT"}


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def load(spark, tmp_path, folder, *tables):
    return J.load_detail(spark, folder, f"{tmp_path}/ds", f"{tmp_path}/logs", tables=list(tables))


def test_columns_are_matched_by_name(spark, tmp_path):
    folder = put(tmp_path / "in", "ft_posting_f", HEAD["ft_posting_f"], "1;1998-09-15;20;10;2.50;1.25")
    assert load(spark, tmp_path, folder, "ft_posting_f") == {"ft_posting_f": "ok"}
    row = J.detail_tables(spark, f"{tmp_path}/ds", ["ft_posting_f"])["ft_posting_f"].first()
    assert (row.credit_account_rk, row.debet_account_rk, str(row.credit_amount), str(row.debet_amount)) == (10, 20, "1.25", "2.50")


def test_constraints_fail_the_load(spark, tmp_path):
    head = ";data_actual_date;data_actual_end_date;account_rk;account_number;char_type;currency_rk;currency_code"
    good = "1;1998-09-01;2050-12-31;{};30101;A;5;840"
    for bad in ("1;1998-09-01;2050-12-31;1;" + "9" * 23 + ";A;5;840", "1;1998-09-01;2050-12-31;1;30101;AB;5;840",
                "1;1998-09-01;2050-12-31;1;30101;A;;840", "1;1998-09-01;2050-12-31;;30101;A;5;840"):
        folder = put(tmp_path / "in", "md_account_d", head, good.format(7), bad)
        assert load(spark, tmp_path, folder, "md_account_d") == {"md_account_d": "error"}
    stored = J.detail_tables(spark, f"{tmp_path}/ds", ["md_account_d"])["md_account_d"]
    assert stored is None or stored.count() == 0
    # The whole error is in the message log.
    assert J.read_messages(spark, f"{tmp_path}/logs").count() >= 4


def test_a_value_that_its_type_cannot_hold_fails(spark, tmp_path):
    head = ";DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_RK;REDUCED_COURCE;CODE_ISO_NUM"
    for value in ("0.12345678", "1e30", "oops"):
        folder = put(tmp_path / "in", "md_exchange_rate_d", head, f"1;1998-09-01;2050-12-31;5;{value};036")
        assert load(spark, tmp_path, folder, "md_exchange_rate_d") == {"md_exchange_rate_d": "error"}
    folder = put(tmp_path / "in", "md_exchange_rate_d", head, "1;1998-09-01;2050-12-31;5;0.123450;036")
    assert load(spark, tmp_path, folder, "md_exchange_rate_d") == {"md_exchange_rate_d": "ok"}


def test_uniqueness_is_checked_whatever_is_asked_for(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id int, s string")
    for ask in (lambda d: d.count(), lambda d: d.select("id").collect(), lambda d: d.collect()):
        with pytest.raises(Exception, match="not unique"):
            ask(UP.unique_on(df, ["id"]))
    assert UP.unique_on(df.filter("s <> 'a'"), ["id"]).count() == 3


def test_failed_replace_leaves_the_old_rows(spark, tmp_path):
    root, spec = f"{tmp_path}/mart", {"on_date": dt.date(1998, 9, 15)}
    old = spark.createDataFrame([(1,), (2,)], "v int")
    FS.replace_partition(old, root, spec)
    with pytest.raises(Exception, match="stop"):
        FS.replace_partition(old.withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("v"))), root, spec)
    assert spark.read.parquet(root).count() == 2
    FS.replace_partition(old.limit(0), root, spec)
    assert spark.read.schema("v int, on_date date").parquet(root).count() == 0
    assert [p.name for p in (tmp_path / "mart").iterdir() if p.name.startswith("_")] == []


def test_file_order_over_part_files(spark, tmp_path):
    folder = tmp_path / "parts"
    put(folder, "part-00000", "k;v", "1;first")
    put(folder, "part-00001", "k;v", *[f"1;second{i:04d}{'x' * 200}" for i in range(300)])
    rows = CSV.read_text_rows(spark, str(folder)).orderBy("seq").collect()
    assert rows[0].v == "first" and [r.v[:10] for r in rows[1:]] == [f"second{i:04d}" for i in range(300)]


def test_load_ids_grow_when_the_clock_falls_back(spark, tmp_path):
    future = 9_000_000_000_000_000
    TB.append_load(spark.createDataFrame([(1, "old")], "k int, s string"), str(tmp_path), "t", future)
    assert TB.new_load_id(spark, str(tmp_path), ["t", "none"]) == future + 1


def test_mirror_reads_by_name_and_logs_empty_batches(spark, tmp_path):
    schema = "id INT, v STRING, w INT"
    args = (f"{tmp_path}/d", "t", ["id"], f"{tmp_path}/m", f"{tmp_path}/log", f"{tmp_path}/x", spark.createDataFrame([], schema).schema)
    put(tmp_path / "d" / "001", "t", "id;w;v", "1;5;a", "2;6;b")
    put(tmp_path / "d" / "002", "t", "id;v;w")
    assert J.run_mirror(spark, *args) == ["001", "002"]
    full = MI.read_batches(spark, args[0], "t", args[-1], ["001"]).schema
    assert sorted(map(tuple, J.read_mirror(spark, args[3], "t", ["id"], full).collect())) == [(1, "a", 5), (2, "b", 6)]
    assert sorted(r.ID for r in MI.read_load_log(spark, args[4]).collect()) == ["001", "002"]
    # A batch applied again, as after a crash before the log, adds no row; NULL keys included.
    rows = MI.read_batches(spark, args[0], "t", args[-1], ["001"]).unionByName(
        spark.createDataFrame([(None, "n", 1, "001")], "id INT, v STRING, w INT, delta_id STRING"))
    for _ in range(2):
        J.write_batches(rows, ["id"], args[3], "t")
    assert J.read_mirror(spark, args[3], "t", ["id"], full).count() == 3
    put(tmp_path / "d" / "003", "t", "id;v;w", "oops;a;1")
    with pytest.raises(Exception, match="not a int"):
        J.run_mirror(spark, *args)


def test_import_rejects_bad_keys_and_versions_measures(spark, tmp_path):
    cols = S.REPORT_COLUMNS
    def line(day, acct, first="0"):
        return ";".join([day, "1998-09-30", "A", acct, "A", first, *["0"] * (len(cols) - 6)])
    hist, logs = f"{tmp_path}/h", f"{tmp_path}/l"
    put(tmp_path / "r1", "part-00000", ";".join(cols), line("1998-09-01", "30101", "1.5"), line("garbage", "30102"), line("1998-09-01", "30103", "x1"))
    assert J.import_report_versions(spark, str(tmp_path / "r1"), hist, logs, dt.datetime(2024, 1, 1)) == 1
    errors = [r.description for r in J.read_log(spark, logs).filter("status = 'ERROR'").collect()]
    assert any("invalid date in from_date: garbage" in e for e in errors) and any("invalid number in balance_in_rub: x1" in e for e in errors)
    # Two versions of one key in two part files: the later file wins.
    put(tmp_path / "r2", "part-00000", ";".join(cols), line("1998-09-01", "30101", "2"))
    put(tmp_path / "r2", "part-00001", ";".join(cols), line("1998-09-01", "30101", "3"))
    assert J.import_report_versions(spark, str(tmp_path / "r2"), hist, logs, dt.datetime(2024, 1, 2)) == 2
    rows = J.read_history(spark, hist).collect()
    assert len(rows) == 3 and [float(r.balance_in_rub) for r in rows if r.actuality] == [3.0]


def test_no_local_scratch_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None
        def getConf(self):
            return {}
    class Session:
        sparkContext = Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
