"""Streaming mirror: folders arriving out of name order give the batch-mode result."""

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import mirror as MI
from tallyspark.plans import jobs as JB
from tallyspark.sources.fixtures import Fixtures
from tallyspark.streaming import mirror_stream as MS

SF = "/root/testdata/sf0.001"
SCHEMA = "user_id BIGINT, event_type STRING, event_id BIGINT, value DECIMAL(15,2)"
KEYS = ["user_id", "event_type"]


def _write(deltas, root, i):
    (deltas.filter(F.col("delta_id") == i).drop("delta_id").coalesce(1)
     .write.option("header", True).option("sep", ";").csv(f"{root}/{i}/events.csv"))


def test_stream_matches_batch_merge_regardless_of_arrival_order(spark, tmp_dir):
    deltas = Fixtures(spark, SF).mirror_delta
    ids = sorted(r.delta_id for r in deltas.select("delta_id").distinct().collect())[:4]
    root = f"{tmp_dir}/deltas"
    # Newest folders first, then older ones in a second run.
    for i in (ids[3], ids[2]):
        _write(deltas, root, i)
    q = MS.start_mirror_stream(spark, root, "events", KEYS, SCHEMA, f"{tmp_dir}/mirror", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    for i in (ids[1], ids[0]):
        _write(deltas, root, i)
    q = MS.start_mirror_stream(spark, root, "events", KEYS, SCHEMA, f"{tmp_dir}/mirror", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    got = MS.read_mirror(spark, f"{tmp_dir}/mirror", "events", KEYS, SCHEMA)
    want = MI.mirror_apply(None, deltas.filter(F.col("delta_id").isin(ids)), KEYS)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


SMALL = "id INT, v STRING, w INT"


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def stream(spark, root, **options):
    q = MS.start_mirror_stream(spark, f"{root}/d", "t", ["id"], SMALL, f"{root}/sm", f"{root}/ckpt", log_path=f"{root}/slog", export_path=f"{root}/sx", **options)
    q.awaitTermination()


def state(spark, root, store="sm", log="slog"):
    rows = sorted(map(tuple, MS.read_mirror(spark, f"{root}/{store}", "t", ["id"], SMALL).collect()))
    return rows, sorted((r.ID, r.TABLE) for r in MI.read_load_log(spark, f"{root}/{log}").collect())


def test_stream_has_the_rows_and_log_of_the_batch_job(spark, tmp_path):
    put(tmp_path / "d" / "001", "t.csv", "id;w;v", "1;5;a", "2;6;b")
    put(tmp_path / "d" / "003", "t.csv", "V; ID", "c;2", "007;3")
    put(tmp_path / "d" / "004", "t.csv", "id;v;w")
    stream(spark, tmp_path)
    put(tmp_path / "d" / "002" / "t.csv", "part-00000", "w;v;id", "9;late;1")
    put(tmp_path / "d" / "002" / "t.csv", "part-00001", "id;v;w", "2;late;9", "4;d;1")
    stream(spark, tmp_path, files_per_trigger=1)
    JB.run_mirror(spark, f"{tmp_path}/d", "t", ["id"], f"{tmp_path}/m", f"{tmp_path}/log", f"{tmp_path}/x", SMALL)
    rows, log = state(spark, tmp_path)
    assert (rows, log) == state(spark, tmp_path, "m", "log")
    assert rows == [(1, "late", 9), (2, "c", None), (3, "007", None), (4, "d", 1)] and [i for i, _ in log] == ["001", "002", "003", "004"]
    read = lambda name: sorted(map(tuple, spark.read.csv(f"{tmp_path}/{name}", header=True, sep=";").collect()))
    assert read("sx") == read("x")


def test_a_value_that_does_not_parse_fails_the_epoch(spark, tmp_path):
    put(tmp_path / "d" / "001", "t.csv", "id;v;w", "1;a;5")
    stream(spark, tmp_path)
    before = state(spark, tmp_path)
    put(tmp_path / "d" / "002", "t.csv", "id;v;w", "2;b;oops")
    with pytest.raises(Exception, match="not a int"):
        stream(spark, tmp_path)
    assert state(spark, tmp_path) == before
    # Mended, the folder is taken up by the next run.
    put(tmp_path / "d" / "002", "t.csv", "id;v;w", "2;b;6")
    stream(spark, tmp_path)
    assert state(spark, tmp_path) == ([(1, "a", 5), (2, "b", 6)], [("001", "t"), ("002", "t")])


def test_a_replayed_epoch_adds_nothing(spark, tmp_path):
    put(tmp_path / "d" / "001", "t.csv", "id;v;w", "1;a;5", ";null key;1")
    batch = spark.createDataFrame([("001",), ("001",)], "delta_id STRING")
    args = (f"{tmp_path}/d", "t", ["id"], f"{tmp_path}/sm", f"{tmp_path}/slog", SMALL)
    for _ in range(2):
        MS.apply_epoch(batch, *args)
    rows = MS.read_mirror(spark, f"{tmp_path}/sm", "t", ["id"], SMALL)
    assert rows.count() == 2 and MI.read_load_log(spark, f"{tmp_path}/slog").count() == 1
    MS.apply_epoch(batch.limit(0), *args)
    assert MI.read_load_log(spark, f"{tmp_path}/slog").count() == 1


def test_many_folders_are_one_scan(spark, tmp_path):
    """A thousand batches with headers in two orders: one plan that scans all files once."""
    for i in range(1000):
        head, line = ("id;v;w", f"{i % 10};x{i};{i}") if i % 2 else ("w;id;v", f"{i};{i % 10};x{i}")
        put(tmp_path / "d" / f"{i:04d}", "t.csv", head, line)
    ids = [f"{i:04d}" for i in range(1000)]
    df = MI.read_batches(spark, f"{tmp_path}/d", "t", SMALL, ids)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert sorted((r.delta_id, r.id, r.v, r.w) for r in df.collect()) == [(i, n % 10, f"x{n}", n) for n, i in enumerate(ids)]


def test_odd_file_names_and_empty_files(spark, tmp_path):
    put(tmp_path / "d x" / "a b%20c", "t.csv", "id;v;w", "1;a;5")
    (tmp_path / "d x" / "e").mkdir()
    (tmp_path / "d x" / "e" / "t.csv").write_text("")
    df = MI.read_batches(spark, f"{tmp_path}/d x", "t", SMALL, ["a b%20c", "e"])
    assert list(map(tuple, df.collect())) == [(1, "a", 5, "a b%20c")]
