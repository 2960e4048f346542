"""Property tests: set-based jobs against row-at-a-time models of the reference's loops."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyspark.operators import audit as AU
from tallyspark.operators import history as HI
from tallyspark.operators import mirror as MI
from tallyspark.operators import upsert as UP

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
D0 = dt.date(2024, 1, 1)
D1 = dt.date(2024, 2, 1)


def history_model(current: dict, rows: list):
    """The reference's loop: per file row, compare with the open version, close it and insert."""
    hist = [[k, v, D0, True] for k, v in current.items()]
    for k, v in rows:
        open_rows = [h for h in hist if h[0] == k and h[3]]
        if open_rows:
            if open_rows[0][1] == v:
                continue
            open_rows[0][3] = False
        hist.append([k, v, D1, True])
    return sorted(tuple(h) for h in hist)


@settings(**SETTINGS)
@given(current=st.dictionaries(st.integers(0, 4), st.integers(0, 3), max_size=4),
       rows=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), max_size=12))
def test_versioned_import_matches_row_loop(spark, current, rows):
    hist = spark.createDataFrame([(k, Decimal(v), D0, True) for k, v in current.items()],
                                 "id INT, amount DECIMAL(23,8), insert_date DATE, actuality BOOLEAN")
    inc = spark.createDataFrame([(k, i, str(v)) for i, (k, v) in enumerate(rows)], "id INT, seq BIGINT, amount STRING")
    want = history_model(current, rows)
    for width in (1 << 20, 2):  # one bucket per key, and keys split over many buckets
        got = HI.versioned_import(hist, inc, ["id"], {"amount": "decimal(23,8)"}, D1, bucket_width=width)
        got = sorted((r.id, int(r.amount), r.insert_date, r.actuality) for r in got.collect())
        assert got == want


def mirror_model(snapshot: dict, batches: list):
    state = dict(snapshot)
    for bid in sorted({b for b, _, _ in batches}):
        for b, k, v in batches:
            if b == bid:
                state[k] = v
    return sorted(state.items())


@settings(**SETTINGS)
@given(snapshot=st.dictionaries(st.sampled_from("abcde"), st.integers(0, 9), max_size=4),
       batches=st.dictionaries(st.tuples(st.sampled_from(["1", "10", "2", "9"]), st.sampled_from("abcde")),
                               st.integers(0, 9), max_size=10))
def test_mirror_one_pass_equals_sequential_merges(spark, snapshot, batches):
    rows = [(b, k, v) for (b, k), v in batches.items()]
    snap = spark.createDataFrame(list(snapshot.items()), "k STRING, v INT")
    delta = spark.createDataFrame(rows, "delta_id STRING, k STRING, v INT")
    got = sorted((r.k, r.v) for r in MI.mirror_apply(snap, delta, ["k"]).collect())
    assert got == mirror_model(snapshot, rows)


@settings(**SETTINGS)
@given(target=st.dictionaries(st.integers(0, 9), st.integers(0, 9), max_size=6),
       incoming=st.dictionaries(st.integers(0, 9), st.integers(0, 9), max_size=6))
def test_upsert_matches_dict_update_and_is_idempotent(spark, target, incoming):
    t = spark.createDataFrame(list(target.items()), "id INT, v INT")
    i = spark.createDataFrame(list(incoming.items()), "id INT, v INT")
    once = UP.keyed_upsert(t, i, ["id"])
    want = dict(target)
    want.update(incoming)
    assert sorted(tuple(r) for r in once.collect()) == sorted(want.items())
    assert sorted(tuple(r) for r in UP.keyed_upsert(once, i, ["id"]).collect()) == sorted(want.items())


@settings(**SETTINGS)
@given(texts=st.lists(st.text(alphabet="abé中", max_size=23), max_size=8))
def test_split_messages_matches_piece_loop(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id INT, text STRING")
    got = [(r.record_id, r.doc_id, r.piece_no, r.message)
           for r in AU.split_messages(docs, "text", ["doc_id"], first_id=5, size=4, bounds=[1, 3, 4])
           .orderBy("record_id").collect()]
    want, rid = [], 5
    for i, t in enumerate(texts):
        rest, p = t, 0
        while len(rest) > 0:
            want.append((rid, i, p, rest[:4]))
            rest, p, rid = rest[4:], p + 1, rid + 1
    assert got == want


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 40)), max_size=30, unique=True))
def test_neighbours_in_key_match_a_per_key_scan(spark, rows):
    from tallyspark.operators.sequence import neighbours_in_key
    df = spark.createDataFrame(rows, "k STRING, s INT")
    got = sorted((r.k or "", r.s, r._prev.s if r._prev else None, r._next.s if r._next else None)
                 for r in neighbours_in_key(df, ["k"], "s", ["s"], bucket_width=3).collect())
    want = []
    for k in {k for k, _ in rows}:
        seqs = sorted(s for kk, s in rows if kk == k)
        for i, s in enumerate(seqs):
            want.append((k or "", s, seqs[i - 1] if i else None, seqs[i + 1] if i + 1 < len(seqs) else None))
    assert got == sorted(want)


def test_hot_key_spread_over_buckets_keeps_exact_neighbours(spark):
    """One key holds a third of the rows; with 1,000-wide buckets it spans 20 window groups."""
    from pyspark.sql import functions as F

    from tallyspark.operators.sequence import neighbours_in_key
    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        F.col("id").alias("s"))
    out = neighbours_in_key(df, ["k"], "s", ["s"], bucket_width=1000)
    hot = out.filter("k = 0")
    assert hot.count() == n // 3
    bad = hot.filter(~((F.col("_prev").isNull() & (F.col("s") == 0)) | (F.col("_prev.s") == F.col("s") - 3)))
    assert bad.count() == 0
    bad_next = hot.filter(~((F.col("_next").isNull() & (F.col("s") == n - 3)) | (F.col("_next.s") == F.col("s") + 3)))
    assert bad_next.count() == 0


def test_versioned_import_with_a_hot_key(spark):
    """Many versions of one key in one file, alternating values: every change is a new version."""
    from pyspark.sql import functions as F
    hist = spark.createDataFrame([(0, Decimal(0), D0, True)],
                                 "id INT, amount DECIMAL(23,8), insert_date DATE, actuality BOOLEAN")
    rows = 5_000
    inc = spark.range(rows).select(F.lit(0).alias("id"), F.col("id").alias("seq"),
                                   (F.floor(F.col("id") / 2) % 2).cast("string").alias("amount"))
    out = HI.versioned_import(hist, inc, ["id"], {"amount": "decimal(23,8)"}, D1, bucket_width=64)
    # Values 0,0,1,1,0,0,...: a change every second row, the first pair equals the open version.
    assert out.count() == 1 + (rows // 2 - 1)
    assert out.filter("actuality").count() == 1
    last = (rows - 1) // 2 % 2
    assert out.filter("actuality").first().amount == Decimal(last)


def test_consecutive_ids_with_sparse_ids_and_few_buckets(spark):
    from pyspark.sql import functions as F
    df = spark.range(1000).select((F.col("id") * 1_000_000_000_007).alias("doc"), F.lit(0).alias("piece"))
    out = AU.consecutive_ids(df, ["doc", "piece"], "rid", start=10, bounds=AU.quantile_bounds(df, "doc", 4))
    got = [r.rid for r in out.orderBy("doc").collect()]
    assert got == list(range(10, 1010))


def test_an_outlying_id_leaves_the_buckets_balanced(spark):
    from pyspark.sql import functions as F
    far = 9_000_000_000_000_000_000
    df = spark.range(20_000).select(F.when(F.col("id") == 7, far).when(F.col("id") == 8, -far).otherwise(F.col("id")).alias("doc"))
    bounds = AU.quantile_bounds(df, "doc", 100)
    sizes = [r["count"] for r in df.groupBy(AU.bucket_of(F.col("doc"), bounds)).count().collect()]
    assert len(sizes) == 100 and max(sizes) <= 2 * min(sizes)
    out = AU.consecutive_ids(df, ["doc"], "rid", bounds=bounds).orderBy("doc").collect()
    assert [r.rid for r in out] == list(range(1, 20_001)) and out[0].doc == -far and out[-1].doc == far


def test_bounds_of_other_types_and_null_order_values(spark):
    from pyspark.sql import functions as F
    days = spark.range(500).select(F.when(F.col("id") < 490, F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int"))).alias("day"), "id")
    out = AU.consecutive_ids(days, ["day", "id"], "rid", bounds=AU.quantile_bounds(days, "day", 8)).orderBy("rid").collect()
    assert [r.rid for r in out] == list(range(1, 501)) and [r.id for r in out] == [*range(490, 500), *range(490)]
    money = spark.range(100).select((F.col("id") * 1.5).cast("decimal(10,2)").alias("m"), "id")
    assert [r.id for r in AU.consecutive_ids(money, ["m"], "rid", bounds=AU.quantile_bounds(money, "m", 5)).orderBy("rid").collect()] == list(range(100))


def test_the_text_is_scanned_once(spark):
    import re
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = AU.split_messages(docs, "text", ["doc_id"])
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall("FileScan", final)) == 1 and final.count("ReusedExchange") == 1


@settings(**{**SETTINGS, "max_examples": 4})
@given(current=st.dictionaries(st.integers(0, 4), st.integers(0, 3), max_size=4),
       files=st.lists(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), max_size=8), min_size=1, max_size=2))
def test_appended_changes_equal_rewritten_history(spark, current, files):
    from pyspark.sql import functions as F

    from tallyspark.operators.upsert import latest_per_key
    cols = "id INT, amount DECIMAL(23,8), insert_date DATE, actuality BOOLEAN"
    hist = spark.createDataFrame([(k, Decimal(v), D0, True) for k, v in current.items()], cols)
    store = spark.createDataFrame([(k, Decimal(v), D0, True, 0, i, 0) for i, (k, v) in enumerate(current.items())],
                                  cols + ", _rload BIGINT, _rseq BIGINT, _load BIGINT")
    rewritten = hist
    for n, rows in enumerate(files, start=1):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=n)
        inc = spark.createDataFrame([(k, i, str(v)) for i, (k, v) in enumerate(rows)],
                                    "id INT, seq BIGINT, amount STRING")
        state = latest_per_key(store, ["_rload", "_rseq"], "_load").drop("_load")
        changes = HI.versioned_changes(state, inc, ["id"], {"amount": "decimal(23,8)"}, day, ("_rload", "_rseq"), n)
        store = store.unionByName(changes.withColumn("_load", F.lit(n).cast("bigint")))
        rewritten = HI.versioned_import(rewritten, inc, ["id"], {"amount": "decimal(23,8)"}, day)
        store = spark.createDataFrame(store.collect(), store.schema)  # keep the test plan small
    final = latest_per_key(store, ["_rload", "_rseq"], "_load")
    got = sorted((r.id, r.amount, r.insert_date, r.actuality) for r in final.collect())
    want = sorted((r.id, r.amount, r.insert_date, r.actuality) for r in rewritten.collect())
    assert got == want
