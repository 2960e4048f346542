"""WARC source: round trips, pushed-down predicates, payloads that are not decoded, and revisits against a plain version."""

import base64
import glob
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import warc as W

SCHEMA = "page_id BIGINT, url STRING, html STRING"
DATE = "2024-01-01T00:00:00Z"


@pytest.fixture(autouse=True)
def source(spark):
    from tallyspark.llm.shared import reach_workers
    reach_workers(spark)
    W.register(spark)


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(rows, least=0):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if page is not None and (body not in first or page < first[body]):
            first[body] = page
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        at = first.get(body) if len(body) >= least else None
        again = at is not None and at != page
        out.append((page, len(body), digest(body), "revisit" if again else "response", at if again else None))
    return sorted(out, key=str)


def round_trip(spark, rows, path, least=0):
    W.archive_pages(spark.createDataFrame(rows, SCHEMA), path, DATE, least)
    return sorted((tuple(r) for r in W.read_pages(spark, path).collect()), key=str)


PAGES = [(i, f"http://x/{i}", f"<p>page {i % 7} ü\r\n\r\nWARC/1.1</p>" * (i % 5)) for i in range(60)] + [
    (100, None, None), (-5, "a b\r\nc: d", ""), (None, "u", "<p>alone</p>"), (None, "u", "<p>both</p>"), (101, "v", "<p>both</p>"),
    (102, "w", "x" * 300_000), (103, "w", "x" * 300_000), (103, "w", "x" * 300_000), ((1 << 40) + 3, "big", "<p>page 1"), (7, "twice", "<p>page 1")]


@pytest.mark.parametrize("least", [0, 50])
def test_round_trip_equals_the_plain_version(spark, tmp_dir, least):
    assert round_trip(spark, PAGES, tmp_dir + "/a", least) == brute(PAGES, least)


def test_payloads_above_and_below_the_broadcast_share(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(W, "HOT", 4)
    rows = [(i, "u", "hot" if i % 3 == 0 else f"cold {i % 20}") for i in range(200, 0, -1)]
    assert round_trip(spark, rows, tmp_dir + "/a") == brute(rows)


def test_empty_table_and_clashing_columns(spark, tmp_dir):
    assert round_trip(spark, [], tmp_dir + "/a") == []
    df = spark.createDataFrame([(1, "u", "h", 3)], SCHEMA + ", payload INT")
    W.archive_pages(df, tmp_dir + "/b", DATE)
    assert W.read_pages(spark, tmp_dir + "/b").count() == 1
    with pytest.raises(ValueError, match="exist already"):
        W.with_revisits(df, "page_id", F.col("html"))


def test_all_fields_come_back(spark, tmp_dir):
    W.archive_pages(spark.createDataFrame([(5, "http://x/ü", "<b>"), (6, "http://y", "<b>")], SCHEMA), tmp_dir + "/a", DATE)
    rows = {r.target_uri: r for r in spark.read.format("warc").load(tmp_dir + "/a").filter("record_type <> 'warcinfo'").collect()}
    one, two = rows["http://x/ü"], rows["http://y"]
    assert (one.record_id, one.record_type, one.date, bytes(one.payload), one.payload_bytes) == (
        "<urn:uuid:00000000-0000-8000-0000-000000000005>", "response", DATE, b"<b>", 3)
    assert (two.record_type, two.refers_to, bytes(two.payload), two.payload_digest) == ("revisit", one.record_id, b"", "sha1:" + digest(b"<b>"))


def test_predicates_are_pushed_and_filter_as_spark_does(spark, tmp_dir):
    W.archive_pages(spark.createDataFrame(PAGES, SCHEMA), tmp_dir + "/a", DATE)
    df = spark.read.format("warc").option("headers", W.PAGE_HEADERS).load(tmp_dir + "/a")
    every = [r.asDict() for r in df.collect()]
    cases = {
        "record_type = 'revisit'": lambda r: r["record_type"] == "revisit",
        "record_type IN ('response', 'metadata')": lambda r: r["record_type"] == "response",
        "record_type <> 'response'": lambda r: r["record_type"] != "response",
        "target_uri LIKE 'http://x/1%'": lambda r: (r["target_uri"] or "").startswith("http://x/1"),
        "target_uri IS NULL": lambda r: r["target_uri"] is None,
        "refers_to IS NOT NULL AND target_uri >= 'http://x/3'": lambda r: r["refers_to"] is not None and (r["target_uri"] or "") >= "http://x/3",
        "page_id = '102'": lambda r: r["page_id"] == "102",
        "payload_bytes > 100": lambda r: r["payload_bytes"] > 100,
    }
    for condition, test in cases.items():
        assert sorted(r.record_id for r in df.filter(condition).collect()) == sorted(r["record_id"] for r in every if test(r)), condition
    # Only the predicate on a payload is left to Spark.
    plan = df.filter("record_type = 'revisit' AND payload_bytes = 0")._jdf.queryExecution().executedPlan().toString()
    left = [line for line in plan.splitlines() if "Filter" in line and "BatchScan" not in line]
    assert left and all("record_type" not in line and "payload_bytes" in line for line in left)


def wanted(head):
    return head["warc-type"] == "revisit"


def archive(records, packed, skip=True):
    blocks = [W._record(kind, fields, content) for kind, fields, content in records]
    return b"".join((W._member(b) if skip else gzip.compress(b)) if packed else b for b in blocks)


RECORDS = [("response", [("Content-Type", "application/http; msgtype=response"), ("X", "1")], W.HTTP_HEAD % 200_000 + bytes(range(250)) * 800),
           ("revisit", [("X", "2")], b"abc"), ("resource", [("Content-Type", "text/plain")], b"\r\n\r\nWARC/1.1\r\n\r\n"), ("revisit", [], b"")]


@pytest.mark.parametrize("packed, skip", [(False, False), (True, True), (True, False)])
def test_records_of_any_writer(packed, skip):
    data = archive(RECORDS, packed, skip)
    read = lambda *a: list((W._Gzipped if packed else W._Plain)(io.BytesIO(data)).records(*a))
    assert [(h["warc-type"], c) for h, c in read(lambda h: True)] == [(k, c) for k, _, c in RECORDS]
    assert [c for _, c in read(wanted)] == [b"abc", b""]
    assert [c for _, c in read(lambda h: True, False)] == [b""] * 4


def test_unwanted_payloads_are_not_inflated():
    big = [("response", [], hashlib.sha512(str(i).encode()).digest() * 20_000) for i in range(20)] + [("revisit", [], b"abc")]
    for skip, most in ((True, 20 * W.READ_BYTES), (False, 1 << 40)):
        file = W._Gzipped(io.BytesIO(archive(big, True, skip)))
        assert [c for _, c in file.records(wanted)] == [b"abc"]
        assert file.inflated < most and (skip or file.inflated > 20 * 64 * 20_000)


def test_gzip_members_are_valid():
    assert gzip.decompress(archive(RECORDS, True)) == archive(RECORDS, False)


def test_cut_archives_fail():
    for packed in (False, True):
        data = archive(RECORDS, packed)[:-30]
        with pytest.raises(ValueError, match="ends inside"):
            list((W._Gzipped if packed else W._Plain)(io.BytesIO(data[:len(data) - 200])).records(lambda h: True))


def test_headers_on_several_lines():
    assert W._parsed_head(b"WARC/1.0\r\nWARC-Type: response\r\nX: a\r\n  b") == {"warc-type": "response", "x": "a b"}
    assert W._parsed_head(b"HTTP/1.1 200 OK") is None


def test_files_roll_and_share_partitions(spark, tmp_dir):
    df = spark.createDataFrame([(i, "u", hashlib.sha512(str(i).encode()).hexdigest() * 50) for i in range(40)], SCHEMA).coalesce(1)
    rows = W.with_revisits(df, "page_id", F.col("html")).select("record_type", "payload")
    rows.coalesce(1).write.format("warc").option("file_bytes", 2000).mode("append").save(tmp_dir + "/a")
    files = glob.glob(tmp_dir + "/a/*.warc.gz")
    assert len(files) > 3 and not any("_writing" in f for f in files)
    read = lambda n: spark.read.format("warc").option("partition_bytes", n).load(tmp_dir + "/a").filter("record_type = 'response'")
    assert read(1).rdd.getNumPartitions() == len(files) and read(1 << 30).rdd.getNumPartitions() == 1
    assert read(1).count() == read(1 << 30).count() == 40


def test_single_plain_file_is_read(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(archive(RECORDS, False))
    df = spark.read.format("warc").option("payload", "false").option("headers", "X").load(str(tmp_path / "x.warc"))
    assert [(r.record_type, r.x) for r in df.collect()] == [("response", "1"), ("revisit", "2"), ("resource", None), ("revisit", None)]
    with pytest.raises(Exception, match="exist already"):
        spark.read.format("warc").option("headers", "Payload").load(str(tmp_path / "x.warc"))
