"""The message log: consecutive ids for any number of writers, without reading the log."""

import threading

from tallyspark.plans import jobs as J


def test_writers_at_the_same_time_get_ids_of_their_own(spark, tmp_path):
    texts = ["a" * 9000, "", None, "b"]
    threads = [threading.Thread(target=J.writelog, args=(spark, str(tmp_path), texts)) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = J.read_messages(spark, str(tmp_path)).orderBy("record_id").collect()
    assert [r.record_id for r in rows] == list(range(1, 25))
    # The pieces of a call follow each other.
    assert [len(r.message) for r in rows] == [4000, 4000, 1000, 1] * 6


def test_ids_come_from_reservations_not_from_the_log(spark, tmp_path):
    J.writelog(spark, str(tmp_path), ["x", "y"])
    for f in (tmp_path / "lg_messages").rglob("*.parquet"):
        f.write_bytes(b"unreadable")
    assert J.reserve_ids(spark, str(tmp_path), 3) == 3 and J.reserve_ids(spark, str(tmp_path), 1) == 6
    J.writelog(spark, str(tmp_path), [])
    assert J.reserve_ids(spark, str(tmp_path), 1) == 7


def test_a_cut_off_reservation_is_waited_for(spark, tmp_path):
    folder = tmp_path / "lg_messages_ids"
    folder.mkdir()
    (folder / f"{1:020d}").write_text("")
    timer = threading.Timer(0.5, lambda: (folder / f"{1:020d}").write_text("4"))
    timer.start()
    assert J.reserve_ids(spark, str(tmp_path), 2) == 5
