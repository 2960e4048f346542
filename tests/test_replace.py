"""Period replace under failures: each move failing or the process ending there leaves the old or the new rows."""

import datetime as dt

import pytest

from tallyspark.sinks import files as FS

SPEC = {"on_date": dt.date(1998, 9, 15)}
OTHER = {"on_date": dt.date(1998, 9, 16)}


class Ended(BaseException):
    """The process ends: no handler of ordinary errors runs."""


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v INT")


def table(spark, root):
    return sorted((r.v, r.on_date.day) for r in FS.read_partitioned(spark, root, spark.createDataFrame([], "v INT, on_date DATE").schema).collect())


@pytest.fixture
def root(spark, tmp_path):
    root = f"{tmp_path}/mart"
    FS.replace_partition(rows(spark, 1, 2), root, SPEC)
    FS.replace_partition(rows(spark, 9), root, OTHER)
    return root


OLD, NEW, REST = [(1, 15), (2, 15)], [(3, 15)], [(9, 16)]


def failing(monkeypatch, at, error):
    moved, calls = FS._moved, []

    def move(*a):
        calls.append(a)
        if len(calls) == at:
            raise error("stop")
        moved(*a)
    monkeypatch.setattr(FS, "_moved", move)


@pytest.mark.parametrize("at", [1, 2])
@pytest.mark.parametrize("error", [OSError, Ended])
def test_each_move_failing(spark, root, monkeypatch, at, error):
    failing(monkeypatch, at, error)
    with pytest.raises(error):
        FS.replace_partition(rows(spark, 3), root, SPEC)
    monkeypatch.undo()
    assert table(spark, root) == sorted(OLD + REST)
    # The next run restores and replaces; another period is no concern of it.
    FS.replace_partition(rows(spark, 8), root, OTHER)
    assert table(spark, root) == sorted(OLD + [(8, 16)])
    FS.replace_partition(rows(spark, 3), root, SPEC)
    assert table(spark, root) == sorted(NEW + [(8, 16)])
    FS.replace_partition(rows(spark), root, SPEC)
    assert table(spark, root) == [(8, 16)]


def test_ending_before_the_old_copy_is_removed(spark, root, monkeypatch):
    deleted = FS._deleted

    def delete(spark_, path):
        if "/old-" in path:
            raise Ended
        deleted(spark_, path)
    monkeypatch.setattr(FS, "_deleted", delete)
    with pytest.raises(Ended):
        FS.replace_partition(rows(spark, 3), root, SPEC)
    monkeypatch.undo()
    assert table(spark, root) == sorted(NEW + REST)
    FS.replace_partition(rows(spark, 4), root, SPEC)
    assert table(spark, root) == sorted([(4, 15)] + REST) and FS._old_copies(spark, root) == []


def test_moving_back_failing_too(spark, root, monkeypatch):
    moved = FS._moved

    def move(spark_, a, b):
        if "/new-" in a or b.endswith("on_date=1998-09-15") and "/old-" in a:
            raise OSError("stop")
        moved(spark_, a, b)
    monkeypatch.setattr(FS, "_moved", move)
    with pytest.raises(OSError):
        FS.replace_partition(rows(spark, 3), root, SPEC)
    monkeypatch.undo()
    assert table(spark, root) == sorted(OLD + REST)


def test_two_part_periods(spark, tmp_path, monkeypatch):
    root, spec = f"{tmp_path}/m", {"from_date": dt.date(1998, 9, 1), "to_date": dt.date(1998, 9, 30)}
    schema = spark.createDataFrame([], "v INT, from_date DATE, to_date DATE").schema
    FS.replace_partition(rows(spark, 1), root, spec)
    failing(monkeypatch, 2, Ended)
    with pytest.raises(Ended):
        FS.replace_partition(rows(spark, 2), root, spec)
    monkeypatch.undo()
    assert [tuple(r) for r in FS.read_partitioned(spark, root, schema).collect()] == [(1, *spec.values())]
    FS.replace_partition(rows(spark, 2), root, spec)
    assert [r.v for r in FS.read_partitioned(spark, root, schema).collect()] == [2]


@pytest.mark.parametrize("at", [1, 2, 3, 4])
def test_many_periods_in_one_job(spark, root, monkeypatch, at):
    """Two periods are exchanged: whatever move fails, each has its old or its new rows, and a second run ends it."""
    df = spark.createDataFrame([(3, dt.date(1998, 9, 15)), (4, dt.date(1998, 9, 16)), (5, dt.date(1998, 9, 17))], "v INT, on_date DATE")
    failing(monkeypatch, at, Ended)
    with pytest.raises(Ended):
        FS.replace_partitions(df, root, "on_date")
    monkeypatch.undo()
    left = table(spark, root)
    assert [r for r in left if r[1] == 15] in (OLD, NEW) and [r for r in left if r[1] == 16] in (REST, [(4, 16)])
    assert sorted(FS.replace_partitions(df, root, "on_date", [dt.date(1998, 9, 16), dt.date(1998, 9, 18)])) == ["1998-09-15", "1998-09-16", "1998-09-17"]
    assert table(spark, root) == [(3, 15), (4, 16), (5, 17)]
    FS.replace_partitions(df.filter("v = 3"), root, "on_date", [dt.date(1998, 9, 16)])
    assert table(spark, root) == [(3, 15), (5, 17)]
