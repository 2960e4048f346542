import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import suffix_dedup as D


def brute(rows, span=100):
    """(doc_id, kept bytes, number of spans) of distinct-id rows by a dictionary of all windows."""
    raws = [(doc if doc is not None else D.LAST, (t or "").encode()) for doc, t in rows]
    first = {}
    for doc, raw in sorted(raws, key=lambda r: r[0]):
        for s in range(len(raw) - span + 1):
            first.setdefault(raw[s:s + span], (doc, s))
    out = []
    for (doc, raw), (own, _) in zip(raws, rows):
        gone = np.zeros(len(raw) + 1, bool)
        for s in range(len(raw) - span + 1):
            if first[raw[s:s + span]] != (doc, s):
                gone[s:s + span] = True
        gone = gone[:len(raw)]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((own, len(raw), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted(((r.doc_id, len((r.text or "").encode()), sum(s.end - s.start for s in r.spans), len(r.spans),
                    hashlib.sha256(r.kept_bytes).hexdigest()) for r in D.remove(df).collect()), key=str)


def made_rows():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randrange(15, 60)) for _ in range(6)]
    line = text(14)
    rows = [None, "", "short", "a" * 99, "a" * 100, "a" * 350, "ab" * 200, "ba" * 120, "\n" * 230, "x\x00y" * 60]
    for _ in range(60):
        parts = [text(rng.randrange(5, 50)) for _ in range(3)]
        for p in rng.sample(passages, 2):
            a, b = sorted(rng.sample(range(len(p) + 1), 2))
            parts.insert(rng.randrange(4), p if rng.random() < 0.5 else p[a:b])
        rows.append(" ".join(parts))
    for _ in range(40):
        rows.append(" ".join([text(12), line, text(12)]))
    rows += [rows[20]] * 30 + [rows[20] + "tail", "head" + rows[21], rows[22] * 3]
    rng.shuffle(rows)
    return list(enumerate(rows)) + [(None, rows[3])]


@pytest.mark.parametrize("hot,strings,part", [(256, 50_000, 8 << 20), (2, 40, 4_000)])
def test_removal_against_all_windows(spark, hot, strings, part, monkeypatch):
    rows = made_rows()
    monkeypatch.setattr(D, "HOT", hot)
    monkeypatch.setattr(D, "PART_STRINGS", strings)
    monkeypatch.setattr(D, "PART_BYTES", part)
    monkeypatch.setattr(D, "SAMPLE", 40)
    monkeypatch.setattr(D, "BATCH_BYTES", part)
    monkeypatch.setattr(D, "COMPARED", strings // 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("AT", F.lit(1)).withColumn("doc", F.lit("x")).repartition(5)
    assert run(df) == brute(rows)


def test_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert run(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_repeated_ids(spark):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefgh") for _ in range(400))
    rows = [(1, base), (1, base), (2, "q" + base), (None, base)]
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [(r[0], r[2]) for r in got] == [(1, 0), (1, 0), (2, 400), (None, 400)]
    two = [(1, "other" + base), (1, base)]
    got = run(spark.createDataFrame(two, "doc_id long, text string"))
    assert sorted(r[2] for r in got) == [0, 400]


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []


def test_chunks_of_a_long_text(spark, monkeypatch):
    rows = [(i, t) for i, t in made_rows() if i is not None][:60]
    monkeypatch.setattr(D, "CHUNK", 64)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=40).map(str.encode), max_size=12), max_size=6))
def test_merge_of_front_coded_runs(runs):
    runs = [sorted(r) for r in runs]
    got = list(D.merge_runs([D.front_coded(r) for r in runs])) if runs else []
    assert [g[0] for g in got] == sorted(s for r in runs for s in r)
    assert all(runs[r][i] == s for s, _, r, i in got)
    for (a, *_), (b, shared, *_) in zip(got, got[1:]):
        assert shared == D.shared_length(a, b)


def test_splitters():
    hot = [b"h" * 32 + bytes([i]) * 9 for i in range(60)]
    marks, cut = D.splitters([bytes([i]) * 40 for i in range(100)] + hot, 8)
    assert cut == {b"h" * 32} and len(marks) == 7
