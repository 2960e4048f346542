import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import mixing as M

WORDS = {" ", "\t", "\n", "\x0b", "\x0c", "\r"}


def size_of(text):
    return len("".join(" " if c in WORDS else c for c in text or "").split(" ")) - "".join(" " if c in WORDS else c for c in text or "").split(" ").count("")


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Reshare the excess by weight until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, left = set(), dict.fromkeys(order, 0.0)
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        left = {s: most * sizes[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in order}
        over = {s for s in free if left[s] >= most * sizes[s]}
        if not over:
            return left
        capped |= over


def brute(rows):
    sizes = [size_of(t) for _, _, t in rows]
    per = collections.Counter()
    for (_, s, _), n in zip(rows, sizes):
        per[s] += n
    targets = brute_targets(dict(per))
    def cls(n):
        shift = max(n.bit_length() - 4, 0)
        return n if n < 16 else shift * 8 + (n >> shift)
    out = []
    for source in per:
        u = int(hashlib.md5(f"{M.SEED}:{source if source is not None else chr(0) + 'null'}".encode()).hexdigest()[:5], 16) / (1 << 20)
        step = targets[source] / per[source] if per[source] else 0.0
        mine = sorted((cls(n), hashlib.md5(str(d if d is not None else "null").encode()).hexdigest(), n, str(d), d) for (d, s, _), n in zip(rows, sizes) if s == source)
        for r, (_, _, n, _, d) in enumerate(mine):
            out.append((d, source, n, per[source], round(targets[source], 6), min(math.floor((r + 1) * step + u) - math.floor(r * step + u), 2)))
    return sorted(out, key=str)


def made_rows():
    rows = [(i, f"s{i % 4}" if i % 3 else "hot", "w " * (i * i % 97)) for i in range(700)]
    rows += [(1000 + i, "copies", "same text here") for i in range(300)]
    return rows + [(None, None, "a b"), (None, "hot", None), (5, "s1", "x\ty\x0bz"), (5, "s1", "x\ty\x0bz"), (2000, "zero", None), (2001, "", "é è"), (2002, "Ω", "a " * 30_000)]


@pytest.mark.parametrize("cell", [256, 4])
def test_counts_against_brute_force(spark, cell, monkeypatch):
    monkeypatch.setattr(M, "CELL_ROWS", cell)
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("SIZE", F.lit(1)).withColumn("turn", F.lit(1))
    got = [(r.doc_id, r.source, r["size"], r.source_size, round(r.target, 6), r.copies) for r in M.mix_counts(df).collect()]
    assert sorted(got, key=str) == brute(rows)
    mixed = M.mix(df)
    assert mixed.columns == df.columns
    want = collections.Counter()
    for d, s, n, _, _, c in brute(rows):
        want[d, s, n] += c
    assert collections.Counter((r.doc_id, r.source, size_of(r.text)) for r in mixed.collect()) == +want


def test_taken_words_come_near_the_targets(spark):
    out = M.mix_counts(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    for r in out.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("t"), F.max("size").alias("m")).collect():
        assert abs(r.taken - r.t) <= max(0.02 * r.t, r.m)


def test_empty_and_wordless(spark):
    schema = "doc_id long, source string, text string"
    assert M.mix(spark.createDataFrame([], schema)).collect() == []
    assert M.mix(spark.createDataFrame([(1, "a", None), (2, "b", " ")], schema)).collect() == []
