"""Hard negatives against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import hard_negatives as H

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT"


def brute(rows, every=50, positives=5, negatives=3, scale=256.0):
    kept = {}
    for ident, vector, label in rows:
        if ident is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(scale * x) for x in vector]
        kept[ident] = (label, q)
    out = []
    for a, (label, q) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, other == label) for i, (other, p) in kept.items() if i != a)
        for s, i, _ in [x for x in scored if x[2]][:positives]:
            fit = [(t, j) for t, j, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(a, i, rank, j, -s, -t) for rank, (t, j) in enumerate(fit, 1)]
    return sorted(out)


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % 50 == 0, **options).collect())


def made(n, d, seed, hot=0.0, tight=0.0):
    """Unit vectors of ten labels, a share of them in a few tight groups and a share all equal."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d))
    groups = rng.normal(size=(8, d)) * 4
    in_group = rng.random(n) < tight
    base[in_group] = groups[rng.integers(0, 8, in_group.sum())] + 0.2 * base[in_group]
    base /= np.linalg.norm(base, axis=1)[:, None]
    base[rng.random(n) < hot] = base[0]
    return [(int(i), [float(x) for x in v], int(label)) for i, (v, label) in enumerate(zip(base, rng.integers(0, 10, n)))]


@pytest.mark.parametrize("hot, tight, seed", [(0, 0, 1), (0.34, 0, 2), (0, 0.9, 3), (0.2, 0.5, 4)])
def test_equals_all_inner_products(spark, hot, tight, seed):
    rows = made(1500, 8, seed, hot, tight)
    want = brute(rows)
    assert want and got(spark, rows) == want


def test_small_parts_slices_and_stretches(spark, monkeypatch):
    for name, value in (("PART_ROWS", 40), ("SLICE", 4), ("STRETCH", 16), ("CLUSTERS", 3), ("SAMPLE", 10)):
        monkeypatch.setattr(H, name, value)
    rows = made(1200, 6, 5, 0.1, 0.6)
    walk, stretch = H._walk, 16

    def small(*a):
        run = walk(*a)

        def inner(part, slice_):
            from tallyspark.llm import hard_negatives
            hard_negatives.STRETCH = stretch
            return run(part, slice_)
        return inner
    monkeypatch.setattr(H, "_walk", small)
    assert got(spark, rows) == brute(rows)


def test_ties_labels_and_counts(spark):
    same = [(i, [1.0, 0.0], 0) for i in (0, 3, 2, 1, 4, 9, 8)]
    other = [(100 + i, [0.7, 0.1 * (i % 2)], 1) for i in range(6)] + [(200, [0.95, 0.0], 2), (201, [0.96, 0.0], 2), (202, [0.5, 0.0], 2), (203, [0.49, 0.0], 2)]
    rows = same + other
    want = brute(rows)
    assert got(spark, rows) == want
    assert got(spark, rows, positives=2, negatives=20) == brute(rows, positives=2, negatives=20)


def test_odd_vectors(spark):
    rows = made(300, 4, 6) + [(None, [1.0] * 4, 1), (1000, None, 1), (1050, [1.0] * 4, None), (1100, [None, 1.0, 1.0, 1.0], 1), (1150, [math.nan] * 4, 1),
                              (1200, [math.inf, 0.0, 0.0, 0.0], 1), (1250, [0.0] * 4, 1), (1300, [], 1), (1350, [1.0, 0.5], 1), (1400, [1.0, 0.0, 0.0, 0.0, 2.0], 1),
                              (1450, [-0.001] * 4, 3)]
    assert got(spark, rows) == brute(rows)


def test_repeated_rows_count_once(spark):
    rows = made(200, 4, 7)
    assert got(spark, rows + rows[:80]) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [x * 2.0**20 for x in v], label) for i, v, label in made(200, 4, 8)]
    want = brute(rows)
    assert want and max(abs(r[5]) for r in want) > 1 << 53 and got(spark, rows) == want


def test_empty_no_anchor_and_clashing_columns(spark):
    assert got(spark, []) == [] and got(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    rows = made(120, 4, 9)
    df = spark.createDataFrame([(*r, 1, 2.0, "x") for r in rows], SCHEMA + ", rank INT, score DOUBLE, anchor STRING")
    assert sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % 50 == 0).collect()) == brute(rows)


def test_walk_ends_early_on_tight_groups():
    """On grouped vectors members leave the list long before its end; nothing they skip could count."""
    rows = made(4000, 16, 10, tight=1.0)
    vectors = np.floor(256 * np.array([v for _, v, _ in rows]))
    centroids = H._centroids([v.tobytes() for v in vectors[:1000]], 16)
    norms, cosines = H._cosines(vectors, centroids)
    near = cosines.argmax(axis=1)
    used = total = 0
    for c in range(len(centroids)):
        own = np.flatnonzero(near == c)[:20]
        if not len(own):
            continue
        radius = np.arccos(cosines[own, c].min()) + 1e-7
        bounds = H._bounds(norms, cosines[:, c], radius)
        scores = vectors[own] @ vectors.T
        assert (scores <= norms[own][:, None] * bounds[None, :] + 1e-6).all()
        tenth = np.sort(scores, axis=1)[:, -10]
        used += (norms[own][:, None] * bounds[None, :] >= tenth[:, None]).sum()
        total += scores.size
    assert used < 0.3 * total
