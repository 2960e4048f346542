import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import pstable_lsh as L


def brute(rows, k):
    """query -> [(vec_id, score)] with the same sums as the operator."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = L._products(x[i:i + 1], x)[0]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def run(df, k=20):
    out = {}
    for r in L.nearest(df, F.col("vec_id") % 20 == 0, k).collect():
        out.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [v[i] for i in sorted(v)] for q, v in out.items()}


@pytest.mark.parametrize("sf,least", [("sf0.001", 0.9), ("sf0.1", 0.9)])
def test_recall_against_brute_force(spark, sf, least):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], 20)
    got = run(df)
    assert got.keys() == want.keys()
    hits = [len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= least
    for q in want:  # scores are those of the vectors
        scores = dict(want[q])
        assert all(scores[a] == s for a, s in got[q] if a in scores)


def test_norms_differ(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * rng.exponential()).tolist()) for i in range(4000)]
    want, got = brute(rows, 20), run(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit(1)))
    want = brute([(i, np.array(v, np.float32)) for i, v in rows], 20)
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_edge_rows(spark):
    same = [1.0, 0.5, 0.25]
    rows = [(i, same) for i in range(1, 60)] + [(60, None), (80, []), (100, [0.0, 0.0, 0.0]), (120, [1.0, None, 0.0]),
            (140, [float("nan"), 1.0, 0.0]), (160, [float("inf"), 0.0, 0.0]), (180, [1.0, 2.0]), (None, same), (200, [0.1, 0.0, 0.0]), (200, [0.1, 0.0, 0.0])]
    got = run(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.keys() == {20, 40, 200}
    assert [a for a, _ in got[20]] == [i for i in range(1, 60) if i != 20][:20]
    assert [a for a, _ in got[200]] == list(range(1, 21))


def test_few_and_none(spark):
    assert run(spark.createDataFrame([], "vec_id long, embedding array<float>")) == {}
    assert run(spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")) == {0: [(1, 2.0), (2, -1.0)]}


def test_equal_rows_give_equal_sums():
    rng = np.random.default_rng(0)
    x = np.repeat(rng.normal(size=(1, 64)), 1037, axis=0)
    s = L._products(rng.normal(size=(7, 64)), x)
    assert (s == s[:, :1]).all()


def test_cells_are_visited_in_order_of_their_chance():
    h = L.Hash(16, 1.0, 100_000, 0.5)
    q = np.random.default_rng(1).normal(size=16)
    assert h.k > 3 and 1 < len(h.probes(0, q)) < 5_000
