"""Recall where part of the vectors stand in tight groups, for the isolated queries apart."""

import numpy as np
import pytest
from test_pstable_lsh import brute, run


@pytest.mark.parametrize("share", [1 / 3, 1 / 2, 0.8])
def test_isolated_queries_beside_tight_groups(spark, share, capsys):
    rng = np.random.default_rng(5)
    n, dim, members = 12_000, 64, 40
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    grouped = int(n * share)
    x[:grouped] = np.repeat(x[:grouped // members + 1], members, axis=0)[:grouped] + rng.normal(size=(grouped, dim)) * 0.02
    order = rng.permutation(n)
    isolated = {i for i, at in enumerate(order.tolist()) if at >= grouped}
    rows = [(i, x[at].astype(np.float32)) for i, at in enumerate(order)]
    want, got = brute(rows, 20), run(spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<float>"))
    hits = {q: len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want}
    alone = np.mean([h for q, h in hits.items() if q in isolated])
    with capsys.disabled():
        print(f"\nshare in groups {share:.2f}: recall {np.mean(list(hits.values())):.3f}, isolated queries {alone:.3f}")
    assert np.mean(list(hits.values())) >= 0.9 and alone >= 0.9
