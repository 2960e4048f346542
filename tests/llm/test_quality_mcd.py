import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import quality_mcd as Q


def stats_of(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {i + j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def failed(s):
    return s[0] < 50 or 100 * s[4] > 50 * s[0]


def vector_of(s):
    n = max(s[0], 1)
    x = [math.log(n), math.log(max(s[1], 1) / n), math.sqrt(s[2] / n), math.sqrt(s[3] / n), math.sqrt(s[4] / n)]
    return [math.floor(v * Q.UNIT + 0.5) if v >= 0 else -math.floor(-v * Q.UNIT + 0.5) for v in x]


def grid_median(values, step):
    cells = sorted(v // step for v in values)
    return cells[(len(cells) + 1) // 2 - 1] * step + step // 2


def closest(d2, x):
    """Rows of the whole buckets that the closest share reaches into."""
    bucket = np.floor(np.log2(np.maximum(d2, 1e-6)) * Q.PER_OCTAVE)
    keep = np.zeros(len(x), bool)
    for b in np.unique(bucket):
        if keep.sum() < len(x) * Q.KEPT_SHARE:
            keep |= bucket == b
    return x[keep]


def brute_fit(x):
    """Centre and covariance of an integer matrix by the same method, in plain numpy."""
    ridge = np.diag(np.square(Q.RIDGE))
    med = np.array([grid_median(c.tolist(), Q.UNIT // 100) for c in x.T])
    dev = np.array([grid_median(np.abs(c - m).tolist(), Q.UNIT // 100) for c, m in zip(x.T, med)])
    z2 = ((x - med) / Q.UNIT) ** 2 / ((dev * 1.4826 / Q.UNIT) ** 2 + np.square(Q.RIDGE))
    best = None
    for start in (z2.sum(1), z2.max(1)):
        near = closest(start, x)
        for step in range(Q.STEPS + 1):
            y = near / Q.UNIT
            m, c = y.mean(0), np.cov(y.T, bias=True) * Q._consistency(Q.KEPT_SHARE) + ridge
            if step < Q.STEPS:
                d = x / Q.UNIT - m
                near = closest((d @ np.linalg.inv(c) * d).sum(1), x)
        if best is None or np.linalg.slogdet(c)[1] < best[0] - 1e-9:
            best = np.linalg.slogdet(c)[1], m, c
    return best[1:]


def brute(rows):
    """Per row of (doc_id, text, lang, source): counts, base_failed, distance2 or None."""
    stats = [stats_of(r[1]) for r in rows]
    sizes = collections.Counter((r[2], r[3]) for r, s in zip(rows, stats) if not failed(s))
    pools = collections.Counter()
    for (lang, _), n in sizes.items():
        if n < Q.MIN_GROUP:
            pools[lang] += n
    def group(r):
        if sizes[r[2], r[3]] >= Q.MIN_GROUP:
            return r[2], r[3]
        return ("lang", r[2]) if pools[r[2]] >= Q.MIN_GROUP else "rest"
    groups = [group(r) for r in rows]
    fits = {}
    for g in set(groups):
        x = np.array([vector_of(s) for k, s in zip(groups, stats) if k == g and not failed(s)])
        if g != "rest" or len(x) >= Q.MIN_GROUP:
            fits[g] = brute_fit(x) if len(x) else None
    out = []
    for r, s, g in zip(rows, stats, groups):
        d2 = None
        if not failed(s) and fits.get(g):
            d = np.array(vector_of(s)) / Q.UNIT - fits[g][0]
            d2 = float(d @ np.linalg.inv(fits[g][1]) @ d)
        out.append((s, failed(s), d2))
    return out


@pytest.mark.parametrize("rows_of", ["sf0.01", "made"])
def test_against_numpy(spark, rows_of):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in docs.collect()]
    if rows_of == "made":
        rows = [(i, t, None if i % 7 == 0 else g, None if i % 5 == 0 else f"s{i % 3}") for i, t, g, _ in rows]
        rows += [(5000, None, "en", "s1"), (5001, "", None, None), (5002, " \t\x0b\r\n", "xx", "s9"), (5003, "a b c " * 40_000, "en", "s1"), (5004, "é#" * 900, "en", "s1"),
                 (5005, "a\x0bb\tc\rd\x0ce " * 30, "zz", "s1"), (None, rows[3][1], "en", "s2"), (rows[9][0], rows[9][1], rows[9][2], rows[9][3])]
        rows += [(6000 + i, rows[11][1], "en", "copies") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("GRP", F.lit(1)).withColumn("n_words", F.lit(2))
    got = collections.defaultdict(list)
    for r in Q.assess(df).collect():
        got[r.doc_id].append((tuple(r[c] for c in Q.STATS), r.base_failed, r.distance2, r.kept))
    want = collections.defaultdict(list)
    for r, w in zip(rows, brute(rows)):
        want[r[0]].append(w)
    close = 0
    for doc, ws in want.items():
        for (s, f, d2), (gs, gf, gd2, kept) in zip(sorted(ws, key=str), sorted(got[doc], key=str)):
            assert (s, f) == (gs, gf)
            assert (d2 is None) == (gd2 is None)
            close += d2 is None or abs(d2 - gd2) <= 1e-6 * max(1, d2)
            assert kept == (not f and (d2 is None or gd2 <= Q.CUTOFF))
    assert close == len(rows)


def test_rejects_by_label(spark):
    """On the labelled documents: no good one that passes the base rule goes, most bad ones do."""
    sf = "/root/testdata/sf0.1"
    out = Q.assess(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("NOT base_failed")
    good, bad = (out.filter(f"quality = {q}").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good >= 0.995 and bad <= 0.05


def test_keep_good_passes_rows_through(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = docs.unionByName(docs.limit(5)).withColumn("MCD_KEY", F.lit("x"))
    kept = Q.keep_good(more)
    assert kept.columns == more.columns
    verdict = {r.doc_id: r.kept for r in Q.assess(more).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in more.collect() if verdict[r.doc_id])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert Q.assess(docs).collect() == [] and Q.keep_good(docs).collect() == []
