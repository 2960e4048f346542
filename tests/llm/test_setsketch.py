import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import components as C
from tallyspark.llm import setsketch as S


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sets_of(rows, n):
    out = []
    for _, text in rows:
        w = words_of(text)
        out.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute(rows, n=2, percent=80):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = sets_of(rows, n)
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and sets[i]:
            low[find(i)] = min(low.get(find(i), doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        c = low.get(find(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), c, (doc == c) if doc is not None and c is not None else c is None))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in S.classes(df, **kw).collect()), key=str)


def family(rng, size, words, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def made_rows():
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "one", "ONE", "one two", "Two One", "one two", "É é", "é é"]
    texts += family(rng, 60, 120, 12) + family(rng, 40, 60, 5) + family(rng, 50, 20, 2) + family(rng, 30, 300, 40)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(40)) for _ in range(60)]
    texts += ["same text of many copies here"] * 50
    # A chain: each is near only to its neighbours.
    w = [f"c{i}" for i in range(300)]
    texts += [" ".join(w[i * 8:i * 8 + 150]) for i in range(18)]
    rng.shuffle(texts)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    return rows + [(None, "one two"), (None, "nowhere else at all"), (5, texts[20]), (5, texts[30]), (rows[3][0], rows[3][1]), (None, None)]


@pytest.mark.parametrize("n,part", [(2, 512), (5, 8)])
def test_classes_against_all_pairs(spark, n, part, monkeypatch):
    monkeypatch.setattr(S, "PART_ROWS", part)
    monkeypatch.setattr(S, "FAMILY_ROWS", part)
    monkeypatch.setattr(S, "GROUP_ROWS", part)
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("NODE", F.lit(1)).withColumn("registers", F.lit("x"))
    assert run(df, n=n) == brute(rows, n)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []


def test_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert run(df, n=2) == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_keep_first(spark):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set_key", F.lit("mine"))
    kept = S.keep_first(df, n=2)
    assert kept.columns == df.columns
    verdict = {}
    for (doc, text), size, c, k in [((r[0], r[1]), *b[1:]) for r, b in zip(rows, unsorted_brute(rows))]:
        verdict[doc, text] = k
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(str(r) for r in rows if verdict[r])


def unsorted_brute(rows):
    key = {}
    for r in brute([(i, t) for i, (_, t) in enumerate(rows)]):
        key[r[0]] = r
    out = []
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and key[i][1]:
            low[key[i][2]] = min(low.get(key[i][2], doc), doc)
    for i, (doc, _) in enumerate(rows):
        c = low.get(key[i][2]) if key[i][1] else doc
        out.append((doc, key[i][1], c, doc == c if doc is not None and c is not None else c is None))
    return out


def test_estimate_and_merge():
    rng = np.random.default_rng(0)
    errors = []
    for j in (0.5, 0.8, 0.9):
        for _ in range(20):
            common, rest = int(600 * j), int(600 * (1 - j))
            h = rng.integers(1 << 63, size=common + rest, dtype=np.uint64)
            u, v = h[:common + rest // 3], np.concatenate([h[:common], h[common + rest // 3:]])
            a, b = S.registers(u), S.registers(v)
            assert (S.merge(a, b) == S.registers(np.unique(h))).all()
            g, l = S._counts(a[None], b[None])
            errors.append(S.estimate(g, l, np.array([len(u)]), np.array([len(v)]))[0] - common / len(h))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(f"a{i}", f"a{i + 1}") for i in range(120)] + [("hub", f"s{i}") for i in range(300)] + [("x", "y"), ("y", "x"), ("z", "z")]
    rng.shuffle(links)
    got = {r.node: r.root for r in C.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert len({got[f"a{i}"] for i in range(121)}) == 1 and len({got[f"s{i}"] for i in range(300)} | {got["hub"]}) == 1
    assert got["x"] == got["y"] and len(set(got.values())) == 3 and "z" not in got
