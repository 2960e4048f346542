"""Texts are taken apart many at a time; pairs are compared once, tables go early."""

import os
import random

import numpy as np

from tallyspark.llm import paragraph_dedup as P


def test_texts_together_as_each_alone():
    rng = random.Random(5)
    odd = ["", " \n\n ", "one", "a\x1cb\x85c　d e\xa0f ​ g", "Über ΣΑΣ. été! ...", "\x00. \x7f?", "a " * 20, "x\n" * 40]
    made = ["".join(rng.choice("ab_Z9é.!?,'\"”-\x1b\x1d\xa0 \n   ") for _ in range(rng.randrange(900))) for _ in range(300)]
    texts = odd + made
    w, at, n, begin = P._paragraphs([P._bytes(x) for x in texts])
    alone = [P.paragraphs(x) for x in texts]
    assert np.diff(begin).tolist() == [len(x.split()) for x in texts]
    assert (w == np.concatenate([a for a, _, _ in alone])).all()
    low = begin.tolist()
    assert sorted(zip(at.tolist(), n.tolist())) == sorted((b + i, m) for b, (_, a, c) in zip(low, alone) for i, m in zip(a.tolist(), c.tolist()))
    assert sorted(P._windows(w, begin).tolist()) == sorted(b + i for b, (a, _, _) in zip(low, alone) for i in P.chosen_windows(a).tolist())


def test_chosen_windows_are_the_first_least_of_their_neighbours():
    rng = random.Random(7)
    for n in (*range(12, 70), 500):
        w = P.hashes(" ".join(rng.choice("abc") if n % 2 else f"w{rng.randrange(10**6)}" for _ in range(n)))
        low = P._mixed(P.shingle_hashes(w)[:max(n - P.WINDOW + 1, 0)], np.uint64(0)) if n >= P.WINDOW else np.array([])
        reach = min(P.REACH, len(low))
        assert P.chosen_windows(w).tolist() == sorted({i + int(low[i:i + reach].argmin()) for i in range(len(low) - reach + 1) if reach})


def test_pairs_of_a_bucket_of_two_are_compared_once(spark, monkeypatch):
    rng = random.Random(11)
    rows, seen, parts = [], [], P._paired_parts
    for i in range(60):  # similarity about 0.6: they meet in a band, and are not linked
        a = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        b = list(a)
        for k in (12, 28, 45):
            b[k] = f"edit{i}{k}"
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    monkeypatch.setattr(P, "_paired_parts", lambda rows, key, size: seen.append(rows.count()) or parts(rows, key, size))
    assert P.repeats(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
    assert seen == [0]


def test_paragraph_table_is_gone_before_sets_are_read(spark, monkeypatch):
    rng = random.Random(13)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(90))
    folders, seen, apart, sets = [], [], P._taken_apart, P._sets

    def taken(docs):
        out = apart(docs)
        folders.append(out[0].folder.removeprefix("file:"))
        assert os.path.isdir(folders[0])
        return out

    monkeypatch.setattr(P, "_taken_apart", taken)
    monkeypatch.setattr(P, "_sets", lambda docs, places: seen.append(os.path.exists(folders[0])) or sets(docs, places))
    assert P.passages(spark.createDataFrame([(1, text), (2, text), (3, text + " more")], "doc_id long, text string")).count()
    assert seen == [False]
