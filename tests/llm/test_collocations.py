"""Phrase collocations against a count of all phrases in Python."""

import random
import re
from collections import Counter

import pytest

from tallyspark.llm import collocations as C

SCHEMA = "doc_id BIGINT, lang STRING, text STRING"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def counted(rows, longest=4):
    f, n = {}, Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + m])] += 1
    return f, n


def brute(rows, least, top):
    out = []
    f, n = counted(rows)
    for lang, counts in f.items():
        best = {}
        for p, a in counts.items():
            if len(p) > 1 and a >= least:
                best[p] = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
        kept = []
        for p, (score, _, left, right) in best.items():
            a = counts[p]
            inside = (q for q in best if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not any(100 * counts[q] >= 80 * a for q in inside):
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(spark, rows, **options):
    return sorted(tuple(r) for r in C.collocations(spark.createDataFrame(rows, SCHEMA), **options).collect())


def made(seed, n=300):
    """Documents of a skewed vocabulary with planted phrases, odd breaks and spaces, and characters of other scripts."""
    rng = random.Random(seed)
    words = ["the", "Of", "über", "naïve", " x", "x\x1cy", "a-b", "7"] + [f"w{i}" for i in range(25)]
    planted = ["new york city hall", "Ice Cream", "once upon a time", "time and again"]
    rows = []
    for i in range(n):
        parts = [rng.choice(planted) if rng.random() < 0.2 else words[min(int(rng.expovariate(0.2)), len(words) - 1)] for _ in range(rng.randrange(0, 25))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b"]) for p in parts)
        rows.append((i, rng.choice(["en", "en", "en", "de", None]), text))
    return rows


@pytest.mark.parametrize("shards", [1, 2, 3, 4])
def test_equals_the_count_of_all_phrases(spark, shards):
    rows = made(shards)
    assert got(spark, rows, min_count=4, shards=shards) == brute(rows, 4, 2000)


def test_first_of_each_language_with_ties(spark):
    rows = [(i, "en", ". ".join(f"{x}a {x}b" for x in "abcdefgh") + ".") for i in range(5)] + [(9, "de", "x y, x y, x y")]
    want = brute(rows, 3, 4)
    assert got(spark, rows, min_count=3, top=4) == want and [r[2] for r in want] == ["x y", "aa ab", "ba bb", "ca cb", "da db"]


def test_overlaps_count_and_nothing_crosses_a_break(spark):
    rows = [(1, "en", "a a a a a a"), (2, "en", "b c. b c; b\nc b c")]
    assert got(spark, rows, min_count=3, shards=2) == brute(rows, 3, 2000)


def test_full_filter_and_equal_hashes_change_no_row(spark, monkeypatch):
    """Where every phrase is taken for a known one, and many share a hash, counts by words stay exact."""
    rows = made(9)
    monkeypatch.setattr(C, "_scan", lambda count: open_scan(count, 1 << 20))
    assert got(spark, rows, min_count=4) == brute(rows, 4, 2000)


def open_scan(count, hashes):
    import numpy as np

    from tallyspark.llm import collocations

    def run(batches):
        class Open(collocations._Chunk):
            def phrases(self, known, longest, late=None):
                full = np.full(collocations.FILTER_BITS // 64, np.iinfo(np.uint64).max, np.uint64)
                for n, start, h in super().phrases(full, longest, None if late is None else full):
                    yield n, start, (h // np.uint64(8)) % np.uint64(hashes) * np.uint64(8) + np.uint64(n - 1)
        for rows in batches:
            for lang, text in zip(rows["lang"].to_pylist(), rows["text"].to_pylist()):
                yield from count(Open(lang, list(collocations._pieces(text.encode()))))
    return run


def test_chunks_end_at_breaks(monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 10)
    assert list(C._pieces(b"Aa bb cc. dd ee ff gg hh ii jj, k")) == [b"aa bb cc", b" dd ee ff gg hh ii jj", b" k"]


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    long = "one two three " * 200_000
    rows = [(None, None, None), (1, None, "p q r"), (1, None, "p q r"), (1, None, "p q r"), (2, "en", ""), (3, "en", long), (3, "en", long)]
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in rows], SCHEMA + ", rank INT, phrase STRING, shard INT")
    out = sorted(tuple(r) for r in C.collocations(df, min_count=3).collect())
    assert out == brute(rows, 3, 2000)


def test_empty_table(spark):
    assert got(spark, []) == []
