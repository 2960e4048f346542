"""Repeated passages of just over 50 words, however they are broken into lines and sentences."""

import random

import pytest

from tallyspark.llm import paragraph_dedup as P


def wrapped(words, k):
    return "\n".join(" ".join(words[i:i + k]) for i in range(0, len(words), k))


@pytest.mark.parametrize("form", ["plain", "wrapped", "mid-line"])
def test_passages_of_51_to_100_words_are_found_whole(spark, form):
    rng = random.Random(form)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows, place, n = [], {}, 100
    for i in range(n):
        passage, head = words(rng.randrange(51, 101)), words(rng.randrange(5, 60))
        place[2 * i + 1] = (len(head), len(head) + len(passage))
        if form == "wrapped":
            texts = [wrapped(x, k) for x, k in ((words(40) + passage + words(30), 11), (head + passage + words(20), 9))]
        elif form == "plain":
            texts = ["\n".join([" ".join(words(40)), " ".join(passage), " ".join(words(9))]), " ".join(head) + "\n" + " ".join(passage)]
        else:
            texts = [" ".join(words(33) + passage + words(25)), " ".join(head + passage + words(40))]
        rows += [(2 * i, texts[0]), (2 * i + 1, texts[1])]
    got = {}
    for r in P.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.doc_id % 2 and r.first_doc_id == r.doc_id - 1
        got.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    assert got == {d: set(range(a, b)) for d, (a, b) in place.items()}


def test_wrapped_text_has_the_paragraphs_of_the_plain_text():
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" + "." * (rng.random() < 0.1) for _ in range(300)]
    want, got = P.paragraphs(" ".join(words)), P.paragraphs(wrapped(words, 10))
    assert len(want[1]) > 5 and all((a == b).all() for a, b in zip(want, got))


def brute_runs(rows):
    """Words (doc, place) that chosen windows and their extensions cover, by comparing each later window with the first equal one."""
    first, out = {}, set()
    for doc, text in rows:
        plain = text.split()
        w = P.hashes(text)
        for at in P.chosen_windows(w).tolist():
            key = tuple(plain[at:at + P.WINDOW])
            source, old, o = first.setdefault(key, (doc, plain, at))
            if (source, o) == (doc, at):
                continue
            left = right = 0
            while left < min(P.REACH - 1, at, o) and plain[at - left - 1] == old[o - left - 1]:
                left += 1
            end, old_end = at + P.WINDOW, o + P.WINDOW
            while right < min(P.REACH - 1, len(plain) - end, len(old) - old_end) and plain[end + right] == old[old_end + right]:
                right += 1
            out |= {(doc, k) for k in range(at - left, end + right)}
    return out


def test_runs_against_brute_force(spark):
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    known = [words(rng.randrange(10, 120)) for _ in range(10)]
    rows = []
    for i in range(120):
        parts = [words(rng.randrange(40)) for _ in range(3)] + [rng.choice(known)[rng.randrange(8):] for _ in range(rng.randrange(3))]
        rng.shuffle(parts)
        rows.append((i, " ".join(x for p in parts for x in p)))
    rows += [(200, "a b c " * 40), (201, " ".join(words(5) + ["a", "b", "c"] * 40)), (202, rows[3][1]), (203, ""), (204, "one two")]
    rows.append((205, " ".join(words(60000) + known[0] + words(60000) + known[0])))
    got = set()
    for r in P.runs(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got |= {(r.doc_id, k) for k in range(r.first_word, r.first_word + r.n_words)}
    want = brute_runs(rows)
    assert got == want and len(want) > 1000


def test_passage_twice_in_one_document(spark):
    rng = random.Random(6)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    passage = words(80)
    df = spark.createDataFrame([(7, " ".join(words(30) + passage + words(20) + passage + words(10))), (8, " ".join(words(200)))], "doc_id long, text string")
    got = P.passages(df).collect()
    assert {r.doc_id for r in got} == {7} and {r.first_doc_id for r in got} == {7}
    assert {k for r in got for k in range(r.first_word, r.first_word + r.n_words)} == set(range(130, 210))
    assert len(P.remove(df).filter("doc_id = 7").first().text.split()) == 140


def test_stretches_inside_others_are_not_extended(spark, monkeypatch):
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(300)
    # The middle stands twice in document 0, so its windows come first at another place than those around it.
    rows = [(0, " ".join(words(20) + passage[100:150] + words(30) + passage + words(5))), (1, " ".join(words(7) + passage + words(9)))]
    asked, around = [], P._around
    monkeypatch.setattr(P, "_around", lambda docs, places: asked.extend(places.collect()) or around(docs, places))
    df, got = spark.createDataFrame(rows, "doc_id long, text string"), set()
    for r in P.runs(df).collect():
        got |= {(r.doc_id, k) for k in range(r.first_word, r.first_word + r.n_words)}
    assert got == brute_runs(rows) and {(1, k) for k in range(7, 307)} <= got
    starts = {r["first"] for r in asked if r["doc"] == 1}
    assert starts and not any(107 <= x < 142 for x in starts)


def test_windows_are_gone_before_paragraphs_are_compared(spark, monkeypatch):
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(90))
    seen, repeats = [], P._repeats
    monkeypatch.setattr(P, "_repeats", lambda places, docs: seen.append((places.filter("n = 0").count(), places.filter("n > 0").count())) or repeats(places, docs))
    assert P.passages(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")).count()
    assert seen[0][0] == 0 and seen[0][1] > 0
