"""Exact removal of repeated byte strings by a distributed sort of suffixes.

A byte goes if a ``SPAN``-byte string that covers it also starts earlier (in a
document with a smaller doc_id, or earlier in the same one).

Sorting the suffix at every byte would move the text many times over.  Instead:

1. Every ``SPAN``-byte window has an anchor, the leftmost smallest of the hashed
   ``GRAM``-byte strings in it.  Equal windows have equal anchors at the same
   offset.  Neighbouring windows share anchors, so a text falls into stretches
   of windows, about one in 30 bytes.
2. Stretches are grouped by the hash of their anchor string.  Of equal
   stretches all but the first are repeats as a whole.  A stretch whose anchor
   string occurs nowhere else has no repeat.  What is left are the edges of
   repeated passages.
3. Edges are sorted as suffixes, from their anchor on and then backwards from
   it: each task sorts its own into a run, cuts the run at common splitters
   and sends the pieces front-coded (length shared with the string before, and
   the rest).  A receiver merges the runs with a loser tree that keeps the
   length each contender shares with the last winner, so a known prefix is
   never compared again.  Neighbours that share ``GRAM`` bytes are one group,
   in which equal windows are found and all but the first marked.

Hot groups: equal stretches are collapsed in each task before the exchange; an
anchor string met in many different stretches of one batch is spread by the
stretch instead of by the anchor; a group of suffixes that is large enough to
hold two splitters is cut by them and its windows are compared by a keyed
aggregation of 128-bit hashes.

Defined cases: a null text is empty; texts shorter than ``SPAN`` bytes lose
nothing; rows without doc_id come after all others; rows that share a doc_id
and the text are one document (each row gets the same result), those that
share only the doc_id are ordered by a hash of the text; an empty table gives
an empty result; other columns pass through.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.shared import own_name, written

SPAN = 100
GRAM = 32
CHUNK = 1 << 23           # windows of a text handled at once; places in a chunk fit 24 bits
HOT = 256                 # different stretches of one anchor string in a batch that spread it
PART_BYTES = 8 << 20      # text bytes for each group of stretches
BATCH_BYTES = 12 << 20    # text bytes whose equal stretches are collapsed before the exchange
PART_STRINGS = 20_000     # edges merged in one task
COMPARED = 4_096          # edges, in whole groups, whose windows are compared at once
SAMPLE = 20               # sampled edges for each splitter
LAST = (1 << 63) - 1

_u = np.uint64
_rng = np.random.default_rng(100)
_LETTER = _rng.integers(1 << 63, size=256, dtype=_u) * _u(2) + _u(1)
_STEP = _rng.integers(1 << 63, size=12, dtype=_u) * _u(2) + _u(1)
_LETTER2, _STEP2 = _LETTER * _u(0x9E3779B97F4A7C15) + _u(0x632BE59BD9B4E019), _STEP * _u(0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray, size: int, letter: np.ndarray = _LETTER, step: np.ndarray = _STEP) -> np.ndarray:
    """Hash of each string of ``size`` bytes in ``data``, joined from hashes of powers of two."""
    power = {1: letter[data]}
    m, j = 1, 0
    while m * 2 <= size:
        power[2 * m] = power[m][:-m] * step[j] + power[m][m:]
        m, j = 2 * m, j + 1
    out, done = power[m], m
    for p in sorted(power, reverse=True):
        if done + p <= size:
            n = len(data) - done - p + 1
            out, done = out[:n] * step[11] + power[p][done:done + n], done + p
    out = (out ^ (out >> _u(32))) * _u(0xD6E8FEB86659FD93)
    return out ^ (out >> _u(29))


def stretches(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """First window, number of windows, offset of the anchor in the first window, and anchor hash of each stretch."""
    n = len(data) - SPAN + 1
    out = []
    low = _u((1 << 24) - 1)
    for at in range(0, max(n, 0), CHUNK):
        part = data[at:at + CHUNK + SPAN - 1]
        h = gram_hashes(part, GRAM)
        # The leftmost smallest hash of each window: hash above, place below.
        m = (h & ~low) | np.arange(len(h), dtype=_u)
        width, size, windows = SPAN - GRAM + 1, 1, len(part) - SPAN + 1
        while size * 2 <= width:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        anchor = (np.minimum(m[:windows], m[width - size:width - size + windows]) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        out.append((first + at, np.diff(np.append(first, windows)), anchor[first] - first, h[anchor[first]]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.array([], int),) * 3 + (np.array([], _u),)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Whether each row of the sorted columns differs from the row before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _firsts(group: np.ndarray, place: tuple[np.ndarray, ...]) -> np.ndarray:
    """For rows sorted by group and place: whether the row's place is that of the group's first."""
    head = np.flatnonzero(group)[np.cumsum(group) - 1]
    return np.logical_and.reduce([p == p[head] for p in place])


_REC = np.dtype([("anchor", "<u8"), ("whole", "<u8"), ("doc", "<i8"), ("text", "<i8"), ("at", "<i8"), ("n", "<i2"), ("offset", "<i2")])
_SURE = np.dtype([("doc", "<i8"), ("text", "<i8"), ("at", "<i8"), ("n", "<i8")])
_FOUND = "doc long, text_key long, at long, n long, offset int, edge boolean"


def _gathered(docs: DataFrame, parts: int) -> DataFrame:
    """Stretches as packed records by part; those that repeat another of their batch as found rows (part < 0)."""
    def packed(recs: list[np.ndarray]) -> pa.RecordBatch:
        r = np.concatenate(recs)
        r = r[np.lexsort((r["at"], r["text"], r["doc"], r["whole"], r["anchor"]))]
        first = _firsts(_starts(r["anchor"], r["whole"]), (r["doc"], r["text"], r["at"]))
        later, r = r[~first], r[first]
        # Different stretches of one anchor string.
        distinct = _starts(r["anchor"], r["whole"])
        head = _starts(r["anchor"])
        group = np.cumsum(head) - 1
        hot = (np.bincount(group, weights=distinct, minlength=1) >= HOT)[group]
        # Two stretches of a hot string stay with its anchor, as a sign to stretches of other batches.
        nth = np.cumsum(distinct) - np.cumsum(distinct)[np.flatnonzero(head)][group]
        sign = r[hot & (nth < 2)]
        part = np.where(hot, r["whole"], r["anchor"]) % _u(parts)
        r["n"][hot] |= 1 << 12
        r, part = np.concatenate([r, sign]), np.concatenate([part, sign["anchor"] % _u(parts)]).astype(np.int64)
        order = np.argsort(part, kind="stable")
        r, part = r[order], part[order]
        cut = np.flatnonzero(_starts(part))
        blobs = [r[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(r)))]
        gone = _joined(later["doc"], later["text"], later["at"], later["n"])
        blobs.append(np.rec.fromarrays(gone, dtype=_SURE).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(np.append(part[cut], len(r) % parts), pa.int32()),
                                           pa.array([False] * len(cut) + [True]), pa.array(blobs, pa.binary())], names=["part", "sure", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recs, size = [], 0
        for batch in batches:
            for doc, key, text in zip(*[c.to_pylist() for c in batch.columns]):
                raw = text.encode("utf-8", "surrogatepass")
                at, n, offset, anchor = stretches(np.frombuffer(raw, np.uint8))
                r = np.empty(len(at), _REC)
                whole = map(xxhash.xxh3_64_intdigest, (raw[s:e] for s, e in zip(at.tolist(), (at + n + SPAN - 1).tolist())))
                r["whole"] = np.fromiter(whole, _u, len(at))
                r["anchor"], r["doc"], r["text"], r["at"], r["n"], r["offset"] = anchor, doc, key, at, n, offset
                recs.append(r)
                size += len(raw)
                if size >= BATCH_BYTES:
                    yield packed(recs)
                    recs, size = [], 0
        if recs:
            yield packed(recs)

    return docs.mapInArrow(run, "part int, sure boolean, blob binary")


def _joined(doc: np.ndarray, text: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows, neighbouring ones joined."""
    order = np.lexsort((at, text, doc))
    doc, text, at, n = doc[order], text[order], at[order], n[order].astype(np.int64)
    head = _starts(doc, text)
    head[1:] |= at[1:] > at[:-1] + n[:-1]
    k = np.flatnonzero(head)
    end = np.maximum.reduceat(at + n, k) if len(k) else at
    return doc[k], text[k], at[k], end - at[k]


def _found(table: pa.Table) -> pa.Table:
    """Repeated stretches and edges of one part."""
    blobs = list(zip(table.column("sure").to_pylist(), table.column("blob").to_pylist()))
    sure = np.concatenate([np.frombuffer(b, _SURE) for s, b in blobs if s] or [np.array([], _SURE)])
    r = np.concatenate([np.frombuffer(b, _REC) for s, b in blobs if not s] or [np.array([], _REC)])
    hot, n = (r["n"] >> 12) & 1 == 1, r["n"] & 0xFFF
    order = np.lexsort((r["at"], r["text"], r["doc"], r["whole"], r["anchor"]))
    r, hot, n = r[order], hot[order], n[order]
    head = _starts(r["anchor"])
    distinct = _starts(r["anchor"], r["whole"])
    group = np.cumsum(head) - 1
    several = (np.bincount(group, weights=distinct, minlength=1) > 1)[group] | hot if len(r) else np.array([], bool)
    first = _firsts(distinct, (r["doc"], r["text"], r["at"]))
    edge = first & several
    gone = _joined(r["doc"][~first], r["text"][~first], r["at"][~first], n[~first])
    doc, text, at, n_all = (np.concatenate([a, b, c]) for a, b, c in zip(
        (sure["doc"], sure["text"], sure["at"], sure["n"]), gone, (r["doc"][edge], r["text"][edge], r["at"][edge], n[edge].astype(np.int64))))
    flag = np.arange(len(doc)) >= len(doc) - edge.sum()
    offset = np.concatenate([np.zeros(len(doc) - edge.sum(), np.int64), r["offset"][edge].astype(np.int64)])
    return pa.table({"doc": doc, "text_key": text, "at": at, "n": n_all, "offset": offset.astype(np.int32), "edge": flag})


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the edges of each document."""
    for batch in batches:
        for doc, key, text, edges in zip(*[c.to_pylist() for c in batch.columns]):
            raw = text.encode("utf-8", "surrogatepass")
            edges = sorted({(e["at"], e["n"], e["offset"]) for e in edges})
            at, n, offset = map(list, zip(*edges))
            yield pa.RecordBatch.from_pydict({
                "doc": [doc] * len(at), "text_key": [key] * len(at), "at": at, "n": pa.array(n, pa.int64()), "offset": pa.array(offset, pa.int32()),
                "bytes": [raw[a:a + k + SPAN - 1] for a, k in zip(at, n)]})


def suffix(string: bytes, offset: int) -> bytes:
    """What an edge is sorted by: its bytes from the anchor on, then those before it backwards."""
    return string[offset:] + string[:offset][::-1]


def shared_length(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that share ``known`` bytes."""
    end = min(len(a), len(b))
    i = known
    while i < end and a[i:i + 16] == b[i:i + 16]:
        i += 16
    while i < end and a[i] == b[i]:
        i += 1
    return min(i, end)


def front_coded(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted strings: the length shared with the string before, and the rest."""
    shared, rest, last = [], [], b""
    for s in strings:
        k = shared_length(last, s)
        shared.append(k)
        rest.append(s[k:])
        last = s
    return shared, rest


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[bytes, int, int, int]]:
    """String, length shared with the string before, run, and place in it, in sorted order, of front-coded sorted runs.

    A loser tree: each inner node keeps the loser of its match.  ``lcp`` of a contender is the length it shares
    with the last winner.  The contender with the longer one is smaller; bytes are only compared, from there on,
    if both are equal, and the loser then knows the length it shares with the new winner."""
    k = 1
    while k < len(runs):
        k *= 2
    place = [0] * k
    key: list[bytes | None] = [rest[0] if rest else None for _, rest in runs] + [None] * (k - len(runs))
    lcp = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = key[a], key[b]
        if y is None or x is None:
            return (a, b) if y is None else (b, a)
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        n = shared_length(x, y, lcp[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            lcp[b] = n
            return a, b
        lcp[a] = n
        return b, a

    loser = [0] * k
    winner = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        winner[node], loser[node] = play(winner[2 * node], winner[2 * node + 1])
    top = winner[1]
    while (string := key[top]) is not None:
        yield string, lcp[top], top, place[top]
        shared, rest = runs[top]
        place[top] += 1
        i = place[top]
        if i < len(rest):
            lcp[top] = shared[i]
            key[top] = string[:shared[i]] + rest[i]
        else:
            key[top] = None
        node = (top + k) // 2
        while node:
            top, loser[node] = play(top, loser[node])
            node //= 2


def splitters(sample: list[bytes], parts: int) -> tuple[list[bytes], set[bytes]]:
    """Strings that cut the sorted order into parts, and the anchor strings of groups that they cut.

    A splitter is shortened to its anchor string, which cuts no group, unless the group holds several."""
    sample = sorted(sample)
    marks = [sample[len(sample) * i // parts] for i in range(1, parts)] if sample else []
    grams = [m[:GRAM] for m in marks]
    many = {g for g in set(grams) if grams.count(g) > 1}
    out = sorted({m if m[:GRAM] in many else m[:GRAM] for m in marks})
    cut = [m[:GRAM] for m in out]
    return out, {g for g in many if cut.count(g) > 1 or any(m[:GRAM] == g and len(m) > GRAM for m in out)}


def _runs(marks: list[bytes]):
    """Each batch of edges as a sorted run, cut at the splitters, front-coded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns)}
            keys = [suffix(b, o) for b, o in zip(cols["bytes"], cols["offset"])]
            order = sorted(range(len(keys)), key=keys.__getitem__)
            part = [bisect_right(marks, keys[i]) for i in order]
            a = 0
            while a < len(order):
                b = bisect_right(part, part[a], a)
                shared, rest = front_coded([keys[i] for i in order[a:b]])
                pick = lambda n: [cols[n][i] for i in order[a:b]]
                yield pa.RecordBatch.from_pydict({"part": pa.array([part[a]], pa.int32()), "shared": [shared], "rest": [rest], "doc": [pick("doc")],
                                                  "text_key": [pick("text_key")], "at": [pick("at")], "n": [pick("n")], "offset": [pick("offset")]})
                a = b
    return run


_RUN = "part int, shared array<long>, rest array<binary>, doc array<long>, text_key array<long>, at array<long>, n array<long>, offset array<long>"
_WINDOW = "doc long, text_key long, at long, n long, h1 long, h2 long"


def _merged(cut: set[bytes]):
    """Repeated windows among the edges of one part; windows of groups that were cut, with their hashes."""
    def compared(strings: list[bytes], group: list[int], origin: list[tuple]) -> pa.Table:
        doc, text, at, n = (np.array(c, np.int64) for c in zip(*origin))
        data = np.frombuffer(b"".join(strings), np.uint8)
        size = np.array([len(s) for s in strings])
        base = np.repeat(np.cumsum(size) - size, n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        h = gram_hashes(data, SPAN)[base + nth].view(np.int64)
        doc, text, at, of = (np.repeat(x, n) for x in (doc, text, at, np.array(group)))
        at = at + nth
        loose = of < 0
        d, t, a, h1, f = (x[~loose] for x in (doc, text, at, h, of))
        order = np.lexsort((a, t, d, h1, f))
        d, t, a, h1, f = (x[order] for x in (d, t, a, h1, f))
        later = ~_firsts(_starts(f, h1), (d, t, a))
        gone = _joined(d[later], t[later], a[later], np.ones(later.sum(), np.int64))
        h2 = gram_hashes(data, SPAN, _LETTER2, _STEP2)[base + nth].view(np.int64)[loose] if loose.any() else np.array([], np.int64)
        k, m = len(gone[0]), int(loose.sum())
        return pa.table({"doc": np.concatenate([gone[0], doc[loose]]), "text_key": np.concatenate([gone[1], text[loose]]),
                         "at": np.concatenate([gone[2], at[loose]]), "n": np.concatenate([gone[3], np.ones(m, np.int64)]),
                         "h1": pa.array(np.concatenate([np.zeros(k, np.int64), h[loose]]), mask=np.arange(k + m) < k),
                         "h2": pa.array(np.concatenate([np.zeros(k, np.int64), h2]), mask=np.arange(k + m) < k)})

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out, strings, group, origin = [], [], [], []
        g = 0
        for key, shared, r, i in merge_runs([(x["shared"], x["rest"]) for x in rows]):
            if shared < GRAM:
                g += 1
                if len(strings) >= COMPARED:
                    out.append(compared(strings, group, origin))
                    strings, group, origin = [], [], []
            offset = rows[r]["offset"][i]
            split = len(key) - offset
            strings.append(key[split:][::-1] + key[:split])
            group.append(-1 if key[:GRAM] in cut else g)
            origin.append((rows[r]["doc"][i], rows[r]["text_key"][i], rows[r]["at"][i], rows[r]["n"][i]))
        return pa.concat_tables([*out, compared(strings, group, origin)])
    return run


def repeated_windows(docs: DataFrame) -> DataFrame:
    """doc, text_key, at, n: runs of ``n`` windows from ``at`` that start earlier elsewhere, of ``docs`` (doc, text_key, text)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    found = written(_gathered(docs.select("doc", "text_key", "text").filter(F.octet_length("text") >= SPAN), parts)
                    .groupBy("part").applyInArrow(_found, _FOUND), "suffix-found")
    edges = found.filter("edge").groupBy("doc", "text_key").agg(F.collect_list(F.struct("at", "n", "offset")).alias("edges"))
    strings = written(docs.dropDuplicates(["doc", "text_key"]).join(edges, ["doc", "text_key"]).select("doc", "text_key", "text", "edges")
                      .mapInArrow(_strings, "doc long, text_key long, at long, n long, offset int, bytes binary"), "suffix-strings")
    sizes = max(1, -(-strings.count() // PART_STRINGS))
    share = min(1.0, SAMPLE * sizes / max(1, sizes * PART_STRINGS))
    picked = strings.filter(F.pmod(F.xxhash64("doc", "text_key", "at"), F.lit(1_000_000)) < share * 1_000_000).select("bytes", "offset")
    marks, cut = splitters([suffix(bytes(r[0]), r[1]) for r in picked.collect()], sizes) if sizes > 1 else ([], set())
    merged = written(strings.mapInArrow(_runs(marks), _RUN).groupBy("part").applyInArrow(_merged(cut), _WINDOW), "suffix-merged")
    loose = merged.filter("h1 IS NOT NULL")
    place = F.struct("doc", "text_key", "at")
    first = loose.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    late = loose.join(first, ["h1", "h2"]).filter(place > F.col("first"))
    runs = ["doc", "text_key", "at", "n"]
    return (found.filter("NOT edge").select(*runs).unionByName(merged.filter("h1 IS NULL").select(*runs)).unionByName(late.select(*runs)))


def remove(docs: DataFrame, text: str = "text", spans: str = "spans", kept: str = "kept_bytes") -> DataFrame:
    """``docs`` with the removed byte ranges of ``text`` (array of start, end) and the bytes that are left."""
    doc, key, gone = (own_name(docs, c) for c in ("suffix_doc", "suffix_text", "suffix_runs"))
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    # Only rows that share a doc_id need their text to be told apart.
    shared = keyed.groupBy(doc).count().filter("count > 1").take(1)
    keyed = keyed.withColumn(key, F.xxhash64(body) if shared else F.lit(0).cast("long"))
    runs = repeated_windows(keyed.select(F.col(doc).alias("doc"), F.col(key).alias("text_key"), body.alias("text")))
    runs = runs.groupBy(F.col("doc").alias(doc), F.col("text_key").alias(key)).agg(F.collect_list(F.struct("at", "n")).alias(gone))
    rows = keyed.join(runs, [doc, key], "left").select(*docs.columns, gone)
    schema = T.StructType([*docs.schema.fields, T.StructField(spans, T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField(kept, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            all_spans, all_kept = [], []
            for t, found in zip(batch.column(batch.schema.get_field_index(text)).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                raw = (t or "").encode("utf-8", "surrogatepass")
                cuts: list[list[int]] = []
                for at, n in sorted((x["at"], x["n"]) for x in found or ()):
                    end = at + n + SPAN - 1
                    if cuts and at <= cuts[-1][1]:
                        cuts[-1][1] = max(cuts[-1][1], end)
                    else:
                        cuts.append([at, end])
                edges = [0, *(x for c in cuts for x in c), len(raw)]
                all_spans.append([{"start": a, "end": b} for a, b in cuts])
                all_kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns[:-1], arrow)],
                                              pa.array(all_spans, arrow.field(spans).type), pa.array(all_kept, pa.binary())], schema=arrow)

    return rows.mapInArrow(run, schema)
