"""Removal of repeated passages: paragraphs, MinHash banding, exact Jaccard, components; equal runs of words.

Passages are copied into the middle of other lines, so paragraphs are cut by
content: a line is cut after about every second sentence end, chosen by a hash
of the words there, once with one half of the ends and once with the other.
The same passage is then cut at the same words wherever it stands.  Paragraphs
of fewer than ``MIN_WORDS`` words are left alone (greetings, template lines);
neighbouring lines that are all shorter than that are joined first, up to a
blank line, so that hard-wrapped text has paragraphs.

Words are compared in lower case without punctuation at their ends.  A
paragraph is the set of its 5-word shingles; paragraphs that share one of
``BANDS`` bands of ``BAND_ROWS`` minima are joined and their Jaccard similarity
is computed exactly.  With 6 bands of 2 a pair at 0.8 meets with probability
0.998, an equal pair always.  Links form components; the first place of a
component, by document and then by word, stays, and its other paragraphs are
repeats, in the same document too (but for those that overlap the first place,
as the two cuttings of one passage do).

Paragraphs need sentence ends and whole paragraphs inside a passage.  Beside
them, ``runs`` finds equal runs of words wherever they begin: windows of
``WINDOW`` words are compared whose first words have the least hash among
``REACH`` neighbouring places (line ends and punctuation play no part), so every
equal run of ``WINDOW + REACH - 1`` words or more has a window in common.  A
window that also stands earlier, in another or in the same document, is
extended by up to ``REACH - 1`` words to either side, as far as the words there
are equal to those around its first place, and overlapping ones are joined.

Scale: texts are taken apart once, into a table of paragraphs and windows that
both searches read.  Equal paragraphs are one node before the banding, which
shuffles hashes only; nodes are named in those buckets alone that hold two (and
not just the two cuttings of the same words).  In
a bucket each node is first compared with the bucket's centre; buckets that hold
several components after that are compared inside, in parts of bounded size.
Words are read again at the places of nodes that share a bucket and at the ends
of stretches of windows that stand twice, where no other stretch covers them.  Intermediate tables and shuffles go when no step reads them.

Defined cases: null and empty texts have no paragraphs; rows without doc_id
come after all others; rows that share a doc_id are one document, and those that
share the text too are one row, which repeats nothing by itself; a text that
repeats its own start at once keeps the first period; an empty table gives an
empty result; other columns are ignored (``remove`` passes them through).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.components import components
from tallyspark.llm.setsketch import _groups, _linked, _paired_parts, _Sets
from tallyspark.llm.shared import cleaned_shuffles, dropped, own_name, removed, written
from tallyspark.session import scratch_path

MIN_WORDS = 16
SHINGLE = 5
PERCENT = 80
BAND_ROWS, BANDS = 2, 6
WINDOW, REACH = 16, 16
PART_ROWS = 256
MAX_BROADCAST_NODES = 50_000
CACHE_WORDS = 300_000
CHUNK_WORDS = 200_000
LAST = (1 << 63) - 1

_u = np.uint64
_rng = np.random.default_rng(2)
_MULTIPLY = _rng.integers(1 << 63, size=BANDS * BAND_ROWS, dtype=_u) * _u(2) + _u(1)
_ADD = _rng.integers(1 << 63, size=BANDS * BAND_ROWS, dtype=_u)
_END = re.compile(r"[.!?][^\w]*$")
_EDGES = re.compile(r"^\W+|\W+$")
# White space outside ASCII, where str.split cuts too; the bytes that are white space within.
_FAR_SPACES = re.compile("[" + "".join(c for c in map(chr, range(128, 0x3001)) if c.isspace()) + "]")
_SPACES = np.array([c < 128 and chr(c).isspace() for c in range(256)])
_ASCII_EDGES = bytes(c for c in range(128) if re.match(r"\W", chr(c)))


class _Words(dict):
    """Hash of a word (UTF-8) in its compared form; the lowest bit tells whether it ends a sentence."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        if word.isascii():
            low = word.lower()
            body = low.rstrip(_ASCII_EDGES)
            plain, tail = body.lstrip(_ASCII_EDGES) or word, low[len(body):]
            end = b"." in tail or b"!" in tail or b"?" in tail
        else:
            text = word.decode("utf-8", "surrogatepass")
            plain, end = (_EDGES.sub("", text.lower()) or text).encode("utf-8", "surrogatepass"), bool(_END.search(text))
        self[word] = h = _hash(plain) & ~1 | end
        return h


_words, _hash = _Words(), xxhash.xxh3_64_intdigest


def _mixed(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _u(29))) * _u(0x9E3779B97F4A7C15) + more
    return h ^ (h >> _u(32))


def shingle_hashes(w: np.ndarray) -> np.ndarray:
    """Hash of the shingle that starts at each word (as far as one does)."""
    h = w[:len(w) - SHINGLE + 1].copy()
    for j in range(1, SHINGLE):
        h = _mixed(h, w[j:len(w) - SHINGLE + 1 + j])
    return h


def _split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words of all ``texts`` (UTF-8), one after the other; length of each word; its line; first word of each text, and their number.

    An empty line is put between two texts."""
    texts = [t if t.isascii() else _FAR_SPACES.sub(" ", t.decode("utf-8", "surrogatepass")).encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n\n".join([*texts, b""]), np.uint8)
    gap = _SPACES[raw]
    turn = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    start, stop = turn[::2], turn[1::2]
    begin = np.searchsorted(start, np.cumsum([0, *(len(t) + 2 for t in texts)]))
    return raw[~gap], stop - start, np.searchsorted(np.flatnonzero(raw == 10), start), begin


def _hashed(letters: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each word, with the bit of sentence ends; each different word is looked up once."""
    if not len(size):
        return np.array([], _u)
    ends = np.concatenate([[0], np.cumsum(size)])
    words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letters))]).dictionary_encode()
    names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    # Words of ASCII letters and digits, most, are hashed faster than they are found.
    return np.array([_hash(x.lower()) & ~1 if x.isalnum() else _words[x] for x in names], _u)[words.indices.to_numpy()]


def _hashes_at(texts: list[bytes], text: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compared hash of each word of ``texts`` that one of the stretches (``text``, ``first``, ``n``) holds, 0 elsewhere; first word of each text, and their number."""
    letters, size, _, begin = _split(texts)
    low, high = np.maximum(begin[text] + first, begin[text]), np.minimum(begin[text] + first + n, begin[text + 1])
    wanted = np.cumsum(np.bincount(low, minlength=len(size) + 1) - np.bincount(high, minlength=len(size) + 1))[:len(size)] > 0
    w = np.zeros(len(size), _u)
    w[wanted] = _hashed(letters[np.repeat(wanted, size)], size[wanted]) & ~_u(1)
    return w, begin


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def hashes(text: str | None) -> np.ndarray:
    """Compared hash of each word."""
    return _hashed(*_split([_bytes(text)])[:2]) & ~_u(1)


def _paragraphs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Compared hash of each word of all ``texts``; first word and number of words of each paragraph, in both cuttings; first word of each text, and their number."""
    letters, size, line, begin = _split(texts)
    w = _hashed(letters, size)
    if not len(w):
        return w, np.array([], int), np.array([], int), begin
    ends = (w & _u(1)).astype(bool)
    w &= ~_u(1)
    line_end = np.zeros(len(w), bool)
    size = np.append(np.bincount(line), 0)
    short = (size > 0) & (size < MIN_WORDS)
    cut = (size > 0) & ~(short & np.append(short[1:], False))
    line_end[np.cumsum(size)[cut] - 1] = True
    before = np.concatenate([w[:1], w[:-1]])
    opening = begin[:-1][begin[:-1] < begin[1:]]
    before[opening] = w[opening]
    half = ((_mixed(w, before) >> _u(40)) & _u(1)).astype(bool)
    firsts, sizes = [], []
    for chosen in (half, ~half):
        stop = np.flatnonzero(line_end | (ends & chosen)) + 1
        start = np.concatenate([[0], stop[:-1]])
        long = stop - start >= MIN_WORDS
        firsts.append(start[long])
        sizes.append((stop - start)[long])
    return w, np.concatenate(firsts), np.concatenate(sizes), begin


def paragraphs(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compared hash of each word; first word and number of words of each paragraph, in both cuttings."""
    return _paragraphs([_bytes(text)])[:3]


def _windows(w: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """First word of each chosen window of texts that begin at ``begin`` in the word hashes ``w`` (and end there)."""
    long = np.flatnonzero(np.diff(begin) >= WINDOW)
    if not len(long):
        return np.array([], int)
    low = _mixed(shingle_hashes(w)[:len(w) - WINDOW + 1], _u(0))
    least, span, out = np.arange(len(low)), 1, []
    seats = np.diff(begin)[long] - WINDOW + 1
    few = long[seats < REACH]
    out = [a + low[a:b - WINDOW + 1].argmin(keepdims=True) for a, b in zip(begin[few].tolist(), begin[few + 1].tolist())]
    if (seats >= REACH).any():
        # The least of ever more neighbouring places, the first of equal ones.
        while span < REACH:
            step = min(span, REACH - span)
            right = low[step:] < low[:-step]
            low, least = np.where(right, low[step:], low[:-step]), np.where(right, least[step:], least[:-step])
            span += step
        many = long[seats >= REACH]
        inside = np.cumsum(np.bincount(begin[many], minlength=len(w) + 1) - np.bincount(begin[many + 1] - WINDOW - REACH + 2, minlength=len(w) + 1))
        least = least[inside[:len(least)] > 0]
        out.append(least[np.append(True, least[1:] != least[:-1])])
    return np.concatenate(out)


def chosen_windows(w: np.ndarray) -> np.ndarray:
    """First word of each chosen window of a text with the word hashes ``w``."""
    return _windows(w, np.array([0, len(w)]))


def _digests(w: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Digest of the window at each place, 16 bytes in two columns."""
    a, b = np.full(len(at), 1, _u), np.full(len(at), 2, _u)
    for j in range(WINDOW):
        x = w[at + j]
        a, b = _mixed(a, x), _mixed(b, x * _u(0xD6E8FEB86659FD93))
    return np.stack([a, b], axis=1)


def _band_values(w: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """One value for each band of each paragraph; paragraphs may overlap, as those of the two cuttings do."""
    h = shingle_hashes(w)
    bounds = np.stack([at, at + n - SHINGLE + 1], axis=1).ravel()
    value = np.zeros((len(at), BANDS), _u)
    for j in range(BAND_ROWS):
        low = np.empty((len(at), BANDS), _u)
        for band in range(BANDS):
            k = band * BAND_ROWS + j
            low[:, band] = np.minimum.reduceat(np.append(h * _MULTIPLY[k] + _ADD[k], _u(0)), bounds)[::2]
        value = _mixed(value, low)
    return value.view(np.int64)


VALUES = [f"v{band}" for band in range(BANDS)]
PLACES = "doc long, copy long, first int, n int, node binary, " + ", ".join(f"{v} long" for v in VALUES)


def _chunks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of about ``CHUNK_WORDS`` words, a longer text alone, and their texts (column ``at``)."""
    for batch in batches:
        size = pc.binary_length(batch.column(at)).to_numpy()
        low, room = 0, 6 * CHUNK_WORDS
        for high, x in enumerate(size.tolist()):
            if high > low and x > room:
                yield (part := batch.slice(low, high - low)), part.column(at).cast(pa.binary()).to_pylist()
                low, room = high, 6 * CHUNK_WORDS
            room -= x
        if low < len(size):
            yield (part := batch.slice(low)), part.column(at).cast(pa.binary()).to_pylist()


def _places(docs: DataFrame) -> DataFrame:
    """Each paragraph (n words, with its band values) and each chosen window (n is 0) of ``docs`` (doc, copy, text); node is the digest of its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, texts in _chunks(batches, 2):
            flat, at, sizes, begin = _paragraphs(texts)
            raw = flat.tobytes()
            for place, n in ((at, sizes), (_windows(flat, begin), None)):
                if not len(place):
                    continue
                text = np.searchsorted(begin, place, "right") - 1
                first = place - begin[text]
                if n is None:
                    n, values = np.zeros(len(first), int), [pa.nulls(len(first), pa.int64())] * BANDS
                    node = _digests(flat, place).tobytes()
                else:
                    values = [pa.array(v) for v in _band_values(flat, place, n).T]
                    node = b"".join(hashlib.blake2b(raw[8 * a:8 * (a + m)], digest_size=16).digest() for a, m in zip(place.tolist(), n.tolist()))
                doc, copy = (chunk.column(i).to_numpy()[text] for i in range(2))
                node = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(first), [None, pa.py_buffer(node)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(copy), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), node, *values],
                    names=["doc", "copy", "first", "n", "node", *VALUES])

    return docs.mapInArrow(run, PLACES)


def _taken_apart(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The paragraphs and the windows of ``_places``, as tables that can go one by one; texts are read once."""
    spark, places = docs.sparkSession, _places(docs).withColumn("windows", F.col("n") == 0)
    path, key = scratch_path(spark, "passages"), "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, "0")
    # Both files of a task are open at once, so that its rows need not be sorted.
    spark.conf.set(key, "2")
    try:
        places.write.partitionBy("windows").parquet(path)
    finally:
        spark.conf.set(key, before)
    whole, out = spark.read.schema(places.schema).parquet(path), []
    for kind in ("false", "true"):
        out.append(whole.filter(f"windows = {kind}").drop("windows"))
        out[-1].folder = f"{path}/windows={kind}"
    return out[0], out[1]


def _at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """doc, copy, text, places (first, n, node) of the ``docs`` that hold ``places``, each text once."""
    lists = written(places.groupBy("doc", "copy").agg(F.collect_set(F.struct("first", "n", "node")).alias("places")), "passage-places")
    sizes = lists.agg(F.sum(F.size("places"))).first()[0] or 0
    side = F.broadcast(lists) if sizes <= MAX_BROADCAST_NODES else lists
    return docs.join(side, ["doc", "copy"])


def _listed(places: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, first, n and node of each of the ``places`` of the rows."""
    first, n, node = places.flatten().flatten()
    return np.repeat(np.arange(len(places)), pc.list_value_length(places).to_numpy()), first.to_numpy().astype(int), n.to_numpy().astype(int), node


def _sets(docs: DataFrame, places: DataFrame) -> DataFrame:
    """node, shingles (the set's hashes in order, packed) of the paragraphs at ``places`` (doc, copy, first, n, node)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, texts in _chunks(batches, 0):
            text, first, n, node = _listed(chunk.column(1))
            w, begin = _hashes_at(texts, text, first, n)
            raw, low = w.tobytes(), (begin[text] + first).tolist()
            found = {x: _set(raw[8 * a:8 * (a + m)]).tobytes() for x, a, m in zip(node.to_pylist(), low, n.tolist())}
            yield pa.RecordBatch.from_pydict({"node": pa.array(list(found), pa.binary()), "shingles": pa.array(list(found.values()), pa.binary())})

    return _at(docs, places).select("text", "places").mapInArrow(run, "node binary, shingles binary").dropDuplicates(["node"])


def _set(words: bytes) -> np.ndarray:
    return np.unique(shingle_hashes(np.frombuffer(words, _u)))


def _side(held: DataFrame) -> DataFrame:
    """``held`` as the small side of a join: sent to all tasks if it is short, else hashed part by part (the large side is not sorted)."""
    return F.broadcast(held) if held.count() <= MAX_BROADCAST_NODES else held.hint("shuffle_hash")


def _roots(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, root of ``nodes`` that are linked to others: nodes that share a band value are compared, first with the bucket's centre."""
    # A value tells its band too, as each band has its own hashes.
    bucket = ["value"]
    bands = nodes.withColumn("value", F.explode(F.array(*VALUES)))
    # Numbers only, so that the counts are hashed and not sorted; nodes are named in the few buckets that hold two.
    # Those whose paragraphs all overlap in the one text that has them (two cuttings of the same words) link nothing.
    # A node of several texts stands for a text of its own.
    single = F.col("home") == F.col("other_home")
    home, high = F.when(single, F.col("home")).otherwise(F.xxhash64("node")), F.when(single, F.col("high")).otherwise(F.col("low"))
    held = bands.groupBy(*bucket).agg(F.min(home).alias("home"), F.max(home).alias("other_home"), F.max(high).alias("last"), F.min(F.col("low") + F.col("n")).alias("end"))
    held = written(held.filter("home <> other_home OR last >= end").select(*bucket), "paragraph-held")
    shared = written(bands.select("node", *bucket).join(_side(held), bucket), "paragraph-buckets")
    centre = shared.groupBy(*bucket).agg(F.min("node").alias("b"))
    used = written(shared.select("node").distinct(), "paragraph-used")
    used = nodes.select("doc", "copy", "first", "n", "node").join(_side(used), "node")
    sets = written(_sets(docs, used), "paragraph-sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([_linked(np.frombuffer(x, _u), np.frombuffer(y, _u), PERCENT) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    pairs = shared.join(centre, bucket).select(F.col("node").alias("a"), "b").filter("a <> b").distinct()
    stars = written(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(check, "a binary, b binary"), "paragraph-stars")
    roots = components(stars)
    named = shared.select(*bucket, "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = written(named, "paragraph-roots")
    spread = [F.min("root").alias("lo"), F.max("root").alias("hi")]
    # All were compared with the centre, so that a bucket of two is done and others are compared without it.
    open_ = named.groupBy(*bucket).agg(*spread, F.min("node").alias("b"), F.count(F.lit(1)).alias("held")).filter("lo <> hi AND held > 2")
    rest = written(named.join(open_.select(*bucket, "b"), bucket).filter("node <> b").drop("b"), "paragraph-rest")
    open_ = rest.groupBy(*bucket).agg(*spread).filter("lo <> hi").select(*bucket)
    key = [*bucket, "p", "q"]

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _groups(batches, key):
            node, root = table.column("node").to_pylist(), table.column("root").to_pylist()
            part, apart = table.column("part").to_numpy(), table.column("apart").to_numpy()
            sets = [np.frombuffer(x, _u) for x in table.column("shingles").to_pylist()]
            size = np.array([len(x) for x in sets])
            number = {r: k for k, r in enumerate(dict.fromkeys(root))}
            joined, links = _Sets(len(number)), []
            for d in range(1, int(np.bincount(group).max())):
                i = np.flatnonzero(group[d:] == group[:-d])
                i = i[((part[i] != part[i + d]) | ~apart[i]) & (np.minimum(size[i], size[i + d]) * 100 >= np.maximum(size[i], size[i + d]) * PERCENT)]
                for x in i.tolist():
                    a, b = number[root[x]], number[root[x + d]]
                    if joined.find(a) != joined.find(b) and _linked(sets[x], sets[x + d], PERCENT):
                        joined.join(a, b)
                        links.append((root[x], root[x + d]))
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})

    cells = _paired_parts(rest.join(open_, bucket), bucket, PART_ROWS).join(sets, "node")
    cells = cells.select(*key, "node", "root", "part", "shingles", (F.col("p") != F.col("q")).alias("apart"))
    links = cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(inside, "a binary, b binary")
    # Only components are joined now; a node without a link so far is one of its own.
    more = components(links)
    joined = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    roots = written(joined.unionByName(more.join(roots, "node", "left_anti")), "paragraph-classes")
    dropped(held, shared, sets, stars, named, rest)
    return roots


def _numbered(docs: DataFrame) -> DataFrame:
    """doc, copy (tells texts of one document apart), text of ``docs`` (doc_id, text)."""
    return docs.filter(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("copy"), "text")


def _named(found: DataFrame) -> DataFrame:
    real = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return found.select(real("doc").alias("doc_id"), F.col("first_word").cast("long").alias("first_word"), F.col("n_words").cast("long").alias("n_words"),
                        real("first_doc").alias("first_doc_id"))


def _repeats(places: DataFrame, docs: DataFrame) -> DataFrame:
    """doc, copy, first_word, n_words, first_doc of each paragraph of ``places`` (``written``, deleted when read) that stands after another of its class."""
    rows = written(places.filter("n > 0").select("doc", "copy", "first", "n", "node"), "paragraph-rows")
    home = F.xxhash64("doc", "copy")
    nodes = places.filter("n > 0").groupBy("node").agg(
        F.min(home).alias("home"), F.max(home).alias("other_home"), F.min("first").alias("low"), F.max("first").alias("high"), F.min("n").alias("n"),
        # Any one place: the words are the same everywhere.
        *[F.first(c).alias(c) for c in ("doc", "copy", "first")], *[F.min(v).alias(v) for v in VALUES])
    nodes = written(nodes, "paragraph-nodes")
    dropped(places)
    roots = _roots(nodes, docs)
    alone = nodes.filter("home <> other_home OR low < high").select("node").join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))
    classes = written(roots.select("node", "root").unionByName(alone), "paragraph-classes")
    seats = written(rows.join(classes, "node").select("root", "doc", "copy", "first", "n").distinct(), "paragraph-seats")
    origin = seats.groupBy("root").agg(F.min(F.struct("doc", "copy", "first", "n")).alias("o"))
    inside = (F.col("doc") == F.col("o.doc")) & (F.col("copy") == F.col("o.copy")) & (F.col("first") < F.col("o.first") + F.col("o.n"))
    out = seats.join(origin, "root").filter(~inside).select("doc", "copy", F.col("first").alias("first_word"), F.col("n").alias("n_words"), F.col("o.doc").alias("first_doc"))
    out = written(out, "passage-repeats")
    dropped(rows, nodes, classes, seats)
    return out


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, first_word, n_words, first_doc_id of each paragraph of ``docs`` (doc_id, text) that stands earlier too, in the first document with it."""
    docs = _numbered(docs)
    return _named(_repeats(written(_places(docs), "passages"), docs))


def _equal_words(x: bytes, y: bytes) -> int:
    """Number of leading words (eight bytes each) in which x and y agree."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n // 8
    n = 0
    while x[n:n + 8] == y[n:n + 8]:
        n += 8
    return n // 8


def _around(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` (doc, copy, first, n) with the words before (nearest first) and after each stretch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = REACH - 1
        for chunk, texts in _chunks(batches, 2):
            text, first, n, _ = _listed(chunk.column(3))
            w, begin = _hashes_at(texts, np.tile(text, 2), np.concatenate([first - far, first + n]), np.full(2 * len(text), far))
            raw, back = w.tobytes(), w[::-1].tobytes()
            low, high = begin[text] + first, begin[text] + first + n
            before, after = np.minimum(first, far), np.minimum(begin[text + 1] - high, far)
            columns = [chunk.column(0).to_numpy()[text], chunk.column(1).to_numpy()[text], first, n,
                       [back[8 * (len(w) - x):8 * (len(w) - x + m)] for x, m in zip(low.tolist(), before.tolist())],
                       [raw[8 * x:8 * (x + m)] for x, m in zip(high.tolist(), after.tolist())]]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc", "copy", "first", "n", "before", "after"])

    found = _at(docs, places.withColumn("node", F.lit(None).cast("binary"))).select("doc", "copy", "text", "places")
    return found.mapInArrow(run, "doc long, copy long, first int, n int, before binary, after binary").dropDuplicates(["doc", "copy", "first", "n"])


def _stretches(pairs: DataFrame) -> DataFrame:
    """``pairs`` (doc, copy, old_doc, old_copy, shift, first) of windows with first places, joined where they touch: first, n of each stretch;
    low, high: the words that it and the stretches it overlaps or touches cover, of those with the same old_doc."""
    whole = ["doc", "copy", "old_doc"]
    key = [*whole, "old_copy", "shift"]
    so_far = (Window.unboundedPreceding, Window.currentRow)
    each = Window.partitionBy(*key).orderBy("first")
    new = F.coalesce((F.col("first") - F.lag("first").over(each) > WINDOW).cast("int"), F.lit(1))
    out = pairs.repartition(*whole).withColumn("new", new).withColumn("stretch", F.sum("new").over(each.rowsBetween(*so_far)))
    out = out.groupBy(*key, "stretch").agg(F.min("first").alias("first"), (F.max("first") - F.min("first") + WINDOW).alias("n")).drop("stretch")
    every = Window.partitionBy(*whole).orderBy("first")
    end = F.col("first") + F.col("n")
    new = F.coalesce((F.col("first") > F.max(end).over(every.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    out = out.withColumn("new", new).withColumn("cover", F.sum("new").over(every.rowsBetween(*so_far)))
    cover = Window.partitionBy(*whole, "cover")
    return out.select(*key, "first", "n", F.min("first").over(cover).alias("low"), F.max(end).over(cover).alias("high"))


def _runs(places: DataFrame, docs: DataFrame, done=lambda: None) -> DataFrame:
    """doc, copy, first_word, n_words, first_doc of each run of words that stands earlier too; ``done`` is called when ``places`` are read no more."""
    rows = places.filter("n = 0").select("doc", "copy", "first", "node")
    # Numbers only; a row that the table holds twice is left out later, as its place is not after the first.
    number = F.xxhash64("node")
    held = written(rows.groupBy(number.alias("number")).count().filter("count > 1").select("number"), "run-windows")
    rows = written(rows.join(_side(held), number == F.col("number")).drop("number"), "run-rows")
    done()
    place = F.struct("doc", "copy", "first")
    origin = rows.groupBy("node").agg(F.min(place).alias("o"))
    later = rows.join(origin, "node").filter(place > F.col("o"))
    later = later.select("doc", "copy", F.col("o.doc").alias("old_doc"), F.col("o.copy").alias("old_copy"), (F.col("first") - F.col("o.first")).alias("shift"), "first")
    cores = written(_stretches(later), "run-cores")
    # Only the ends of a stretch can be extended: inside, its windows touch.  They need not be where other stretches
    # with the same old document cover as many words as an extension may have.
    far = F.col("first") + F.col("n") + REACH - 1
    open_ = cores.filter((F.col("low") > F.greatest(F.lit(0), F.col("first") - (REACH - 1))) | (F.col("high") < far))
    new = open_.select("doc", "copy", "first", "n")
    old = open_.select(F.col("old_doc").alias("doc"), F.col("old_copy").alias("copy"), (F.col("first") - F.col("shift")).alias("first"), "n")
    words = written(_around(docs, new.unionByName(old)), "run-words")
    before = words.select(F.col("doc").alias("old_doc"), F.col("copy").alias("old_copy"), F.col("first").alias("old_first"), "n",
                          F.col("before").alias("old_before"), F.col("after").alias("old_after"))
    pairs = open_.withColumn("old_first", F.col("first") - F.col("shift")).join(words, ["doc", "copy", "first", "n"]).join(
        before, ["old_doc", "old_copy", "old_first", "n"]).select(
        "doc", "copy", F.col("old_doc").alias("first_doc"), "first", "n", "before", "after", "old_before", "old_after")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, n, before, after, old_before, old_after = (batch.column(i).to_pylist() for i in range(3, 9))
            start = [x - _equal_words(y, z) for x, y, z in zip(first, before, old_before)]
            end = [x + m + _equal_words(y, z) for x, m, y, z in zip(first, n, after, old_after)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                                             names=["doc", "copy", "first_doc", "start", "end"])

    spans = pairs.mapInArrow(extend, "doc long, copy long, first_doc long, start long, end long")
    covers = cores.select("doc", "copy", F.col("old_doc").alias("first_doc"), F.col("low").cast("long").alias("start"), F.col("high").cast("long").alias("end"))
    spans = spans.unionByName(covers.distinct())
    lists = spans.groupBy("doc", "copy", "first_doc").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, copy, first_doc, spans in zip(*(c.to_pylist() for c in batch.columns)):
                low, high = spans[0]["start"], spans[0]["end"]
                for s in spans[1:]:
                    if s["start"] > high:
                        out.append((doc, copy, low, high - low, first_doc))
                        low = s["start"]
                    high = max(high, s["end"])
                out.append((doc, copy, low, high - low, first_doc))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5,
                                             names=["doc", "copy", "first_word", "n_words", "first_doc"])

    out = written(lists.mapInArrow(join, "doc long, copy long, first_word long, n_words long, first_doc long"), "passage-runs")
    dropped(held, rows, cores, words)
    return out


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, first_word, n_words, first_doc_id of each run of words of ``docs`` (doc_id, text) that stands earlier too, in the first document with it."""
    docs = _numbered(docs)
    return _named(_runs(written(_places(docs), "passages"), docs))


def _passages(docs: DataFrame) -> DataFrame:
    """doc, copy, first_word, n_words, first_doc of all repeats in ``docs`` (doc_id, text)."""
    spark, docs = docs.sparkSession, _numbered(docs)
    with cleaned_shuffles(spark):
        paragraphs, windows = _taken_apart(docs)
        more = _runs(windows, docs, lambda: dropped(windows))
        out = _repeats(paragraphs, docs)
    return out.unionByName(more)


def passages(docs: DataFrame) -> DataFrame:
    """All repeats: near-equal paragraphs and equal runs of words (rows may overlap)."""
    return _named(_passages(docs))


def remove(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the words of repeated passages (the white space after each goes with it)."""
    doc, copy, spans = (own_name(docs, c) for c in ("repeat_doc", "repeat_copy", "repeat_spans"))
    found = _passages(docs.select("doc_id", F.col(text).alias("text"))).groupBy(F.col("doc").alias(doc), F.col("copy").alias(copy)).agg(
        F.collect_set(F.struct("first_word", "n_words")).alias(spans))
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)) == F.col(doc)) & (F.xxhash64(F.col(text)) == F.col(copy))
    rows = docs.join(found, same, "left").drop(doc, copy)
    schema = T.StructType(docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for t, cut in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                gone = {k for s in cut or () for k in range(s["first_word"], s["first_word"] + s["n_words"])}
                out.append("".join(m.group() for k, m in enumerate(re.finditer(r"\S+\s*", t)) if k not in gone) if gone and t else t)
            columns = [pa.array(out, pa.string()) if i == at else c.cast(f.type) for i, (c, f) in enumerate(zip(batch.columns[:-1], arrow))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return rows.mapInArrow(run, schema)
