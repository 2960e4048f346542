"""Near-duplicate documents: SetSketch registers, banding, joint estimate, exact check.

A document is the set of its word shingles.  Its sketch has ``REGISTERS``
registers; each is the truncated, exponentially spaced minimum of hashed
exponential variates over the set, so sketches of unions merge by the larger
register and equal registers are likelier the more alike two sets are.
Documents whose registers are equal in a whole band are candidates; the
Jaccard similarity of a candidate pair is estimated from all registers by
maximum likelihood, and pairs that may reach the threshold are compared on
their full sets.

Documents with the same set are one node.  Links are found in two passes:

1. Stars: in each bucket of equal band values every node is paired with the
   bucket's centre, under ``ORDERS`` different orders, so the pairs grow with
   the nodes however large a bucket is.  Links that hold join nodes into
   components.
2. Families: in buckets that still hold several components, nodes of different
   components whose set sizes allow the threshold are compared by their
   sketches, and no more likely links leave a bucket than connect its
   components.  Components connected so are a family.  The full sets of a
   family are then compared inside it, the likeliest pairs first and only while
   their components are apart, so again a few links leave it.  Large buckets and
   families are cut into parts of bounded size that meet pairwise.

With 32 bands of 4 registers a pair at similarity 0.8 meets in no band with
probability below 5e-8.

Defined cases: texts that are null or have no word have an empty set and are
linked with nothing; texts with fewer words than a shingle have one shingle of
all of them; rows are judged by their own text, also where a doc_id repeats;
a row without doc_id takes part, never names a component, and is kept only
where its component has no row with a doc_id; an empty table gives an empty
result; other columns are ignored (``keep_first`` passes them through).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.components import components
from tallyspark.llm.shared import own_name, written

WORDS = 5
PERCENT = 80              # smallest similarity that links, in percent
BAND_ROWS = 4             # registers in a band; four 16-bit registers are one 64-bit value
BANDS = 32
REGISTERS = BANDS * BAND_ROWS
BASE = 1.001              # spacing of the register values
RATE = 20.0               # rate of the exponential variates
ORDERS = 2
PART_ROWS = 2_048         # nodes of a bucket in one part; two parts are compared in one task
FAMILY_ROWS = 1_024       # the same for the nodes of a family, with their texts
GROUP_ROWS = 4_096        # rows of sorted groups handled at once
MAX_BROADCAST_NODES = 500_000
CACHE_WORDS = 300_000

_rng = np.random.default_rng(2021)
_MULTIPLY = _rng.integers(1 << 63, size=REGISTERS, dtype=np.uint64) * 2 + 1
_ADD = _rng.integers(1 << 63, size=REGISTERS, dtype=np.uint64) * 2


class _WordHash(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_word_hash = _WordHash()


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``n`` words; ASCII letters are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.array([], np.uint64)
    w = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))
    n = min(n, len(w))
    h = w[:len(w) - n + 1].copy()
    with np.errstate(over="ignore"):
        for j in range(1, n):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + w[j:len(w) - n + 1 + j]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set of hashes."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 512):
            low = np.minimum(low, (hashes[at:at + 512, None] * _MULTIPLY + _ADD).min(axis=0))
    variate = -np.log1p(-(low.astype(float) + 0.5) / 2.0 ** 64) / RATE
    return np.clip(np.floor(1 - np.log(variate) / math.log(BASE)), 0, 65_535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def estimate(greater: np.ndarray, less: np.ndarray, size_u: np.ndarray, size_v: np.ndarray) -> np.ndarray:
    """Jaccard similarities of maximum likelihood, from the numbers of registers in which u is greater or less."""
    u = size_u / (size_u + size_v)
    v = 1 - u
    j = np.linspace(0, 1, 65)[None, :] * np.minimum(u / v, v / u)[:, None]
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    score = greater[:, None] * log(up) + less[:, None] * log(down) + (REGISTERS - greater - less)[:, None] * log(1 - up - down)
    return j[np.arange(len(j)), score.argmax(axis=1)]


def likely(percent: int) -> float:
    """Estimates below this, six standard errors under the threshold, are taken as no link."""
    s = percent / 100
    return s - 6 * math.sqrt(s * (1 - s) / REGISTERS)


def sketch(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set; null if empty), registers of each row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, regs = [], [], []
            for text in batch.column(1).to_pylist():
                h = shingles(text, n)
                sizes.append(len(h))
                nodes.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                regs.append(registers(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                                              pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "node", "registers"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, node binary, registers binary")


def _bands(nodes: DataFrame) -> DataFrame:
    """band, value, node, n for each band of each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
            at = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)), pa.array(values),
                                              batch.column(0).take(at), batch.column(1).take(at)], names=["band", "value", "node", "n"])

    return nodes.select("node", "n", "registers").mapInArrow(run, "band int, value long, node binary, n long")


def _counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (a > b).sum(axis=-1), (a < b).sum(axis=-1)


def _probable(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose estimate may reach the threshold."""
    least = likely(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
                na, nb = (np.asarray(batch.column(i)).astype(float) for i in (4, 5))
                keep = pa.array(estimate(*_counts(a, b), na, nb) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    left = nodes.select(F.col("node").alias("a"), F.col("registers").alias("ra"), F.col("n").alias("na"))
    right = nodes.select(F.col("node").alias("b"), F.col("registers").alias("rb"), F.col("n").alias("nb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(run, "a binary, b binary")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _texts(docs: DataFrame, used: DataFrame, n: int) -> DataFrame:
    """node, text of the nodes in ``used`` (node, doc_id)."""
    used = written(used, "nodes-to-read")
    side = F.broadcast(used) if used.count() <= MAX_BROADCAST_NODES else used

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts that have the set of the node, which matters where a doc_id repeats."""
        for batch in batches:
            keep = [hashlib.blake2b(shingles(t, n).tobytes(), digest_size=16).digest() == k
                    for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    same = F.col("d.doc_id").eqNullSafe(F.col("u.doc_id"))
    texts = docs.select("doc_id", "text").alias("d").join(side.alias("u"), same).select("node", "text")
    return texts.mapInArrow(own, "node binary, text string").dropDuplicates(["node"])


def _true(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets reach the threshold."""
    used = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "doc_id"), "node")
    texts = written(_texts(docs, used, n), "texts-to-check")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([_linked(shingles(x, n), shingles(y, n), percent) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    left, right = (texts.select(F.col("node").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(check, "a binary, b binary")


def _sizes_allow(x: str, y: str, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _star_pairs(bands: DataFrame, percent: int) -> DataFrame:
    """Each node of a bucket with the bucket's centre; the order that names centres changes with the band."""
    rank = F.struct(F.xxhash64("node", F.pmod("band", F.lit(ORDERS))).alias("h"), F.col("node").alias("b"), F.col("n").alias("nb"))
    centres = bands.groupBy("band", "value").agg(F.min(rank).alias("c"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    return (bands.join(centres.select("band", "value", "c.b", "c.nb"), ["band", "value"])
            .filter((F.col("node") != F.col("b")) & _sizes_allow("n", "nb", percent))
            .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct())


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches that are sorted by ``key``, with the number of each row's group."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, table]) if rest is not None else table
        if rest.num_rows > 1:
            new = _changes(rest, key)
            cut = int(np.flatnonzero(new)[-1]) if new.any() else 0
            if cut and rest.num_rows >= GROUP_ROWS:
                yield rest.slice(0, cut), np.cumsum(new[:cut])
                rest = rest.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest, np.cumsum(_changes(rest, key))


def _changes(table: pa.Table, key: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for k in key:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return new


def _likely_pairs(group: np.ndarray, reg: np.ndarray, n: np.ndarray, allowed, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one group that are ``allowed``, may have the similarity, and their estimates."""
    least, out = likely(percent), []
    for d in range(1, int(np.bincount(group - group.min()).max())):
        i = np.flatnonzero(group[d:] == group[:-d])
        i = i[allowed(i, i + d) & (np.minimum(n[i], n[i + d]) * 100 >= np.maximum(n[i], n[i + d]) * percent)]
        for at in range(0, len(i), 8192):
            x = i[at:at + 8192]
            g, l = _counts(reg[x], reg[x + d])
            # Registers of sets this alike differ in so few places; the estimate is only made for those.
            near = g + l <= (1 - least) * REGISTERS + 16
            x, g, l = x[near], g[near], l[near]
            j = estimate(g, l, n[x], n[x + d]) if len(x) else np.array([])
            out.append((x[j >= least], x[j >= least] + d, j[j >= least]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.array([], int), np.array([], int), np.array([]))


class _Sets:
    """Disjoint sets of a few items."""

    def __init__(self, k: int):
        self.up = list(range(k))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """False if both were in one set."""
        i, j = self.find(i), self.find(j)
        self.up[i] = j
        return i != j


def _paired_parts(rows: DataFrame, key: list[str], part_rows: int) -> DataFrame:
    """``rows`` with part, p and q: groups of ``key`` cut into parts of bounded size, of which every two meet once, as (p, q)."""
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).select(*key, F.ceil(F.col("rows") / part_rows).cast("int").alias("parts"))
    cut = rows.join(sizes, key).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return cut.withColumn("p", F.least("part", "with")).withColumn("q", F.greatest("part", "with")).drop("with", "parts")


def _families(bands: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of different components with a likely link in a shared bucket, no more than connect them."""
    named = bands.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = written(named.select("band", "value", "node", "n", "root"), "bands-with-roots")
    bucket = ["band", "value"]
    spread = [F.min("root").alias("lo"), F.max("root").alias("hi")]
    open_ = named.groupBy(*bucket).agg(*spread).filter("lo <> hi").select(*bucket)
    # Sizes of linked sets are in the same class or in neighbouring ones; a row stands in its own and, as a guest, in the next.
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int")
    rows = named.join(open_, bucket).withColumn("own", size_class).withColumn("class", F.explode(F.array("own", F.col("own") + 1)))
    cell = [*bucket, "class"]
    mixed = rows.groupBy(*cell).agg(*spread, F.max(F.col("own") == F.col("class")).alias("home")).filter("home AND lo <> hi").select(*cell)
    cells = _paired_parts(rows.join(mixed, cell), cell, PART_ROWS).join(nodes.select("node", "registers"), "node")
    key = [*cell, "p", "q"]

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _groups(batches, key):
            reg = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            n, part, apart = (table.column(c).to_numpy() for c in ("n", "part", "apart"))
            home = table.column("own").to_numpy() == table.column("class").to_numpy()
            names, root = np.unique(np.array(table.column("root").to_pylist(), "S16"), return_inverse=True)
            ok = lambda i, j: (root[i] != root[j]) & (home[i] | home[j]) & ((part[i] != part[j]) | ~apart[i])
            i, j, _ = _likely_pairs(group, reg, n.astype(float), ok, percent)
            raw = table.column("root").to_pylist()
            sets = _Sets(len(names))
            keep = [k for k, (x, y) in enumerate(zip(root[i].tolist(), root[j].tolist())) if sets.join(x, y)]
            yield pa.RecordBatch.from_pydict({"a": pa.array([raw[i[k]] for k in keep], pa.binary()), "b": pa.array([raw[j[k]] for k in keep], pa.binary())})

    cells = cells.select(*key, "node", "n", "root", "part", "own", "registers", (F.col("p") != F.col("q")).alias("apart"))
    return cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(connect, "a binary, b binary").distinct()


def _rest_links(docs: DataFrame, bands: DataFrame, nodes: DataFrame, roots: DataFrame, n: int, percent: int) -> DataFrame:
    """True links (a, b) that connect components which the stars left apart, no more than connect them."""
    family = components(_families(bands, nodes, roots, percent)).select(F.col("node").alias("root"), F.col("root").alias("family"))
    members = (nodes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
               .join(family, "root").select("family", "root", "node", "doc_id"))
    members = _paired_parts(written(members, "family-members"), ["family"], FAMILY_ROWS)
    texts = _texts(docs, members.select("node", "doc_id").distinct(), n)
    key = ["family", "p", "q"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _groups(batches, key):
            sets_of = [shingles(t, n) for t in table.column("text").to_pylist()]
            reg = np.stack([registers(h) for h in sets_of])
            size = np.array([len(h) for h in sets_of], float)
            part, apart, node = table.column("part").to_numpy(), table.column("apart").to_numpy(), table.column("node").to_pylist()
            number = {r: k for k, r in enumerate(dict.fromkeys(table.column("root").to_pylist()))}
            root = np.array([number[r] for r in table.column("root").to_pylist()])
            ok = lambda i, j: (root[i] != root[j]) & ((part[i] != part[j]) | ~apart[i])
            i, j, sure = _likely_pairs(group, reg, size, ok, percent)
            joined, links = _Sets(len(number)), []
            # The likeliest first: pairs of components that are joined by then need no comparison.
            for k in np.argsort(-sure, kind="stable").tolist():
                x, y = int(i[k]), int(j[k])
                if joined.find(root[x]) != joined.find(root[y]) and _linked(sets_of[x], sets_of[y], percent):
                    joined.join(root[x], root[y])
                    links.append((node[x], node[y]))
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})

    rows = members.join(texts, "node").select(*key, "node", "root", "part", "text", (F.col("p") != F.col("q")).alias("apart"))
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(check, "a binary, b binary")


def classes(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, node, component_id, kept of each row of ``docs`` (doc_id, text)."""
    rows = written(sketch(docs, n), "sketches")
    nodes = written(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")), "nodes")
    bands = written(_bands(nodes), "bands")
    links = written(_true(written(_probable(_star_pairs(bands, percent), nodes, percent), "star-pairs"), docs, nodes, n, percent), "star-links")
    roots = components(links)
    more = written(_rest_links(docs, bands, nodes, roots, n, percent), "rest-links")
    roots = components(links.unionByName(more))
    groups = nodes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = groups.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = groups.join(first, "root").select("node", "component_id")
    out = rows.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", "node", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def keep_first(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its class, all columns as they were.

    Where the first document's doc_id repeats, its rows with a text of the same class stay."""
    kept = classes(docs, n, percent).filter("kept").select(F.col("doc_id").alias("k"), "node")
    key = own_name(docs, "set_key")

    def digest(text: pd.Series) -> pd.Series:
        return text.map(lambda t: hashlib.blake2b(shingles(t, n).tobytes(), digest_size=16).digest())

    unique = F.pandas_udf(digest, "binary")
    empty = hashlib.blake2b(b"", digest_size=16).digest()
    kept = kept.withColumn("node", F.coalesce("node", F.lit(empty))).distinct()
    return (docs.withColumn(key, unique("text")).join(kept, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col(key) == F.col("node")), "left_semi")
            .drop(key))
