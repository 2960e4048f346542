"""Hard negatives by lists that a cluster of anchors shares (after MAXIMUS).

Anchors are clustered by angle; the centroids are fitted on a bounded sample (SAMPLE anchors with the smallest hashes).  For
a cluster with centroid c whose members lie within the angle r of it, no member u has a larger inner product with a row i
than |u| |i| cos(max(0, angle(i, c) - r)).  Rows are sorted by that bound, |u| left out, once for each cluster, and every
member walks the list until the bound of the next row is below what it still needs: then no later row can count, and the
walk has ended with certainty.  Scores are inner products of integers and exact.

*Distributed.*  Rows are dealt to parts by their nearest centroid and hash, PART_ROWS at most on average, so a cluster of any
size is spread; a cluster's list is the parts in the order of their best bounds, and sorted rows inside each part.  The
first walk takes the head of the list, the square root of its parts, for all members.  What a member has found there is
what it needs at least, and the second walk takes it only to the parts whose bound reaches that: so a member brings about
2 k sqrt(parts) rows to the final choice, not k from each part.  Parts meet members in slices of SLICE.

*Two searches*: positives (the same label, the first few by score), then for each positive the rows of other labels in the
range of scores below it, the first few under its upper end.  All ranges of an anchor are served by one walk.

Defined cases: rows with a null label, id or vector, or any null or non-finite component, take no part; of rows with one id
that with the smallest label and vector does; a missing component of a shorter vector counts as zero; zero and empty
vectors score 0; ties go to the smaller id; an anchor without positives, or a positive without negatives in its range, gives
no row; no anchors or an empty table give an empty result; further columns of any name are ignored.  Scores must be below
2**62.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.shared import written

CLUSTERS = 16
#: Anchors on which the centroids are fitted, and rounds of fitting.
SAMPLE, ROUNDS = 4096, 12
#: Rows of a part and the fewest parts; anchors of a slice; rows of a list scored at once.
PART_ROWS, PARTS, SLICE, STRETCH = 4096, 64, 4096, 512
LOWEST, HIGHEST = -(1 << 62), 1 << 62
VECTORS = "vec_id bigint, label bigint, anchor boolean, q binary"
FOUND = "anchor_id bigint, want int, vec_id bigint, score bigint"


# ------------------------------------------------------------------ in the tasks

def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    """Packed vectors as rows of doubles, shorter ones filled with zeros."""
    if all(len(b) == 8 * width for b in blobs):
        return np.frombuffer(b"".join(blobs)).reshape(len(blobs), width)
    return np.frombuffer(b"".join(b.ljust(8 * width, b"\0") for b in blobs)).reshape(len(blobs), width)


def _packed(scale: float):
    """Function for mapInArrow: vectors to packed integers; rows with a null or non-finite component are left out."""
    def run(batches):
        for rows in batches:
            vectors = rows["vector"]
            flat = vectors.flatten()
            values = np.floor(scale * flat.cast(pa.float64()).to_numpy(zero_copy_only=False))
            ends = np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = np.flatnonzero(bad[ends[1:]] == bad[ends[:-1]])
            # Negative zeros are equal to zeros.
            data = (values + 0.0).tobytes()
            blobs = pa.array([data[8 * ends[i]:8 * ends[i + 1]] for i in good], pa.binary())
            kept = rows.take(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept["vec_id"], kept["label"], kept["anchor"], blobs], names=["vec_id", "label", "anchor", "q"])
    return run


def _cosines(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and the cosine of each row with each centroid (1 for zero vectors, whose bound is 0 anyway)."""
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return norms, np.where(norms[:, None] > 0, np.clip(rows @ centroids.T / np.where(norms > 0, norms, 1)[:, None], -1, 1), 1.0)


def _bounds(norms: np.ndarray, cosines: np.ndarray, radius) -> np.ndarray:
    """Upper bounds of inner products with any unit vector within ``radius`` of the centroid, with room for rounding."""
    return norms[:, None] * (np.cos(np.maximum(0, np.arccos(cosines) - radius)) + 1e-9) if cosines.ndim > 1 else norms * (
        np.cos(np.maximum(0, np.arccos(cosines) - radius)) + 1e-9)


def _assigned(centroids: np.ndarray):
    """Function for mapInArrow: adds norm, nearest centroid and the cosine with it."""
    def run(batches):
        for rows in batches:
            norms, cosines = _cosines(_matrix(rows["q"].to_pylist(), centroids.shape[1]), centroids)
            near = cosines.argmax(axis=1) if len(norms) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(norms), pa.array(near.astype(np.int32)), pa.array(cosines[np.arange(len(near)), near])],
                names=[*rows.schema.names, "norm", "cluster", "cosine"])
    return run


def _part_bounds(centroids: np.ndarray, radius: np.ndarray):
    """Function for mapInArrow: the best bound of the rows of each part for each cluster."""
    def run(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            part, at = np.unique(rows["part"].to_numpy(), return_inverse=True)
            bounds = _bounds(*_cosines(_matrix(rows["q"].to_pylist(), centroids.shape[1]), centroids), radius[None, :])
            best = np.full((len(part), len(radius)), -np.inf)
            np.maximum.at(best, at, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part, len(radius)).astype(np.int32)), pa.array(np.tile(np.arange(len(radius), dtype=np.int32), len(part))),
                 pa.array(best.ravel())], names=["part", "cluster", "bound"])
    return run


def _scores(members: np.ndarray, rows: np.ndarray, wide: bool) -> np.ndarray:
    """Inner products, exact: in doubles where all sums are below 2**53, else in whole numbers of any size."""
    if not wide:
        return members @ rows.T
    whole = lambda x: np.array([[int(v) for v in r] for r in x], object).reshape(x.shape)
    out = whole(members) @ whole(rows).T
    if out.size and max(abs(int(out.max())), abs(int(out.min()))) >= HIGHEST:
        raise OverflowError("scores must be below 2**62")
    return out.astype(np.int64)


def _first(k: int, owner: np.ndarray, score: np.ndarray, ident: np.ndarray):
    """Places of the first ``k`` of each owner, by score, then by smaller id; sorted by owner."""
    order = np.lexsort((ident, -score, owner))
    own = owner[order]
    start = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
    return order[rank < k]


def _walk(centroids: np.ndarray, radius: np.ndarray, k: int, same_label: bool, wide: bool):
    """Function for cogrouped applyInArrow: the rows of a part and a slice of members to what each member finds.

    A member has ranges (lows, highs); of each it wants the first ``k`` rows."""
    kind = np.int64 if wide else np.float64

    def run(part: pa.Table, slice_: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if part.num_rows and slice_.num_rows:
            rows = _matrix(part["q"].to_pylist(), centroids.shape[1])
            ident, label = part["vec_id"].to_numpy(), part["label"].to_numpy()
            norms, cosines = _cosines(rows, centroids)
            cluster = slice_["cluster"].to_numpy()
            for c in np.unique(cluster):
                mine = slice_.take(pa.array(np.flatnonzero(cluster == c)))
                bounds = _bounds(norms, cosines[:, c], radius[c])
                order = np.argsort(-bounds, kind="stable")
                out += _walked(mine, rows[order], ident[order], label[order], bounds[order])
        names = ["anchor_id", "want", "vec_id", "score"]
        found = [np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64) for i in range(4)]
        return pa.table([pa.array(found[0].astype(np.int64)), pa.array(found[1].astype(np.int32)), pa.array(found[2].astype(np.int64)),
                         pa.array(found[3].astype(np.int64))], names=names)

    def _walked(mine: pa.Table, rows, ident, label, bounds):
        """The shared list of one cluster, walked by its members together; each leaves when it is certain."""
        anchors, own, norm = mine["anchor_id"].to_numpy(), mine["own"].to_numpy(), mine["norm"].to_numpy()
        vectors = _matrix(mine["vector"].to_pylist(), centroids.shape[1])
        highs = np.array(mine["highs"].to_pylist(), np.int64).astype(kind)
        need = np.array(mine["lows"].to_pylist(), np.int64).astype(kind)
        wants = need.shape[1]
        best = [(np.zeros(0, np.int64), np.zeros(0, kind), np.zeros(0, np.int64)) for _ in range(wants)]
        live = np.arange(len(anchors))
        for start in range(0, len(rows), STRETCH):
            # The bound holds for integers: what is below the need by any part is.
            live = live[norm[live] * bounds[start] + 1e-6 >= need[live].min(axis=1)]
            if not len(live):
                break
            stretch = slice(start, start + STRETCH)
            scores = _scores(vectors[live], rows[stretch], wide)
            who, what = np.nonzero(scores >= need[live].min(axis=1)[:, None])
            score, who, what = scores[who, what], live[who], what + start
            fit = ((label[what] == own[who]) == same_label) & (ident[what] != anchors[who])
            who, what, score = who[fit], what[fit], score[fit]
            for w in range(wants):
                within = (score <= highs[who, w]) & (score >= need[who, w])
                if within.any():
                    owner, value, at = (np.concatenate(x) for x in zip(best[w], (who[within], score[within], what[within])))
                    top = _first(k, owner, value, ident[at])
                    best[w] = owner, value, at = owner[top], value[top], at[top]
                    held = np.bincount(owner, minlength=len(anchors))
                    last = np.cumsum(held) - 1
                    full = held == k
                    need[full, w] = value[last[full]]
        return [(anchors[o], np.full(len(o), w), ident[a], v) for w, (o, v, a) in enumerate(best)]
    return run


# ------------------------------------------------------------------ clusters and lists

def _centroids(sample: list[bytes], width: int) -> np.ndarray:
    """Unit centroids of a sample by k-means on angles, started from rows far from each other."""
    rows = _matrix(sample, width)
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    rows = rows[norms > 0] / norms[norms > 0][:, None]
    if not len(rows):
        return np.eye(1, max(width, 1))[:, :width]
    chosen = [0]
    near = rows @ rows[0]
    while len(chosen) < min(CLUSTERS, len(rows)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    out = rows[chosen]
    for _ in range(ROUNDS):
        at = (rows @ out.T).argmax(axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, at, rows)
        size = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        out = np.where(size[:, None] > 1e-12, sums / np.where(size > 1e-12, size, 1)[:, None], out)
    return out


class _Lists:
    """Rows in parts, anchors with their clusters, and for each cluster the parts in the order of their bounds."""

    def __init__(self, vectors: DataFrame):
        self.vectors = vectors
        total = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.octet_length("q")).alias("bytes")).first()
        self.anchors = total["anchors"]
        if not self.anchors:
            return
        width = (total["bytes"] or 0) // 8
        sample = vectors.filter("anchor").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("q").collect()
        self.centroids = _centroids([bytes(r["q"]) for r in sample], width)
        near = written(vectors.mapInArrow(_assigned(self.centroids), VECTORS + ", norm double, cluster int, cosine double"), "negatives-assigned")
        # A row for each cluster.
        stats = near.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("anchor"), F.col("cosine"))).alias("least"),
                                            F.max("norm").alias("norm")).collect()
        self.radius = np.zeros(len(self.centroids))
        for r in stats:
            self.radius[r["cluster"]] = np.arccos(np.clip(1 if r["least"] is None else r["least"], -1, 1)) + 1e-7
        self.wide = max(r["norm"] for r in stats) ** 2 >= 1 << 52
        rows_a_part = min(PART_ROWS, -(-total["n"] // PARTS))
        sizes = {r["cluster"]: -(-r["n"] // rows_a_part) for r in stats}
        starts, self.parts = {}, 0
        for c, n in sorted(sizes.items()):
            starts[c] = self.parts
            self.parts += n
        of = lambda values: F.element_at(F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv]), F.col("cluster"))
        self.near = near.withColumn("part", (of(starts) + F.pmod(F.xxhash64("vec_id"), of(sizes))).cast("int"))
        bounds = self.near.select("part", "q").mapInArrow(_part_bounds(self.centroids, self.radius), "part int, cluster int, bound double")
        best = bounds.groupBy("part", "cluster").agg(F.max("bound").alias("bound"))
        place = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("bound"), "part"))
        self.lists = written(best.withColumn("place", place), "negatives-lists")
        self.slices = -(-self.anchors // SLICE)
        self.head = int(np.ceil(np.sqrt(self.parts)))

    def members(self) -> DataFrame:
        slice_ = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(self.slices)).cast("int")
        return self.near.filter("anchor").select(F.col("vec_id").alias("anchor_id"), F.col("label").alias("own"), F.col("q").alias("vector"),
                                                    "cluster", "norm", slice_.alias("slice"))

    def _meet(self, members: DataFrame, lists: DataFrame, k: int, same_label: bool) -> DataFrame:
        """What members (with lows and highs) find in the parts of ``lists`` that can hold something for them."""
        every = F.explode(F.sequence(F.lit(0), F.lit(self.slices - 1))).alias("slice")
        enough = F.col("norm") * F.col("bound") + 1e-6 >= F.array_min("lows")
        sent = members.join(lists.select("*", every), ["cluster", "slice"]).filter(enough).drop("bound", "place")
        rows = self.near.select("part", "vec_id", "label", "q", every)
        walk = _walk(self.centroids, self.radius, k, same_label, self.wide)
        return rows.groupBy("part", "slice").cogroup(sent.groupBy("part", "slice")).applyInArrow(
            lambda part, slice_: walk(part, slice_), FOUND)

    def search(self, members: DataFrame, k: int, same_label: bool) -> DataFrame:
        """The first ``k`` rows of every range of every member: anchor_id, want, rank, vec_id, score."""
        order = Window.partitionBy("anchor_id", "want").orderBy(F.desc("score"), "vec_id")
        ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        head = written(ranked(self._meet(members, self.lists.filter(F.col("place") <= self.head), k, same_label)), "negatives-head")
        least = (head.filter(F.col("rank") == k).groupBy("anchor_id")
                 .agg(F.map_from_entries(F.collect_list(F.struct("want", "score"))).alias("least")))
        lows = F.expr("transform(lows, (x, i) -> coalesce(least[i], x))")
        later = members.join(least, "anchor_id", "left").withColumn("lows", F.when(F.col("least").isNull(), F.col("lows")).otherwise(lows)).drop("least")
        rest = self._meet(later, self.lists.filter(F.col("place") > self.head), k, same_label)
        return written(ranked(head.drop("rank").unionByName(rest)), "negatives-found")


def vectors_of(rows: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column, scale: float) -> DataFrame:
    """One packed row for each id that takes part."""
    given = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
                        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("vector"))
    given = given.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    packed = given.mapInArrow(_packed(scale), VECTORS)
    one = packed.groupBy("vec_id").agg(F.min(F.struct("label", "q", "anchor")).alias("r"))
    return written(one.select("vec_id", "r.label", "r.anchor", "r.q"), "negatives-vectors")


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         positives: int = 5, negatives: int = 3, scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor its first ``positives`` rows of the same label, and for each of those the first ``negatives`` rows of
    other labels whose score is from 50 to 95 % of the positive's."""
    spark: SparkSession = rows.sparkSession
    lists = _Lists(vectors_of(rows, id_col, vector_col, F.col("label") if label is None else label, anchor, scale))
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not lists.anchors:
        return spark.createDataFrame([], schema)
    one = lambda x: F.array(F.lit(x).cast("bigint"))
    members = lists.members()
    same = lists.search(members.withColumns({"lows": one(LOWEST), "highs": one(HIGHEST)}), positives, True)
    # No score is within 50 to 95 % of a negative one.
    pairs = same.filter("score >= 0").select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    low, high = F.expr("(positive_score + 1) div 2"), F.expr("positive_score - (positive_score + 19) div 20")
    ranges = pairs.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("place", F.struct(low.alias("low"), high.alias("high"))))).alias("of"))
    # As many ranges for each anchor; those without a positive are empty.
    every = F.sequence(F.lit(1), F.lit(positives))
    wanting = members.join(ranges, "anchor_id").withColumns({
        "lows": F.transform(every, lambda i: F.coalesce(F.col("of")[i]["low"], F.lit(HIGHEST).cast("bigint"))),
        "highs": F.transform(every, lambda i: F.coalesce(F.col("of")[i]["high"], F.lit(LOWEST).cast("bigint")))}).drop("of")
    other = lists.search(wanting, negatives, False)
    return (other.withColumn("place", F.col("want") + 1).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
            .join(pairs, ["anchor_id", "place"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
