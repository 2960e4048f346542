"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and lifted by one coordinate to unit
length, which turns the largest inner product into the smallest distance.  A
table hashes a lifted vector to the cell of ``floor((a.x + b) / w)`` over
several Gaussian projections ``a``.  A query visits the cells of a table in the
order of their estimated success: a neighbour at the cosine c of a query has
projections distributed as N(c a.q, 1 - c^2), so a cell's chance is a product
of normal intervals; cells are visited, best first, until the chances add up to
the table's share of the aimed-at recall.  Candidates of all tables are merged
and ranked by their exact inner products.

The number of projections follows the logarithm of the number of vectors, so
cells keep their size.  The cosine c is measured: a bounded sample of
``SAMPLE_QUERIES`` queries is compared with every vector, and c is the low
quantile ``LOW`` of the cosines of their k-th neighbours, so that queries in
groups of near copies do not shorten the visits of the others.

Scale: vectors are dealt to blocks of whole cells, a large cell over several
blocks; a query is sent once to each block that has a cell it visits, and one
task scores one block of vectors against up to ``QUERY_BLOCK`` queries and
returns the best few for each, so no pair leaves a task unless it is among
them.  Every vector is indexed.

Defined cases: vectors that are null, empty, zero, hold null or non-finite
components or have another length than most take no part (as queries they give
no rows); rows that repeat a vec_id count once, by their best score; ties go
to the smaller vec_id; a table with few vectors is one cell and so scanned
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspark.llm.shared import written

TABLES = 2
WIDTH = 2.0               # cell width, in standard deviations of a projection
CELL_ROWS = 256           # aimed-at vectors in a cell
AIM = 0.95                # recall aimed at, all tables together
SAMPLE_QUERIES = 100
LOW = 0.05
BLOCK_ROWS = 16_384
QUERY_BLOCK = 1_024
SEED = 7


def usable(vector: Column) -> Column:
    """Whether a vector takes part, its length apart."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    norm2 = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & ~F.coalesce(bad, F.lit(True)) & F.coalesce((norm2 > 0) & (norm2 < float("inf")), F.lit(False))


class Hash:
    """The projections of all tables for vectors of ``dim`` components with norms up to ``norm``."""

    def __init__(self, dim: int, norm: float, rows: int, cosine: float = 0.0):
        rng = np.random.default_rng(SEED)
        self.k = max(0, round(math.log(max(rows / CELL_ROWS, 1)) / math.log(2.3)))
        self.a = rng.normal(size=(TABLES, dim + 1, self.k))
        self.b = rng.random((TABLES, self.k)) * WIDTH
        self.norm, self.cosine = norm, min(max(cosine, 0.0), 0.999)
        self.code = rng.integers(1 << 62, size=(TABLES, 64), dtype=np.int64) | 1

    def cells(self, table: int, projected: np.ndarray) -> np.ndarray:
        """One number for each row of cell coordinates."""
        cell = np.floor((projected + self.b[table]) / WIDTH).astype(np.int64)
        return self.number(table, cell)

    def number(self, table: int, cell: np.ndarray) -> np.ndarray:
        out = np.full(len(cell), table, np.int64)
        with np.errstate(over="ignore"):
            for j in range(self.k):
                out = (out + cell[:, j]) * self.code[table, j]
                out ^= (out >> 29) & 0x7FFFFFFFF
        return out

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x / self.norm
        return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1)))[:, None]])

    def probes(self, table: int, q: np.ndarray) -> np.ndarray:
        """Numbers of the cells that the query visits in a table, best first."""
        t = (q / np.linalg.norm(q)) @ self.a[table][:-1]
        sd = math.sqrt(1 - self.cosine ** 2)
        share = 1 - (1 - AIM) ** (1 / TABLES)
        ranked = []  # for each projection: (cost, cell), cheapest first; cost is -log of the chance
        for j in range(self.k):
            mean = self.cosine * t[j] + self.b[table, j]
            low = math.floor((mean - 5 * sd) / WIDTH)
            high = math.floor((mean + 5 * sd) / WIDTH)
            phi = [0.5 * math.erfc((mean - c * WIDTH) / sd / math.sqrt(2)) for c in range(low, high + 2)]
            ranked.append(sorted((-math.log(max(p1 - p0, 1e-300)), low + i) for i, (p0, p1) in enumerate(zip(phi, phi[1:]))))
        heap = [(sum(r[0][0] for r in ranked), 0, (0,) * self.k)]
        cells, mass = [], 0.0
        while heap and mass < share:
            cost, last, ranks = heapq.heappop(heap)
            mass += math.exp(-cost)
            cells.append([ranked[j][ranks[j]][1] for j in range(self.k)])
            for j in range(last, self.k):
                r = ranks[j] + 1
                if r < len(ranked[j]):
                    heapq.heappush(heap, (cost + ranked[j][r][0] - ranked[j][r - 1][0], j, ranks[:j] + (r,) + ranks[j + 1:]))
        return np.unique(self.number(table, np.array(cells, np.int64).reshape(len(cells), self.k)))


def _matrix(batch: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, by score and then smaller id; ties at the edge are all looked at."""
    near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) > k else np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal rows give equal sums wherever they stand."""
    return np.einsum("ij,kj->ik", q, x, optimize=False)


def _neighbour_cosine(rows: DataFrame, dim: int, norm: float, k: int) -> float:
    """Low quantile of the cosines, in the lifted space, between sampled queries and their k-th neighbours among all rows."""
    sample = rows.filter("is_query").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_QUERIES).select("vec_id", "v").collect()
    ids, q = np.array([r[0] for r in sample]), np.array([r[1] for r in sample], np.float64)
    q /= np.linalg.norm(q, axis=1)[:, None]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.full((len(q), k), -np.inf)
        for batch in batches:
            x, own = _matrix(batch, "v", dim), np.asarray(batch.column(batch.schema.get_field_index("vec_id")))
            for at in range(0, len(x), 4096):
                s = q @ x[at:at + 4096].T
                s[ids[:, None] == own[None, at:at + 4096]] = -np.inf
                top = -np.sort(-np.hstack([top, s]), axis=1)[:, :k]
        yield pa.RecordBatch.from_pydict({"q": np.repeat(ids, k), "score": top.ravel()})

    found = rows.select("vec_id", "v").mapInArrow(best, "q long, score double")
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score")))
    kth = found.withColumn("r", rank).filter((F.col("r") <= k) & (F.col("score") > float("-inf"))).groupBy("q").agg(F.min("score").alias("s"))
    got = kth.agg(F.percentile("s", F.lit(LOW))).first()[0]
    return 0.0 if got is None else got / norm


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which ``is_query`` holds."""
    schema = "query_id long, rank int, vec_id long, score double"
    v = F.col(vector_col)
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(v)).select(
        F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    mode = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if mode is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dim, n = mode["dim"], mode["count"]
    rows = rows.filter(F.size("v") == dim)
    norm = math.sqrt(rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))).first()[0])
    hashed = Hash(dim, norm, n, _neighbour_cosine(rows, dim, norm, k))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = hashed.lifted(_matrix(batch, "v", dim))
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays([pa.array(hashed.cells(t, x @ hashed.a[t])), batch.column(0), batch.column(1)],
                                                 names=["cell", "vec_id", "v"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch, "v", dim)
            for i, query in enumerate(batch.column(0).to_pylist()):
                cells = np.concatenate([hashed.probes(t, q[i]) for t in range(TABLES)])
                yield pa.RecordBatch.from_pydict({"query_id": np.full(len(cells), query, np.int64), "cell": cells})

    indexed = rows.select("vec_id", "v").mapInArrow(index, "cell long, vec_id long, v array<double>")
    stats = written(indexed.groupBy("cell").count().withColumn("parts", F.ceil(F.col("count") / BLOCK_ROWS).cast("int")), "lsh-cells")
    blocks = max(1, -(-n * TABLES // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("cell", "part"), F.lit(blocks)).cast("int")
    placed = (indexed.join(stats, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
              .select("cell", "vec_id", "v", block.alias("block")))
    queries = rows.filter("is_query").select("vec_id", "v").dropDuplicates(["vec_id"])
    visits = (queries.repartition("vec_id").mapInArrow(probe, "query_id long, cell long").join(stats, "cell")
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .groupBy("query_id", block.alias("block")).agg(F.collect_set("cell").alias("cells")))
    n_queries = queries.count()
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    asked = (visits.join(queries.select(F.col("vec_id").alias("query_id"), "v"), "query_id")
             .withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int")))
    # Each block of vectors meets each block of queries that visits it.
    placed = placed.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The k best of a block of vectors for each query of a block."""
        out = [pd.DataFrame({"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], float)})]
        if len(left) and len(right):
            x, ids = np.stack(left.v.to_numpy()), left.vec_id.to_numpy()
            known, cell = np.unique(left.cell.to_numpy(), return_inverse=True)
            # A vector stands in the block once for each table, or more often if its row is repeated.
            often = int(np.unique(ids, return_counts=True)[1].max())
            for at in range(0, len(right), 32):
                part = right.iloc[at:at + 32]
                products = _products(np.stack(part.v.to_numpy()), x)
                for s, query, cells in zip(products, part.query_id, part.cells):
                    pick = np.flatnonzero(np.isin(known, cells)[cell] & (ids != query))
                    top = pick[_best(s[pick], ids[pick], k * often)]
                    top = top[np.sort(np.unique(ids[top], return_index=True)[1])][:k]
                    out.append(pd.DataFrame({"query_id": query, "vec_id": ids[top], "score": s[top]}))
        return pd.concat(out)

    found = (placed.groupBy("block", "query_block").cogroup(asked.groupBy("block", "query_block"))
             .applyInPandas(score, "query_id long, vec_id long, score double"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
