"""Mixing sources to target weights by systematic sampling.

A source's target divided by its size is the number of copies expected of each
of its documents.  Documents are put in a fixed order inside their source, the
expected copies are prefix-summed, one offset drawn for the source is added,
and a document is emitted once for each integer that its step crosses.  The
order goes by size class first, so every class is sampled at the same rate and
the taken words stay close to the target even where few documents are long.

Scale: only (doc_id, source, size) is shuffled.  A prefix sum of equal steps
needs just the document's rank, and the rank is the number of documents in
earlier cells plus the rank inside the cell; cells are slices of a size class
with about max(256, sqrt(source rows)) documents, so a hot source is spread
over many tasks and its list of cells stays short.  Sizes are computed once
and written to the shared folder.

Defined cases: a null text has size 0; a null source is a source of its own,
ordered last; equal rows are ranked in either order, which gives the same
result; sources or tables without words have target 0 and take nothing; an
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspark.llm.shared import own_name, words, written

WEIGHTS = [5, 2, 1]      # by the rank of the source, repeating
SHARE = 1.5              # words of the mix, as a multiple of all words
MAX_REPEATS = 2          # targets stop at this multiple of the source's words
SEED = "mix-1"
CELL_ROWS = 256
OFFSET_STEPS = 1 << 20   # the offset is a multiple of 1 / OFFSET_STEPS, so that sums stay exact


def doc_size(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def size_class(size: Column) -> Column:
    """0..15 as they are, then eight classes for each doubling."""
    shift = F.greatest(F.length(F.bin(size)) - 4, F.lit(0))
    return F.when(size < 16, size).otherwise(shift * 8 + F.call_function("shiftright", size, shift)).cast("int")


def targets(sizes: DataFrame, weights: list[float], share: float, max_repeats: float) -> DataFrame:
    """source, source_size, source_docs, target: water filling up to ``max_repeats`` times a source's size.

    With sources in the order of their cap per weight, those before a row are capped when the row is
    reached; the row is capped too if the level that would be left reaches its own cap."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    # One row for each source from here on.
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats))).withColumn("ratio", F.col("cap") / F.col("weight"))
    every = W.partitionBy()
    order = W.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))))
    per = per.withColumn("level", level).withColumn("capped", F.col("level") >= F.col("ratio"))
    final = F.min(F.when(~F.col("capped"), F.struct("ratio", "level"))).over(every)["level"]
    return (per.withColumn("final", final)
            .select("source", "source_size", "source_docs",
                    F.when(F.col("capped"), F.col("cap")).otherwise(F.col("final") * F.col("weight")).alias("target")))


def offset(source: Column, seed: str) -> Column:
    """The source's offset in [0, 1)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("\x00null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") / OFFSET_STEPS


def mix_counts(docs: DataFrame, weights: list[float] = WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS,
               seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies for each row of ``docs`` (doc_id, source, text)."""
    sizes = written(docs.select("doc_id", "source", doc_size(F.col("text")).alias("size"))
                    .withColumn("class", size_class(F.col("size")))
                    .withColumn("mark", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))), "mix-sizes")
    per = written(targets(sizes, weights, share, max_repeats), "mix-targets")
    # Number of slices of each size class; a slice is a range of the digest, so slices keep the order.
    classes = sizes.groupBy("source", "class").count()
    slices = classes.alias("c").join(per.alias("p"), F.col("c.source").eqNullSafe(F.col("p.source"))).select(
        F.col("c.source").alias("k_source"), F.col("class").alias("k_class"), "source_size", "target",
        F.greatest(F.ceil(F.col("count") / F.greatest(F.lit(float(CELL_ROWS)), F.sqrt("source_docs"))), F.lit(1)).alias("n_slices"))
    slices = written(slices, "mix-slices")
    part = F.conv(F.substring("mark", 1, 8), 16, 10).cast("double") / float(1 << 32)
    cells = (sizes.join(slices, F.col("source").eqNullSafe(F.col("k_source")) & (F.col("class") == F.col("k_class")))
             .withColumn("slice", F.floor(part * F.col("n_slices"))))
    inside = F.row_number().over(W.partitionBy("source", "class", "slice").orderBy("mark", "size")) - 1
    cells = cells.withColumn("inside", inside)
    counts = written(sizes.join(slices, F.col("source").eqNullSafe(F.col("k_source")) & (F.col("class") == F.col("k_class")))
                     .groupBy("source", "class", F.floor(part * F.col("n_slices")).alias("slice")).agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    before = F.sum("n").over(W.partitionBy("source").orderBy("class", "slice").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(F.col("source").alias("b_source"), F.col("class").alias("b_class"), F.col("slice").alias("b_slice"),
                           F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cells.join(starts, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("class") == F.col("b_class"))
                        & (F.col("slice") == F.col("b_slice")))
    rank = (F.col("before") + F.col("inside")).cast("double")
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = offset(F.col("source"), seed)
    crossed = F.floor((rank + 1) * step + u) - F.floor(rank * step + u)
    # The bound only guards against rounding: a step is never longer than max_repeats.
    return ranked.select("doc_id", "source", "size", "source_size", "target",
                         F.least(crossed, F.lit(max_repeats)).cast("long").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows: each row of ``docs`` as often as the mix takes it, columns as they were.

    Rows with the same doc_id, source and size are interchangeable for the mix; their copies are dealt to
    them in the order of their texts."""
    size, turn, n = own_name(docs, "mix_size"), own_name(docs, "mix_turn"), own_name(docs, "mix_copy")
    t = {c: own_name(docs, f"mix_t_{c}") for c in ("doc_id", "source", "size", "turn", "copies")}
    counts = mix_counts(docs, **options)
    counts = counts.withColumn("turn", F.row_number().over(W.partitionBy("doc_id", "source", "size").orderBy(F.desc("copies"))))
    counts = counts.filter(F.col("copies") > 0).select(*[F.col(c).alias(a) for c, a in t.items()])
    rows = docs.withColumn(size, doc_size(F.col("text")))
    rows = rows.withColumn(turn, F.row_number().over(W.partitionBy("doc_id", "source", size).orderBy("text")))
    on = (F.col("doc_id").eqNullSafe(F.col(t["doc_id"])) & F.col("source").eqNullSafe(F.col(t["source"]))
          & (F.col(size) == F.col(t["size"])) & (F.col(turn) == F.col(t["turn"])))
    taken = rows.join(counts, on).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(t["copies"]).cast("int"))))
    return taken.select(*docs.columns)
