"""Connected components of a list of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """node, root for each node of ``links`` (a, b): one root for each connected component.

    In a round every node takes the neighbour, or itself, with the smallest hash of that round; links are
    rewritten to those and links inside a node dropped, until none is left.  As the order differs from round to
    round, a path loses a constant share of its nodes each time, so rounds grow with the logarithm of the
    longest chain.  Neighbours are only aggregated, never gathered; each round is written to the shared folder."""
    links = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    roots = None
    turn = 0
    while links.take(1):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("n"))
        parents = written(both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("low"))
                          .select("node", F.least("low", rank("node"))["n"].alias("parent")), "parents")
        if roots is None:
            roots = parents.select("node", F.col("parent").alias("root"))
        else:
            up = parents.select(F.col("node").alias("root"), "parent")
            roots = roots.join(up, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
        roots = written(roots, "roots")
        for end in ("a", "b"):
            up = parents.select(F.col("node").alias(end), F.col("parent").alias("up"))
            other = "b" if end == "a" else "a"
            links = links.join(up, end).select(F.col("up").alias(end), other)
        links = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        turn += 1
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
