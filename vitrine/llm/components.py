"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node it is connected to, for every node of ``edges`` (a, b).

    Each round hangs every node's larger neighbours, and then its smaller ones,
    on the smallest node it knows, until every node hangs on a root; edges that
    are stars already take no round.  Minima are aggregated before the shuffle
    and stored, so that the join with the edges of a node with very many of them
    is between two plain shuffles, which Spark can split.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(pairs.distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _hung(both, F.col("b") > F.col("a"))
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = stored(_hung(down, F.lit(True)).distinct(), "edges")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionAll(edges.select("b", "b").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge down, and none if an edge leads to it."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select("b", F.lit(0), F.lit(1))
    )
    sums = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return sums.filter("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def _hung(edges: DataFrame, which) -> DataFrame:
    """Neighbours chosen by ``which``, and the node itself, each with the smallest node of the neighbourhood."""
    least = stored(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
    hung = edges.filter(which).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return hung.unionAll(own).filter("a <> b")
