"""Connected components by alternating stars, all on shuffled edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Links of every node's neighbours to the smallest of them and the node itself."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("least")).select(
        "a", F.least("a", "least").alias("least")
    )
    return edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node is either a root or linked to one root only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return sums.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node in ``edges``.

    ``edges`` has the long columns ``a`` and ``b``; directions, loops and repeats do not
    matter, nulls are left out.  A large-star step links each node's larger neighbours to
    its smallest, a small-star step the smaller ones; minima are summed up before the
    shuffle, so a node with a third of all edges is no hot group.  Every round is
    written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    clean = edges.where("a IS NOT NULL AND b IS NOT NULL")
    loops = clean.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    now = materialize(
        clean.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "component-edges",
    )
    while not _is_settled(now):
        ways = _both_ways(now)
        large = _star(ways.where("b > a"), ways).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
                    F.struct(F.col("a").alias("a"), F.col("least").alias("b")),
                )
            ).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        now = materialize(small, "component-edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("root").alias("root"))
