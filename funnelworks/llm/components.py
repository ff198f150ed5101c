"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelworks.llm.storage import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's neighbours on the node's smallest neighbour.

    Large star: the larger neighbours of every node.  Small star: the
    smaller ones, with the node itself.  The smallest neighbour is a partial
    aggregate; it is joined back from a table, so that the adaptive skew join
    can split the edges of a node with very many neighbours.  Edges may repeat
    in the result, which has no more rows than ``edges`` (small star: and one
    a node)."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
        out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has either one edge to a smaller node or only edges
    from larger ones: then each component is a star around its smallest node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up + down > 1").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge (a, b); component is
    the smallest node that can be reached.  Alternates large and small stars
    until all components are stars, which edges that are stars already need
    no round for; each round is a table in the shared folder."""
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    while not _is_stars(now):
        now = stored(_stars(_stars(now, True), False).distinct(), "edges")
    tops = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        tops.withColumn("component", F.col("node"))
    )
