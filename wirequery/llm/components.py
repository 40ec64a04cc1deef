"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scope


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hook neighbours to each node's least neighbour: the larger ones (large star), or the smaller ones and itself."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(low, "a")
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, scope: Scope | None = None) -> DataFrame:
    """(node, root) for every node of links (a, b: long) that isn't its component's least node; roots are the least nodes.

    Ends when a round changes nothing: then each node hangs on its root. The links stay distributed throughout; each
    round's table replaces that of the round before. No links give no rows; links of a node to itself don't count.
    """
    scope = scope or Scope(links.sparkSession)
    edges = scope.cut(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    sign = None
    while True:
        old, edges = edges, scope.cut(_star(_star(edges, True), False), "stars")
        scope.free(old)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == sign or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        sign = now
