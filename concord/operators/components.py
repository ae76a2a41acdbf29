"""Connected components of an undirected edge table by alternating star joins.

Each round first links every node's larger neighbours to its smallest one, then
its smaller neighbours; both steps only aggregate and join by node, so no group
is gathered in a task and a node with many links is split by the adaptive
skew join. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.session import scratch, written


def _least(edges: DataFrame) -> DataFrame:
    """(u, v) both ways with m, the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _settled(stars: DataFrame) -> bool:
    """Every node points to one root, and no root points on."""
    ends = stars.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(stars.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out > 0 and into > 0)").limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b), any comparable type, to (node, component): the least node reachable; nodes without edges are not listed."""
    with scratch(edges.sparkSession) as folders:
        stars = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
        while not _settled(stars):  # a number of rounds that grows with the logarithm of the nodes
            both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(stars.select(F.col("b").alias("u"), F.col("a").alias("v")))
            large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
            # in ``large`` every row points from the larger to the smaller end
            small = _least(large)
            fresh = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
            stars = written(fresh, "stars")
            folders.discard(stars)
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
