"""Connected components of a graph that lies in tables: no edge ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import discard, stored



def components(edges: DataFrame) -> DataFrame:
    """v and c, the least vertex of its component, for each vertex of the edges a-b (longs).

    Each round hangs all greater neighbours of a vertex on its least neighbour, then a vertex and its lesser neighbours on
    the least of these, until every vertex hangs on a root: minima with map-side combine, and joins that AQE may split.
    """
    hung = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("c")).distinct())
    before = None
    while True:  # the number of rounds grows with the logarithm of the graph's diameter
        state = tuple(hung.agg(F.count("*"), F.sum(F.xxhash64("v", "c").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return hung
        before = state
        both = hung.union(hung.select(F.col("c").alias("v"), F.col("v").alias("c")))
        least = both.groupBy("v").agg(F.least(F.min("c"), F.first("v")).alias("m"))
        far = both.join(least, "v").where("c > v").select(F.col("c").alias("v"), F.col("m").alias("c")).where("v <> c").distinct()
        near = far.groupBy("v").agg(F.min("c").alias("m"))
        gone, hung = hung, stored(far.join(near, "v").select(F.col("c").alias("v"), F.col("m").alias("c")).where("v <> c").union(near.select("v", F.col("m").alias("c"))).distinct())
        discard(gone)
