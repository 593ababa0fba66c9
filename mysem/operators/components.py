"""Connected parts of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mysem.session import written


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of ``edges`` (``a, b``) with an edge to another node; the label is the least node of the connected part.

    Every node is linked to the least of its neighbours in turn with all larger ones and with all smaller ones, until nothing changes: about
    log(n) rounds, each of them written. Neighbours are never gathered, only the least of them is, so a node may have any number.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now, before = written(now, "edges"), None
    while True:
        # Larger neighbours to the least of all neighbours and the node itself.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = written(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct(), "edges")
        # Smaller neighbours, and the node itself, to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = written(small.where("a > b").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        before = state
