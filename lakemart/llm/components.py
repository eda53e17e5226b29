"""Connected components of an undirected link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.store import discard, written


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``.

    The component is the smallest node id reachable. Rounds alternate two
    steps: link each node's larger neighbours to its smallest neighbour, then
    its smaller neighbours and itself to the smallest. Both need one minimum
    per node (combined before the shuffle) and an equi-join that AQE may
    split, so a node with very many links is never gathered. Every round is
    written to the shared folder and replaces the one before. Self links and nulls are ignored.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        nxt = written(small, "edges")
        # done when every edge joins a node to one root that has no smaller neighbour
        again = nxt.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() or \
            nxt.join(nxt.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        discard(edges)
        edges = nxt
        if not again:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
