"""Connected components of a table of links, by joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.session import materialize

#: Rounds double the reach of a label, so this many serve chains of 2 ** 60 links; more means that the input changes under way.
MAX_ROUNDS = 60


def gathered(df: DataFrame) -> DataFrame:
    """Kept for several readers in about as many parts as the cluster has cores: links are small beside what they come from."""
    return materialize(df.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism)))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component is its smallest node.

    Each round hangs larger neighbours of a node, then smaller ones, on the smallest neighbour (large star, small star), which keeps
    the number of links within that of the input. It ends, after about log2 of the longest chain rounds, when every node hangs on one node that
    hangs on none. Rows stay in Spark. Nulls and links of a node with itself are left out; such nodes have no row. ``links`` should be
    materialised.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = gathered(small.where("u != v").distinct())
        # one row per node, and no node both hangs and is hung on: counted in one aggregation by node
        sides = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs")).distinct())
        unsettled = sides.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        if unsettled.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
