"""Connected components of a distributed edge list."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scaling import cut_lineage, stored


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its partners; merged before the shuffle, stored so that joins with it are plain."""
    return stored(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")


def _hang(pairs: DataFrame) -> DataFrame:
    """Every v of a pair (u, v), and u itself, hung on the smallest node around u."""
    near = _least(pairs)
    moved = pairs.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(near.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node on an edge of two different nodes; the component is its smallest node.

    Larger neighbours and smaller neighbours take turns in being hung on the smallest node around (two-phase stars),
    which needs about log n rounds, each a checkpoint. No edges give no rows.
    """
    links = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct())
    while True:
        back = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
        # of both directions only the larger ends move: u's smaller ones do so in the next step
        near = _least(links.unionByName(back))
        large = stored(links.unionByName(back).join(near, "u").filter("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        after = cut_lineage(_hang(large).filter("u > v").distinct())
        # done when every node hangs on one that itself hangs on none
        roots = after.select(F.col("v").alias("u")).distinct()
        several = after.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if several.isEmpty() and after.join(roots, "u", "left_semi").isEmpty():
            break
        links = after
    return after.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(roots.select(F.col("u").alias("node"), F.col("u").alias("component")))
