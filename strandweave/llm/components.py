"""Connected components of a distributed edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scaling import cut_lineage
from .common import stored


def _minimum(pairs: DataFrame) -> DataFrame:
    """(u, m): smallest of u and its neighbours. Aggregated before the shuffle, so a hot u sends one row per task.

    Stored, so that joins with it have two plain shuffles, of which the rows of a hot u can be split.
    """
    return stored(pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "stars")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of u to the smallest member of u's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minimum(both), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _stars(edges: DataFrame) -> bool:
    """Whether every u hangs on one v that hangs on nothing: then v names the component."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    roles = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.filter("up > 1 or up = 1 and down = 1").isEmpty()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links u and its smaller neighbours to the smallest of them; every edge has u > v here."""
    least = _minimum(edges)
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """(node, component) of every node on an edge; the component's name is its smallest node.

    Edges with a null end are left out; a loop makes a component of its node alone; repeated edges change
    nothing; no edges give no rows. Each round is checkpointed; the driver learns only whether all are stars yet.
    """
    given = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    now = cut_lineage(given.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    links = now.filter("u <> v")
    while not _stars(links):
        links = cut_lineage(_small_star(stored(_large_star(links), "large-stars")))
    roots = now.select(F.col("v").alias("node")).unionByName(now.select(F.col("u").alias("node"))).distinct()
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return (roots.join(found, "node", "left")
            .select("node", F.coalesce("component", "node").alias("component")))
