"""Optical duplicates: copies of a fragment that were read beside each other on the flow cell.

Read names end in ``:tile:x:y``. Two fragments of one duplicate set are neighbours if both their x and their y on one tile
differ by at most a distance, and a cluster is what neighbours join. A tile is divided into square cells one wider than the
distance, so all members of a cell are neighbours and a cell counts as one node. Whether cells that touch are joined needs
only their extreme x or y, or, across a corner, their extreme y at every x. So no pair of fragments is ever formed, and a
set of any size is aggregated by cell before the shuffle.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.components import components
from ..functions.scaling import stored
from .dedup import duplication_metrics, fragments, library_size

#: name of the run, lane and tile; x; y; anything after a space, # or /
PLACE = r"^([^\s#/]*:[0-9]+):([0-9]{1,9}):([0-9]{1,9})(?:[\s#/].*)?$"
SET = ["library", "end_a", "end_b", "ends"]
CELL = [*SET, "place", "cx", "cy"]


def _placed(frags: DataFrame, distance: int) -> DataFrame:
    part = lambda k: F.regexp_extract("read_name", PLACE, k)
    rows = frags.withColumn("place", part(1)).filter("place <> ''")
    rows = rows.withColumns({"x": part(2).cast("bigint"), "y": part(3).cast("bigint")})
    return rows.withColumns({"cx": F.floor(F.col("x") / (distance + 1)), "cy": F.floor(F.col("y") / (distance + 1))})


def _touching(cells: DataFrame, right: int, up: int) -> DataFrame:
    """(a, b) and the extremes of cells b that lie so many cells to the right of and above a."""
    a = cells.select(*SET, "place", (F.col("cx") + right).alias("cx"), (F.col("cy") + up).alias("cy"), F.col("id").alias("a"),
                     *[F.col(c).alias(f"a_{c}") for c in ("x0", "x1", "y0", "y1")])
    return cells.withColumnRenamed("id", "b").join(a, CELL)


def _corners(points: DataFrame, cells: DataFrame, distance: int) -> DataFrame:
    """Cells that are joined across a corner: some b is at most ``distance`` right of, and above (or below), some a."""
    near = F.col("x0") - F.col("a_x1") <= distance
    above = _touching(cells, 1, 1).filter(near & (F.col("y0") - F.col("a_y1") <= distance)).select("a", "b", F.lit(1).alias("turn"))
    below = _touching(cells, 1, -1).filter(near & (F.col("a_y0") - F.col("y1") <= distance)).select("a", "b", F.lit(-1).alias("turn"))
    pairs = stored(above.unionByName(below), "corners")
    # at most distance + 1 rows a cell
    columns = points.groupBy(*CELL, "x").agg(F.min("y").alias("lo"), F.max("y").alias("hi")).join(cells.select(*CELL, "id"), CELL)
    columns = columns.select("id", "x", "lo", "hi")
    highest = F.when(F.col("turn") > 0, F.col("hi")).otherwise(-F.col("lo"))
    lowest = F.when(F.col("turn") > 0, F.col("lo")).otherwise(-F.col("hi"))
    empty = F.lit(None).cast("bigint")
    sides = (columns.join(pairs.withColumnRenamed("a", "id").withColumn("a", F.col("id")), "id")
             .select("a", "b", F.col("x").alias("at"), highest.alias("reach"), empty.alias("needs"))
             .unionByName(columns.join(pairs.withColumnRenamed("b", "id").withColumn("b", F.col("id")), "id")
                          .select("a", "b", (F.col("x") - distance).alias("at"), empty.alias("reach"), (lowest - distance).alias("needs"))))
    so_far = Window.partitionBy("a", "b").orderBy(F.desc("at"), F.asc_nulls_first("needs"))
    return sides.withColumn("reach", F.max("reach").over(so_far)).filter("needs <= reach").select("a", "b").distinct()


def optical_clusters(frags: DataFrame, distance: int = 100) -> DataFrame:
    """Per cluster of placed ``fragments``: its set's columns, its size ``n`` and its best fragment ``read_name``.

    The largest score is best, then the smallest name, as in the whole set.
    """
    points = stored(_placed(frags, distance).select(*CELL, "x", "y", "score", "read_name"), "places")
    cells = stored(points.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.min(F.struct((-F.col("score")).alias("s"), F.col("read_name").alias("n"))).alias("best"))
        .withColumn("id", F.monotonically_increasing_id()), "cells")
    beside = _touching(cells, 1, 0).filter(F.col("x0") - F.col("a_x1") <= distance).select("a", "b")
    over = _touching(cells, 0, 1).filter(F.col("y0") - F.col("a_y1") <= distance).select("a", "b")
    joined = components(beside.unionByName(over).unionByName(_corners(points, cells, distance)), "a", "b")
    of = cells.join(joined.withColumnRenamed("node", "id"), "id", "left")
    return (of.groupBy(*SET, F.coalesce("component", "id").alias("cluster"))
            .agg(F.sum("n").alias("n"), F.min("best").alias("best"))
            .select(*SET, "n", F.col("best.n").alias("read_name")))


def optical_duplicates(df: DataFrame, distance: int = 100) -> DataFrame:
    """(library, read_name, optical) of every mapped fragment: all members of a cluster but its best are optical.

    Names without a place are never optical. Flags return over the unique name, not over the set or the cluster.
    """
    frags = stored(fragments(df), "fragments")
    best = optical_clusters(frags, distance).select("library", "read_name", F.lit(True).alias("_best"))
    placed = F.regexp_extract("read_name", PLACE, 1) != ""
    return (frags.join(best, ["library", "read_name"], "left")
            .select("library", "read_name", (placed & F.col("_best").isNull()).alias("optical")))


def optical_metrics(df: DataFrame, distance: int = 100) -> DataFrame:
    """``duplication_metrics`` with the optical share of the pair duplicates, which the library size then leaves out."""
    clusters = optical_clusters(fragments(df), distance).filter("ends = 2")
    counts = clusters.groupBy("library").agg(F.sum(F.col("n") - 1).alias("optical"))
    optical = F.coalesce("optical", F.lit(0)).cast("bigint")
    return duplication_metrics(df).join(counts, "library", "left").withColumn("optical_pair_duplicates", optical).withColumn(
        "estimated_library_size", library_size(F.col("pairs") - F.col("optical_pair_duplicates"), F.col("pairs") - F.col("pair_duplicates"))
    ).drop("optical")
