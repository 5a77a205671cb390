"""Reads before alignment: mates, trimming, read groups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_mates(left: DataFrame, right: DataFrame, on: str = "read_name") -> DataFrame:
    """One row per fragment; ``status`` tells which mate is missing, if any."""
    l = left.select(on, F.col("seq").alias("left_seq"), F.col("quals").alias("left_quals"))
    r = right.select(on, F.col("seq").alias("right_seq"), F.col("quals").alias("right_quals"))
    status = F.when(F.col("right_seq").isNull(), "left_only") \
        .when(F.col("left_seq").isNull(), "right_only").otherwise("paired")
    return l.join(r, on, "full_outer").withColumn("status", status)


def trim_reads(df: DataFrame, q0: int) -> DataFrame:
    """Cuts the 3' end where the suffix sum of ``q0 - q`` is largest.

    The shortest cut wins a tie; with ``q0 = 0`` no sum is positive and nothing
    is cut. ``quals`` are in sequencing order.
    """
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("best"), F.lit(0).alias("cut"), F.lit(0).alias("n"))

    def step(acc, q):
        total, n = acc["sum"] + (F.lit(q0) - q), acc["n"] + 1
        better = total > acc["best"]
        return F.struct(total.alias("sum"), F.when(better, total).otherwise(acc["best"]).alias("best"),
                        F.when(better, n).otherwise(acc["cut"]).alias("cut"), n.alias("n"))

    cut = F.aggregate(F.reverse("quals"), start, step, lambda acc: acc["cut"])
    return (df.withColumn("_keep", F.size("quals") - cut)
            .withColumns({"seq": F.substring("seq", F.lit(1), F.col("_keep")),
                          "quals": F.slice("quals", F.lit(1), F.col("_keep"))})
            .drop("_keep"))


def attach_read_group(df: DataFrame, id: str, sample: str, library: str,
                      platform: str, unit: str) -> DataFrame:
    """Sets or replaces the read group of every row."""
    fields = {"id": id, "sample": sample, "library": library, "platform": platform, "unit": unit}
    return df.withColumn("read_group", F.struct(*[F.lit(v).alias(k) for k, v in fields.items()]))
