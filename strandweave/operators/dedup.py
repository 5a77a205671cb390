"""Duplicate fragments: marking, removing, counting.

A copy group may be any share of the data. Winners are found by aggregates with
map-side merging, and flags travel back over the read name, which is unique per
fragment, never over the group key.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions import cigar as C
from ..functions.bases import has_flag

SCORED_QUALITY = 15
#: Reads without a group, or of a group without a library, count as one library of this name.
NO_LIBRARY = "unknown"


def _library():
    return F.coalesce(F.col("read_group.library"), F.lit(NO_LIBRARY))


def fragments(df: DataFrame) -> DataFrame:
    """One row per fragment with its ordered ends and its quality score."""
    flag = F.col("flag")
    reverse = has_flag(flag, M.REVERSE)
    score = F.aggregate("quals", F.lit(0), lambda acc, q: acc + F.when(q >= SCORED_QUALITY, q).otherwise(0))
    ends = df.filter(~has_flag(flag, M.UNMAPPED | M.NOT_PRIMARY)).select(
        _library().alias("library"), "read_name", "mapq",
        # position and strand packed to one number per end: aggregates in place
        (F.col("contig_idx").cast("bigint") * (1 << 32)
         + C.five_prime(F.col("pos"), F.col("cigar"), reverse).cast("bigint") * 2
         + reverse.cast("int")).alias("end"),
        score.cast("bigint").alias("score"))
    return ends.groupBy("library", "read_name").agg(
        F.min("end").alias("end_a"), F.max("end").alias("end_b"),
        F.count(F.lit(1)).alias("ends"), F.sum("score").alias("score"), F.min("mapq").alias("mapq"))


def _winners(frags: DataFrame) -> DataFrame:
    return (frags.groupBy("library", "end_a", "end_b", "ends")
            .agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("read_name").alias("n"))).alias("w"))
            .select("library", F.col("w.n").alias("read_name"), F.lit(True).alias("_best")))


def mark_duplicates(df: DataFrame, remove: bool = False) -> DataFrame:
    """Keeps the best fragment of each group of equal library, ends and strands.

    The largest sum of qualities of at least 15 wins, then the smallest name.
    Single mapped ends form groups of their own. Losers get flag 0x400, or are
    dropped with ``remove``.
    """
    flag = F.col("flag")
    judged = ~has_flag(flag, M.UNMAPPED | M.NOT_PRIMARY)
    rows = df.withColumn("library", _library()).join(_winners(fragments(df)), ["library", "read_name"], "left")
    clear = flag.bitwiseAND(F.lit(~M.DUPLICATE))
    duplicate = judged & F.col("_best").isNull()
    rows = rows.withColumn("flag", F.when(duplicate, clear.bitwiseOR(F.lit(M.DUPLICATE)))
                           .when(judged, clear).otherwise(flag).cast("int"))
    if remove:
        rows = rows.filter(~has_flag(flag, M.DUPLICATE))
    return rows.select(*df.columns)


def duplication_metrics(df: DataFrame) -> DataFrame:
    """Per library: pairs, singles, duplicates, their share, estimated library size.

    ``df`` needs no marking. The size solves ``unique = size (1 - exp(-pairs / size))``
    by sixty halvings on the per-library rows.
    """
    groups = fragments(df).groupBy("library", "end_a", "end_b", "ends").agg(F.count(F.lit(1)).alias("n"))
    pair = F.col("ends") == 2
    table = groups.groupBy("library").agg(
        F.coalesce(F.sum(F.when(pair, F.col("n"))), F.lit(0)).alias("pairs"),
        F.coalesce(F.sum(F.when(~pair, F.col("n"))), F.lit(0)).alias("singles"),
        F.coalesce(F.sum(F.when(pair, F.col("n") - 1)), F.lit(0)).alias("pair_duplicates"),
        F.coalesce(F.sum(F.when(~pair, F.col("n") - 1)), F.lit(0)).alias("single_duplicates"))
    reads = F.col("singles") + F.col("pairs") * 2
    percent = F.round((F.col("single_duplicates") + F.col("pair_duplicates") * 2) / reads, 6)
    return table.withColumns({
        "percent_duplication": percent,
        "estimated_library_size": library_size(F.col("pairs"), F.col("pairs") - F.col("pair_duplicates")),
    })


def library_size(observed, unique):
    """Molecules in the library when ``unique`` of ``observed`` draws differ; NULL without copies."""
    n, c = observed.cast("double"), unique.cast("double")
    # 1 - exp(-t) >= t - t^2 / 2 puts the root below this end, however few the copies
    most = n * n / (F.lit(2.0) * c * F.greatest(n - c, F.lit(1.0))) + 1
    start = F.struct(F.lit(1.0).alias("lo"), most.alias("hi"))

    def halve(acc, _):
        mid = (acc["lo"] + acc["hi"]) / 2
        low = mid * (1 - F.exp(-n / (mid * c))) < 1
        return F.struct(F.when(low, mid).otherwise(acc["lo"]).alias("lo"),
                        F.when(low, acc["hi"]).otherwise(mid).alias("hi"))

    size = F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, halve,
                       lambda acc: F.round(c * (acc["lo"] + acc["hi"]) / 2).cast("bigint"))
    return F.when((unique > 0) & (unique < observed), size)


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Of fragments with the same outer coordinates only the best mapq stays.

    Ties go to the smallest name. Rows that are unmapped or not primary stay.
    """
    flag = F.col("flag")
    judged = ~has_flag(flag, M.UNMAPPED | M.NOT_PRIMARY)
    outer = df.filter(judged).groupBy("contig_idx", "read_name").agg(
        F.min("pos").alias("lo"), F.max(C.reference_end(F.col("pos"), F.col("cigar"))).alias("hi"),
        F.max("mapq").alias("mapq"))
    best = (outer.groupBy("contig_idx", "lo", "hi")
            .agg(F.min(F.struct((-F.col("mapq")).alias("m"), F.col("read_name").alias("n"))).alias("w"))
            .select("contig_idx", F.col("w.n").alias("read_name"), F.lit(True).alias("_best")))
    return (df.join(best, ["contig_idx", "read_name"], "left")
            .filter(~judged | F.col("_best").isNotNull()).select(*df.columns))
