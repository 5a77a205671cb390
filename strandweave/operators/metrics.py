"""Quality metrics. Rows are reduced to small keyed counts before anything else."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import model as M
from ..functions import cigar as C
from ..functions.bases import has_flag
from ..functions.intervals import coverage_runs, merge_intervals, overlap_join
from .dedup import library_size
from .pileup import base_rows, match_ranges
from .recalibrate import machine_cycle
from .reference import reference_pieces, windows_of

COVERAGE_STEPS = [1, 2, 10, 20, 30]
NEAR = 250


def _primary(df: DataFrame) -> DataFrame:
    return df.filter(~has_flag(F.col("flag"), M.NOT_PRIMARY))


def contig_read_counts(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Mapped and unmapped rows of every contig, with zeros."""
    unmapped = has_flag(F.col("flag"), M.UNMAPPED)
    counts = df.groupBy("contig_idx").agg(
        F.count_if(~unmapped).alias("mapped"), F.count_if(unmapped).alias("unmapped"))
    return contigs.select("contig_idx", "contig", "contig_len").join(counts, "contig_idx", "left") \
        .na.fill(0, ["mapped", "unmapped"])


def hs_metrics(df: DataFrame, baits: DataFrame, targets: DataFrame, genome_length: int | None = None) -> DataFrame:
    """Bases on, near and off the baits; coverage of the targets; fold enrichment.

    One join of the reads with all intervals, labelled, and one sum over the
    reads. Target bases without reads count through the known target length, so
    no zero rows are made.
    """
    ranges = match_ranges(df)
    wide = merge_intervals(baits.select(
        "contig_idx", F.greatest(F.col("start") - NEAR, F.lit(1)).alias("start"), (F.col("end") + NEAR).alias("end")))
    named = [i.select("contig_idx", "start", "end", F.lit(kind).alias("kind")) for kind, i in (
        ("bait", merge_intervals(baits)), ("wide", wide), ("target", merge_intervals(targets)))]
    labelled = named[0].unionByName(named[1]).unionByName(named[2])
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    total = ranges.agg(F.coalesce(F.sum((F.col("end") - F.col("start") + 1).cast("bigint")), F.lit(0)).alias("bases"))
    inside = overlap_join(ranges, labelled).select(
        F.struct("kind", "contig_idx").alias("contig_idx"), F.greatest("start", "iv_start").alias("start"),
        F.least("end", "iv_end").alias("end"))
    runs = coverage_runs(inside).withColumn("kind", F.col("contig_idx.kind"))
    length = (F.col("end") - F.col("start") + 1).cast("bigint")
    zero = lambda c: F.coalesce(c, F.lit(0))
    covered = runs.agg(
        *[zero(of(kind, length * F.col("depth"))).alias(name) for kind, name in (
            ("bait", "on_bait"), ("wide", "in_reach"), ("target", "target_bases"))],
        *[zero(of("target", F.when(F.col("depth") >= n, length))).alias(f"at_{n}") for n in COVERAGE_STEPS])
    sizes = labelled.agg(of("target", length).alias("target_length"), of("bait", length).alias("bait_length"))
    parts = [total, covered, sizes]
    row = parts[0].withColumn("_one", F.lit(1))
    for part in parts[1:]:
        row = row.join(part.withColumn("_one", F.lit(1)), "_one")
    if genome_length is None:
        enrichment = F.lit(None).cast("double")
    else:
        enrichment = F.round((F.col("on_bait") / F.col("bases")) / (F.col("bait_length") / F.lit(genome_length)), 4)
    return row.select(
        "bases", "on_bait", (F.col("in_reach") - F.col("on_bait")).alias("near_bait"),
        (F.col("bases") - F.col("in_reach")).alias("off_bait"),
        "target_length", "bait_length",
        F.round(F.col("target_bases") / F.col("target_length"), 6).alias("mean_target_coverage"),
        *[F.round(F.col(f"at_{n}") / F.col("target_length"), 6).alias(f"share_at_{n}x") for n in COVERAGE_STEPS],
        enrichment.alias("fold_enrichment"))


def alignment_summary(df: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per first, second and all reads: counts, rates, mean length, strand balance."""
    rows = _primary(df)
    flag = F.col("flag")
    aligned = ~has_flag(flag, M.UNMAPPED)
    n = F.regexp_count("cigar", F.lit("[ID]"))
    per_mate = rows.groupBy("mate").agg(
        F.count(F.lit(1)).alias("reads"), F.count_if(aligned).alias("aligned"),
        F.sum(F.length("seq").cast("bigint")).alias("_len"),
        F.count_if(aligned & ~has_flag(flag, M.REVERSE)).alias("_fwd"),
        F.coalesce(F.sum(F.when(aligned, n).cast("bigint")), F.lit(0)).alias("_indels"))
    bases = base_rows(rows.filter(aligned), blocks, ["mate", "seq"])
    differ = F.substring("seq", F.col("i") + 1, F.lit(1)) != F.col("ref_base")
    per_base = bases.groupBy("mate").agg(F.count(F.lit(1)).alias("_bases"), F.count_if(differ).alias("_wrong"))
    small = per_mate.join(per_base, "mate", "left")
    name = F.when(F.grouping("mate") == 1, "pair").when(F.col("mate") == 1, "first").otherwise("second")
    sums = ["reads", "aligned", "_len", "_fwd", "_indels", "_bases", "_wrong"]
    rolled = small.rollup("mate").agg(*[F.sum(c).alias(c) for c in sums], name.alias("category"))
    return rolled.select(
        "category", "reads", "aligned",
        F.round(F.col("_wrong") / F.col("_bases"), 8).alias("mismatch_rate"),
        F.round(F.col("_indels") / F.col("_bases"), 8).alias("indel_rate"),
        F.round(F.col("_len") / F.col("reads"), 6).alias("mean_read_length"),
        F.round(F.col("_fwd") / F.col("aligned"), 6).alias("strand_balance"))


def _gc_marks(seq):
    """1 for every G or C, 0 for any other letter."""
    return F.translate(F.translate(seq, "GCgc", "1111"), "ATNatnRYKMSWBDHV", "0" * 16)


def _gc_percent(marks, width: int):
    """Share of ones among ``width`` marks, counted as bits of numbers of up to 60 digits."""
    ones = sum((F.bit_count(F.conv(F.substring(marks, at + 1, min(60, width - at)), 2, 10).cast("bigint"))
                for at in range(0, width, 60)), F.lit(0))
    return F.floor(ones * 100 / F.lit(width)).cast("int")


def gc_bias(df: DataFrame, blocks: DataFrame, width: int = 100, block: int = M.BLOCK) -> DataFrame:
    """Per GC percent: reference windows, reads starting there, normalized coverage, mean quality.

    A read counts in the window that begins where it starts, or for the reverse
    strand ends where it ends.
    """
    count = F.least(F.lit(block), F.length("seq") - (width - 1))
    windows = windows_of(blocks, _gc_marks(F.col("seq")), count, width, []) \
        .groupBy(_gc_percent(F.col("window"), width).alias("gc")).agg(F.count(F.lit(1)).alias("windows"))
    mapped = _primary(df).filter(~has_flag(F.col("flag"), M.UNMAPPED))
    at = F.when(has_flag(F.col("flag"), M.REVERSE), C.reference_end(F.col("pos"), F.col("cigar")) - (width - 1)) \
        .otherwise(F.col("pos"))
    starts = mapped.select(
        "contig_idx", at.cast("int").alias("pos"), F.lit(f"{width}M").alias("cigar"),
        F.aggregate("quals", F.lit(0), lambda a, q: a + q).alias("qsum"), F.size("quals").alias("len"))
    under = reference_pieces(starts.filter(F.col("pos") >= 1), blocks).filter(F.length("ref_seq") == width)
    reads = under.groupBy(_gc_percent(_gc_marks(F.col("ref_seq")), width).alias("gc")).agg(
        F.count(F.lit(1)).alias("read_starts"), F.sum(F.col("qsum").cast("bigint")).alias("qsum"),
        F.sum(F.col("len").cast("bigint")).alias("len"))
    table = windows.join(reads, "gc", "left").na.fill(0, ["read_starts"])
    whole = Window.partitionBy()  # at most 101 rows
    share = (F.col("read_starts") / F.col("windows")) / (F.sum("read_starts").over(whole) / F.sum("windows").over(whole))
    return table.select("gc", "windows", "read_starts", F.round(share, 6).alias("normalized_coverage"),
                        F.round(F.col("qsum") / F.col("len"), 6).alias("mean_quality"))


def gc_bias_summary(gc: DataFrame) -> DataFrame:
    """Totals and the share of reads missing from AT-rich and GC-rich windows."""
    whole = Window.partitionBy()  # at most 101 rows
    lost = F.greatest(F.col("windows") * 100 / F.sum("windows").over(whole)
                      - F.col("read_starts") * 100 / F.sum("read_starts").over(whole), F.lit(0.0))
    return gc.withColumn("lost", lost).agg(
        F.sum("windows").alias("windows"), F.sum("read_starts").alias("read_starts"),
        F.round(F.sum(F.when(F.col("gc") <= 50, F.col("lost")).otherwise(0.0)), 4).alias("at_dropout"),
        F.round(F.sum(F.when(F.col("gc") > 50, F.col("lost")).otherwise(0.0)), 4).alias("gc_dropout"))


def quality_by_cycle(df: DataFrame) -> DataFrame:
    """Mean quality per machine cycle; cycles of mate 2 follow those of mate 1."""
    rows = _primary(df).select("flag", "mate", F.size("quals").alias("len"), F.posexplode("quals").alias("i", "q"))
    cycle = F.abs(machine_cycle(F.col("flag"), F.col("mate"), F.col("i"), F.col("len")))
    small = rows.groupBy("mate", cycle.alias("c")).agg(
        F.sum(F.col("q").cast("bigint")).alias("s"), F.count(F.lit(1)).alias("bases"))
    whole = Window.partitionBy()  # two rows per cycle of a read
    first = F.coalesce(F.max(F.when(F.col("mate") == 1, F.col("c"))).over(whole), F.lit(0))
    return small.select(
        F.when(F.col("mate") == 2, F.col("c") + first).otherwise(F.col("c")).cast("int").alias("cycle"),
        "bases", F.round(F.col("s") / F.col("bases"), 6).alias("mean_quality"))


def quality_distribution(df: DataFrame) -> DataFrame:
    return _primary(df).select(F.explode("quals").alias("quality")).groupBy("quality") \
        .agg(F.count(F.lit(1)).alias("bases"))


def insert_size_histogram(df: DataFrame) -> DataFrame:
    """Pairs per orientation and size, from first-of-pair rows of pairs on one contig."""
    flag = F.col("flag")
    rows = _primary(df).filter(
        has_flag(flag, M.PAIRED) & has_flag(flag, M.FIRST) & ~has_flag(flag, M.UNMAPPED | M.MATE_UNMAPPED | M.DUPLICATE)
        & (F.col("contig") == F.col("mate_contig")) & (F.col("tlen") != 0))
    rev, mate_rev = has_flag(flag, M.REVERSE), has_flag(flag, M.MATE_REVERSE)
    facing = F.when(rev, F.col("tlen") < 0).otherwise(F.col("tlen") > 0)
    orientation = F.when(rev == mate_rev, "TANDEM").when(facing, "FR").otherwise("RF")
    return rows.groupBy(orientation.alias("orientation"), F.abs("tlen").alias("size")) \
        .agg(F.count(F.lit(1)).alias("pairs"))


def insert_size_metrics(df: DataFrame) -> DataFrame:
    """Exact median, absolute deviation, mean, deviation and extremes per orientation.

    Everything after the histogram works on its few counted rows.
    """
    sizes = insert_size_histogram(df)
    weight = F.col("pairs")
    mid = sizes.groupBy("orientation").agg(F.percentile("size", F.lit(0.5), weight).alias("median_size"))
    rows = sizes.join(mid, "orientation").withColumn("_off", F.abs(F.col("size") - F.col("median_size")))
    n = F.sum("pairs")
    sx, sxx = F.sum(F.col("size") * weight), F.sum(F.col("size").cast("bigint") * F.col("size") * weight)
    variance = (sxx - sx * sx / n) / (n - 1)
    return rows.groupBy("orientation", "median_size").agg(
        n.alias("pairs"), F.percentile("_off", F.lit(0.5), weight).alias("mad"),
        F.round(sx / n, 4).alias("mean_size"), F.round(F.sqrt(variance), 4).alias("sd_size"),
        F.min("size").alias("min_size"), F.max("size").alias("max_size"))


def library_complexity(pairs: DataFrame) -> DataFrame:
    """Sizes of the sets of pairs whose two reads have equal bases, over their whole length.

    ``unique_estimate`` repeats the estimated number of molecules on every row.
    """
    sets = pairs.filter(F.col("left_seq").isNotNull() & F.col("right_seq").isNotNull()) \
        .groupBy("left_seq", "right_seq").agg(F.count(F.lit(1)).alias("set_size"))
    hist = sets.groupBy("set_size").agg(F.count(F.lit(1)).alias("sets"))
    whole = Window.partitionBy()  # one row per distinct set size
    return hist.withColumn("unique_estimate", library_size(
        F.sum(F.col("set_size") * F.col("sets")).over(whole), F.sum("sets").over(whole)))


def depth_of_coverage(df: DataFrame, intervals: DataFrame, cap: int | None = None) -> DataFrame:
    """Depth at every interval position, zeros included; at most ``cap`` if one is given.

    The intervals, which are disjoint once merged, count as one more read each: the runs of equal depth then cover
    them whole, and are spread to positions without a join.
    """
    merged = merge_intervals(intervals)
    inside = overlap_join(match_ranges(df), merged).select(
        "contig_idx", F.greatest("start", "iv_start").alias("start"), F.least("end", "iv_end").alias("end"))
    runs = coverage_runs(inside.unionByName(merged.select("contig_idx", "start", "end")))
    depth = F.col("depth") - 1
    shown = depth if cap is None else F.least(depth, F.lit(cap))
    return runs.select("contig_idx", F.explode(F.sequence("start", "end")).alias("pos"), shown.alias("depth"))


def depth_summary(depth: DataFrame) -> DataFrame:
    """Mean depth and the share of positions at each coverage step."""
    n = F.count(F.lit(1))
    return depth.agg(n.alias("positions"), F.round(F.sum("depth") / n, 6).alias("mean_depth"),
                     *[F.round(F.count_if(F.col("depth") >= s) / n, 6).alias(f"share_at_{s}x") for s in COVERAGE_STEPS])
