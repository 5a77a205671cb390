"""Local realignment of reads around insertions and deletions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions.alleles import trimmed
from ..functions.bases import bind
from ..functions.intervals import BIN, coverage_runs, merge_many, overlap_join, semi_overlap
from ..functions.scaling import cut_lineage
from . import batches
from .call import indel_events
from .pileup import callable_reads, match_ranges, origin, pileup
from .reference import reference_pieces


def _known(known_indels: DataFrame) -> DataFrame:
    """VCF-style indels as ``contig_idx, pos`` (base before), ``gone`` bases and ``ins``; one allele may have both.

    Shared ends are trimmed first. Alleles as long as the reference are substitutions and no candidates.
    """
    sites = trimmed(known_indels).filter(F.length("ref") != F.length("alt"))
    same = (F.substring("ref", 1, 1) == F.substring("alt", 1, 1)).cast("int")
    return sites.select("contig_idx", (F.col("pos") - 1 + same).cast("int").alias("pos"), (F.length("ref") - same).alias("gone"),
                        F.substring("alt", same + 1, F.length("alt")).alias("ins")).filter("pos >= 1")


def _observed(df: DataFrame) -> DataFrame:
    """Distinct indels of the reads in the same form; summed before any shuffle."""
    events = indel_events(callable_reads(df))
    return events.groupBy("contig_idx", "pos", F.when(F.col("op") == "D", F.col("len")).otherwise(0).alias("gone"),
                          "ins").agg(F.count(F.lit(1)).alias("_n")).drop("_n")


def candidate_indels(df: DataFrame, known_indels: DataFrame | None) -> DataFrame:
    seen = _observed(df)
    if known_indels is None:
        return seen
    return seen.unionByName(_known(known_indels)).distinct()


def mismatch_clusters(df: DataFrame, blocks: DataFrame, window: int = 10, least: float = 8.0) -> DataFrame:
    """``contig_idx, start, end`` of places with two or more mismatching loci within ``window`` bases.

    The qualities of mismatching bases are summed per locus (no base becomes a row) and then over the window
    that ends at a locus; a place counts if that sum is at least ``least`` for each read over its last locus. The
    depth comes from runs of equal depth, not from bases. A window is inside a bin of the contig or reaches into the
    next one, which then has its first loci too.
    """
    of = origin(pileup(df, blocks, 0))
    loci = of.summed(["contig_idx"], batches.mismatch_sums(["contig_idx"], of.min_base_quality), ["m"])
    bin_of = lambda p: F.floor((p - 1) / F.lit(BIN)).cast("int")
    spread = F.array_distinct(F.array(bin_of(F.col("pos")), bin_of(F.col("pos") + (window - 1))))
    within = Window.partitionBy("contig_idx", "_bin").orderBy("pos").rangeBetween(1 - window, 0)
    seen = loci.withColumn("_bin", F.explode(spread)).select("*", F.sum("m").over(within).alias("total"), F.count("m").over(within).alias("loci"),
                                                             F.min("pos").over(within).alias("first"))
    seen = seen.filter((F.col("_bin") == bin_of(F.col("pos"))) & (F.col("loci") > 1)).withColumn("_to", F.col("pos"))
    depth = overlap_join(seen.drop("_bin"), coverage_runs(match_ranges(df)), "pos", "_to")
    return depth.filter(F.col("total") >= F.col("depth") * least).select("contig_idx", F.col("first").alias("start"), F.col("pos").alias("end"))


def realign_targets(df: DataFrame, known_indels: DataFrame | None, pad: int = 10, blocks: DataFrame | None = None) -> DataFrame:
    """Padded ranges around observed and known indels and, with ``blocks``, clusters of mismatches; overlapping ones merged."""
    spots = candidate_indels(df, known_indels)
    ranges = spots.select("contig_idx", F.col("pos").alias("start"), (F.col("pos") + F.greatest(F.col("gone"), F.lit(1))).alias("end"))
    if blocks is not None:
        ranges = ranges.unionByName(mismatch_clusters(df, blocks))
    return merge_many(ranges.select("contig_idx", F.greatest(F.col("start") - pad, F.lit(1)).alias("start"), (F.col("end") + pad).alias("end")))


def _cost(seq: Column, quals: Column, other: Column) -> Column:
    """Sum of the qualities where two equally long texts differ; NULL if lengths differ."""
    def total(t):
        wrong = F.zip_with(F.split(t["a"], ""), F.split(t["b"], ""), lambda x, y: x != y)
        return F.when(t["a"] == t["b"], 0).when(F.length(t["a"]) == F.length(t["b"]), F.aggregate(
            F.zip_with(wrong, t["q"], lambda w, q: F.when(w, q).otherwise(0)), F.lit(0), lambda acc, q: acc + q))
    return bind(F.struct(seq.alias("a"), other.alias("b"), quals.alias("q")), total)


def _projected(seq: Column, cigar: Column, under: Column) -> Column:
    """Reference bases lined up with the read; inserted bases repeat the read."""
    return F.array_join(F.transform(C.cigar_segments(cigar), lambda s:
        F.when(s["op"].isin(C.MATCH), F.substring(under, s["ref_off"] + 1, s["len"]))
        .when(s["op"] == "I", F.substring(seq, s["read_off"] + 1, s["len"])).otherwise("")), "")


def _joined_text() -> Column:
    """The pieces of a group, in order, as one text."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ref_from", "ref_seq"))), lambda p: p["ref_seq"]), "")


def _cores(df: DataFrame) -> DataFrame:
    """Callable reads without the clips at their ends, which are kept as ``lead`` and ``trail``."""
    lead = F.regexp_extract("cigar", r"^((?:\d+H)?(?:\d+S)?)", 1)
    trail = F.regexp_extract("cigar", r"((?:\d+S)?(?:\d+H)?)$", 1)
    soft = lambda c: F.coalesce(F.regexp_extract(c, r"(\d+)S", 1).try_cast("int"), F.lit(0))
    rows = callable_reads(df).filter(~F.col("cigar").rlike("[NP*]")).select(
        "read_name", "mate", "contig_idx", "pos", "cigar", "seq", "quals", lead.alias("lead"), trail.alias("trail"))
    rows = rows.withColumns({"_l": soft(F.col("lead")), "_n": F.length("seq") - soft(F.col("lead")) - soft(F.col("trail"))})
    rows = rows.filter("_n > 0").select(
        "read_name", "mate", "contig_idx", "pos", "lead", "trail",
        F.substring("cigar", F.length("lead") + 1, F.length("cigar") - F.length("lead") - F.length("trail")).alias("cigar"),
        F.substring("seq", F.col("_l") + 1, F.col("_n")).alias("seq"), F.slice("quals", F.col("_l") + 1, F.col("_n")).alias("quals"))
    return rows.withColumn("end", C.reference_end(F.col("pos"), F.col("cigar")))


def _judged(reads: DataFrame, blocks: DataFrame) -> DataFrame:
    """Reads with ``now``, the cost of their present alignment; the pieces of a long read are put together first."""
    pieces = reference_pieces(reads, blocks)
    whole = (F.col("ref_from") == F.col("pos")) & (F.col("ref_to") == F.col("end"))
    one = pieces.filter(whole).select(*reads.columns, F.col("ref_seq").alias("under"))
    key = ["read_name", "mate", "contig_idx", "pos", "cigar"]
    rest = pieces.filter(~whole)
    several = rest.groupBy(*key).agg(*[F.first(c).alias(c) for c in reads.columns if c not in key], _joined_text().alias("under"))
    rows = one.unionByName(several.select(*one.columns))
    now = _cost(F.col("seq"), F.col("quals"), _projected(F.col("seq"), F.col("cigar"), F.col("under")))
    return rows.select(*reads.columns, now.alias("now")).filter("now > 0")


def _haplotypes(spots: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """Candidates with ``left``, the ``width`` bases up to the spot, and ``right``, those after what is gone."""
    key = ["contig_idx", "iv_start", "spot", "gone", "ins"]
    first = F.greatest(F.col("spot") - (width - 1), F.lit(1))
    sides = F.array(F.struct(F.lit("left").alias("side"), first.alias("pos"), (F.col("spot") - first + 1).alias("n")),
                    F.struct(F.lit("right").alias("side"), (F.col("spot") + F.col("gone") + 1).alias("pos"), F.lit(width).alias("n")))
    rows = spots.select(*key, F.explode(sides).alias("s")).select(
        *key, "s.side", "s.pos", F.concat(F.col("s.n").cast("string"), F.lit("M")).alias("cigar"))
    texts = reference_pieces(rows, blocks).groupBy(*key, "side").agg(_joined_text().alias("t"))
    return texts.groupBy(*key).agg(*[F.max(F.when(F.col("side") == x, F.col("t"))).alias(x) for x in ("left", "right")]) \
        .filter("left IS NOT NULL AND right IS NOT NULL")


def realign_indels(df: DataFrame, targets: DataFrame, blocks: DataFrame, known_indels: DataFrame | None,
                   lod: float = 5.0) -> DataFrame:
    """Moves reads onto the indel that explains a target best.

    Every read over an end of a candidate (what it deletes, inserts, or both) is scored with its start kept and with
    its end kept; the score is the sum of mismatching qualities. Each candidate brings the bases on both sides of it,
    as many as the longest read spans, so indels of any length and reads over several blocks are compared. Per target
    the candidate with the largest total gain is taken if the gain reaches ``10 * lod``, and reads that gain from it
    get a new position and CIGAR; clips stay as they are at the ends. Reads with skips (``N``, ``P``) are left alone,
    as are reads that match the reference or hold none of the ends. Repair mate fields afterwards with ``fix_mate_info``.
    """
    ranges = targets.select("contig_idx", "start", "end")
    reads = _judged(semi_overlap(_cores(df), ranges, "pos", "end"), blocks)
    width = reads.agg(F.max(F.greatest(F.length("seq"), F.col("end") - F.col("pos") + 1))).first()[0]
    if width is None:
        return df
    spots = overlap_join(candidate_indels(df, known_indels).withColumn("pos2", F.col("pos")), ranges, "pos", "pos2").select(
        "contig_idx", "iv_start", F.col("pos").alias("spot"), "gone", "ins")
    # each end of a candidate meets the reads over it: the base before, with the start kept, the one after, with the end
    ends = F.explode(F.array(F.struct(F.lit(0).alias("kept"), F.col("spot").alias("start")),
                             F.struct(F.lit(1).alias("kept"), (F.col("spot") + F.col("gone") + 1).alias("start"))))
    points = _haplotypes(spots, blocks, width).withColumn("e", ends).select("*", "e.kept", "e.start", F.col("e.start").alias("end")).drop("e")
    points = points.withColumnRenamed("iv_start", "target")
    pairs = overlap_join(reads, points, "pos", "end")

    n, more = F.length("seq"), F.length("ins")
    head = F.when(F.col("kept") == 0, F.col("spot") - F.col("pos") + 1) \
        .otherwise(n - more - (F.col("end") - F.col("spot") - F.col("gone")))
    pairs = pairs.withColumn("head", head).withColumn("tail", n - F.col("head") - more).filter(
        (F.col("head") >= 1) & (F.col("tail") >= 1) & (F.col("head") <= F.length("left")) & (F.col("tail") <= F.length("right")))
    text = F.concat(F.substring("left", F.length("left") - F.col("head") + 1, F.col("head")), "ins",
                    F.substring("right", F.lit(1), F.col("tail")))
    part = lambda n, op: F.when(n > 0, F.concat(n.cast("string"), F.lit(op))).otherwise("")
    cigar = F.concat("lead", part(F.col("head"), "M"), part(F.col("gone"), "D"), part(more, "I"), part(F.col("tail"), "M"), "trail")
    spot = ["contig_idx", "target", "spot", "gone", "ins"]
    # generated, not projected: the filter stays above, and each pair is scored once
    gains = pairs.select("read_name", "mate", *spot, "kept", (F.col("spot") - F.col("head") + 1).cast("int").alias("new_pos"),
                         cigar.alias("new_cigar"), F.explode(F.array(F.col("now") - _cost(F.col("seq"), F.col("quals"), text))).alias("gain"))
    best = gains.filter("gain > 0").groupBy("read_name", "mate", *spot).agg(
        F.min(F.struct((-F.col("gain")).alias("g"), "kept", "new_pos", "new_cigar")).alias("b"))
    best = cut_lineage(best.select("read_name", "mate", *spot, (-F.col("b.g")).alias("gain"), "b.new_pos", "b.new_cigar"))
    totals = best.groupBy(*spot).agg(F.sum("gain").alias("total")).filter(F.col("total") >= lod * 10)
    chosen = totals.groupBy("contig_idx", "target").agg(
        F.min(F.struct((-F.col("total")).alias("t"), "spot", "gone", "ins")).alias("c")) \
        .select("contig_idx", "target", "c.spot", "c.gone", "c.ins")
    moves = best.join(chosen, spot).groupBy("read_name", "mate").agg(
        F.min(F.struct((-F.col("gain")).alias("g"), "new_pos", "new_cigar")).alias("m")) \
        .select("read_name", "mate", "m.new_pos", "m.new_cigar")
    return (df.join(moves, ["read_name", "mate"], "left")
            .withColumns({"pos": F.coalesce("new_pos", "pos"), "cigar": F.coalesce("new_cigar", "cigar")})
            .select(*df.columns))
