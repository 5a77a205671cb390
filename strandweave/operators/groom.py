"""Cleaning, ordering, merging and mate repair of alignments."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions import cigar as C
from ..functions.bases import has_flag
from ..functions.scaling import sort_rows


def _clip_past(cigar: Column, pos: Column, limit: Column) -> Column:
    """CIGAR with everything beyond ``limit`` on the reference soft-clipped."""
    segs = C.cigar_segments(cigar)

    def at(s):
        return pos + s["ref_off"]

    def kept(s):
        room = F.greatest(limit - at(s) + 1, F.lit(0))
        return F.when(s["op"].isin(C.MATCH), F.least(s["len"], room)) \
            .when(s["op"].isin("D", "N"), F.when(at(s) + s["len"] - 1 < limit, s["len"]).otherwise(0)) \
            .when(s["op"] == "I", F.when(at(s) <= limit, s["len"]).otherwise(0)) \
            .when((s["op"] == "S") & (s["read_off"] > 0), 0).otherwise(s["len"])

    def lost(s):
        return F.when(s["op"].isin(C.ON_READ), s["len"] - kept(s)).otherwise(0)

    clip = F.aggregate(segs, F.lit(0), lambda acc, s: acc + lost(s))
    tail = F.filter(segs, lambda s: (s["op"] == "H") & (s["read_off"] > 0))
    body = F.filter(segs, lambda s: (kept(s) > 0) & ~((s["op"] == "H") & (s["read_off"] > 0)))
    parts = F.concat(
        F.transform(body, lambda s: F.struct(kept(s).alias("len"), s["op"].alias("op"))),
        F.array(F.struct(clip.alias("len"), F.lit("S").alias("op"))),
        F.transform(tail, lambda s: F.struct(s["len"].alias("len"), s["op"].alias("op"))))
    return C.cigar_text(parts)


def clean_alignments(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Soft-clips what hangs over the contig end; unmapped reads get mapq 0.

    ``contigs`` (``contig_idx, contig_len``) is broadcast by the engine when its
    measured size allows.
    """
    unmapped = has_flag(F.col("flag"), M.UNMAPPED)
    over = ~unmapped & (C.reference_end(F.col("pos"), F.col("cigar")) > F.col("_len"))
    lens = contigs.select("contig_idx", F.col("contig_len").alias("_len"))
    rows = df.join(lens, "contig_idx", "left").withColumns({
        "cigar": F.when(over, _clip_past(F.col("cigar"), F.col("pos"), F.col("_len"))).otherwise(F.col("cigar")),
        "mapq": F.when(unmapped, 0).otherwise(F.col("mapq")),
    })
    return rows.select(*df.columns)


def coordinate_keys() -> list[Column]:
    """Contig order of the reference, then position; unmapped rows last."""
    return [F.when(has_flag(F.col("flag"), M.UNMAPPED) | F.col("contig_idx").isNull(), 1).otherwise(0),
            F.col("contig_idx").asc_nulls_last(), F.col("pos").asc_nulls_last(),
            F.col("read_name"), F.col("mate")]


def sort_by_coordinate(df: DataFrame) -> DataFrame:
    """Range-partitioned order; the read name in the key divides hot positions."""
    return sort_rows(df, *coordinate_keys())


def merge_alignments(*sets: DataFrame) -> DataFrame:
    """One ordered set from several; a single set passes through untouched."""
    if len(sets) == 1:
        return sets[0]
    return sort_by_coordinate(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sets))


def groom(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Clean, then order; writing the result with ``write_alignments`` indexes it."""
    return sort_by_coordinate(clean_alignments(df, contigs))


def fix_mate_info(df: DataFrame) -> DataFrame:
    """Copies the mate's place, strand and mapped state, and recomputes TLEN.

    Only five slim columns of the primary rows travel to the mate; rows without
    a primary mate are left as they are.
    """
    flag = F.col("flag")
    primary = ~has_flag(flag, M.NOT_PRIMARY)
    mates = df.filter(primary).select(
        "read_name", (F.lit(3) - F.col("mate")).cast("int").alias("mate"), flag.alias("m_flag"),
        F.col("contig_idx").alias("m_idx"), F.col("contig").alias("m_contig"), F.col("pos").alias("m_pos"),
        C.reference_end(F.col("pos"), F.col("cigar")).alias("m_end"))
    keep = flag.bitwiseAND(F.lit(~(M.MATE_UNMAPPED | M.MATE_REVERSE)))
    m_un, m_rev = has_flag(F.col("m_flag"), M.UNMAPPED), has_flag(F.col("m_flag"), M.REVERSE)
    new_flag = keep.bitwiseOR(F.when(m_un, M.MATE_UNMAPPED).otherwise(0)) \
        .bitwiseOR(F.when(m_rev, M.MATE_REVERSE).otherwise(0))
    end = C.reference_end(F.col("pos"), F.col("cigar"))
    five = F.when(has_flag(flag, M.REVERSE), end).otherwise(F.col("pos"))
    m_five = F.when(m_rev, F.col("m_end")).otherwise(F.col("m_pos"))
    both = ~has_flag(flag, M.UNMAPPED) & ~m_un & (F.col("contig_idx") == F.col("m_idx"))
    gap = m_five - five
    tlen = F.when(~both, 0).when(gap > 0, gap + 1).when(gap < 0, gap - 1) \
        .when(F.col("mate") == 1, 1).otherwise(-1)
    found = F.col("m_flag").isNotNull() & primary
    rows = df.join(mates, ["read_name", "mate"], "left").withColumns({
        "flag": F.when(found, new_flag).otherwise(flag).cast("int"),
        "mate_contig": F.when(found, F.col("m_contig")).otherwise(F.col("mate_contig")),
        "mate_pos": F.when(found, F.col("m_pos")).otherwise(F.col("mate_pos")).cast("int"),
        "tlen": F.when(found, tlen).otherwise(F.col("tlen")).cast("int"),
    })
    return rows.select(*df.columns)
