"""Aligned bases as rows, with the reference base, and what callers do to them."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions import cigar as C
from ..functions.bases import base_at, has_flag
from ..functions.intervals import BIN, semi_overlap
from ..functions.scaling import broadcast_if_small, cut_lineage, top_n_per_group
from . import batches
from .reference import reference_pieces


def callable_reads(df: DataFrame) -> DataFrame:
    return df.filter(~has_flag(F.col("flag"), M.NOT_CALLABLE))


def read_pieces(df: DataFrame, blocks: DataFrame, keep: list, kinds=("M", "=", "X")) -> DataFrame:
    """``keep`` and what lays out the bases of one operation of a read, over one piece of the reference (``ref_seq``).

    Base ``_k`` of ``_lo.._hi`` is at ``_p0 + _k`` on the contig, ``_r0 + _k`` (from 1) in ``ref_seq`` and
    ``_i0 + _k * _step`` in the read.
    """
    need = df.select(*keep, "contig_idx", "pos", "cigar")
    names = [c for c in need.columns if c not in ("pos", "cigar")]
    rows = reference_pieces(need, blocks)
    rows = rows.select(*names, "pos", "ref_from", "ref_to", "ref_seq",
                       F.explode(C.cigar_segments(F.col("cigar"))).alias("s")).filter(F.col("s.op").isin(list(kinds)))
    # whatever is the same for a whole operation is computed before its bases
    first = F.col("pos") + F.col("s.ref_off")
    rows = rows.select(*names, "ref_seq", F.col("s.op").alias("op"), F.col("s.read_off").alias("_i0"),
                       F.when(F.col("s.op") == "D", 0).otherwise(1).alias("_step"), first.alias("_p0"),
                       (first - F.col("ref_from") + 1).alias("_r0"),
                       F.greatest(F.col("ref_from") - first, F.lit(0)).alias("_lo"),
                       F.least(F.col("ref_to") - first, F.col("s.len") - 1).alias("_hi"))
    return rows.filter(F.col("_lo") <= F.col("_hi"))


def base_rows(df: DataFrame, blocks: DataFrame, keep: list, kinds=("M", "=", "X")) -> DataFrame:
    """``keep`` plus ``i`` (read offset), ``rpos``, ``op``, ``ref_base`` per aligned base.

    The reference arrives once per read; both explodes and everything after
    them run in the same stage, so callers can aggregate before any shuffle.
    """
    return _each_base(read_pieces(df, blocks, keep, kinds))


def _each_base(pieces: DataFrame) -> DataFrame:
    names = [c for c in pieces.columns if c not in ("ref_seq", "op") and not c.startswith("_")]
    rows = pieces.withColumn("_k", F.explode(F.sequence("_lo", "_hi")))
    return rows.select(*names, "op", (F.col("_i0") + F.col("_k") * F.col("_step")).alias("i"),
                       (F.col("_p0") + F.col("_k")).alias("rpos"),
                       F.substring("ref_seq", F.col("_r0") + F.col("_k"), F.lit(1)).alias("ref_base"))


class Origin(NamedTuple):
    """The reads a pileup is of: sums over its rows are taken from them, without making the rows."""
    pieces: DataFrame
    min_base_quality: int

    def summed(self, keys: list[str], sums: Callable, values: list[str], kinds: str = "", within: list[str] | None = None) -> DataFrame:
        """``sums`` (of ``batches``) over the reads, added up by ``keys``, ``pos`` and the columns of ``kinds``.

        The sums of a batch are dealt by the columns ``within``, if given, so that later sums by these need no other shuffle.
        """
        # the same columns whatever the sums, so that several sums share one shuffle of the reads
        names = dict.fromkeys(["contig_idx", "contig", *keys])
        rows = self.pieces.select(*names, "seq", "quals", "ref_seq", "_i0", "_step", "_p0", "_r0", "_lo", "_hi")
        types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        schema = ", ".join([*(f"`{c}` {types[c]}" for c in keys), "pos int", *([kinds] if kinds else []), *(f"{v} bigint" for v in values)])
        by = [*keys, "pos", *([kinds.split()[0]] if kinds else [])]
        rows = rows.mapInArrow(sums, schema)
        return (rows.repartition(*within) if within else rows).groupBy(*by).agg(*[F.sum(v).alias(v) for v in values])


def origin(pile: DataFrame) -> Origin | None:
    """Of a pileup as ``pileup`` returned it; None of one that was changed since, whose rows alone tell what is in it."""
    return vars(pile).get("_origin")


def pileup(df: DataFrame, blocks: DataFrame, min_base_quality: int = 10, more: tuple[str, ...] = ()) -> DataFrame:
    """One row per base of a callable read on a reference position, with the columns ``more`` of the read.

    ``base`` is ``*`` where the read deletes the position; such rows have no
    quality and pass the quality filter.
    """
    keep = ["contig", "read_name", "mate", "flag", "seq", "quals", *more]
    pieces = read_pieces(callable_reads(df), blocks, keep, ("M", "=", "X", "D"))
    gone = F.col("op") == "D"
    rows = _each_base(pieces).select(
        "contig_idx", "contig", F.col("rpos").alias("pos"), "ref_base", "read_name", "mate", *more,
        has_flag(F.col("flag"), M.REVERSE).alias("reverse"),
        F.when(gone, "*").otherwise(base_at(F.col("seq"), F.col("i"))).alias("base"),
        F.when(~gone, F.get("quals", F.col("i"))).alias("q"))
    rows = rows.filter(F.col("q").isNull() | (F.col("q") >= min_base_quality))
    rows._origin = Origin(pieces, min_base_quality)
    return rows


def site_counts(pile: DataFrame) -> DataFrame:
    """``contig_idx, pos`` with ``depth`` and ``gone``: rows and deletions per locus, summed where the bases are."""
    of = origin(pile)
    if of is None:
        return pile.groupBy("contig_idx", "pos").agg(F.count(F.lit(1)).alias("depth"), F.count_if(F.col("base") == "*").alias("gone"))
    held = vars(pile)
    if "_counts" not in held:  # one plan for all that count this pileup, so that Spark runs it once
        pile._counts = of.summed(["contig_idx"], batches.site_counts(["contig_idx"], of.min_base_quality), ["depth", "gone"])
    return held["_counts"]


def downsample_coverage(pile: DataFrame, n: int = 1000) -> DataFrame:
    """At most ``n`` bases per locus, those with the smallest digest of the read name.

    Loci are counted first. Where none is over ``n`` the pileup comes back as it
    is. Otherwise the reads of a pileup that was not changed are brought together
    by bins of the contig, without those that are not among the first ``n``
    anywhere near them, and ranked there: no row of a base is shuffled. Of other
    pileups only rows of the loci that are over are ranked, in two salted
    rounds. The choice is the same on every run.
    """
    over = site_counts(pile).filter(F.col("depth") > n).select("contig_idx", "pos")
    of = origin(pile)
    if of is not None:
        return pile if over.isEmpty() else _first_bases(pile, of, n)
    over = cut_lineage(over)
    if over.isEmpty():
        return pile
    over = broadcast_if_small(over)
    deep = pile.join(over, ["contig_idx", "pos"], "left_semi").withColumn("_d", F.md5("read_name"))
    kept = top_n_per_group(deep, ["contig_idx", "pos"], ["_d", "read_name", "mate"], n,
                           ["read_name", "mate"]).drop("_d")
    return pile.join(over, ["contig_idx", "pos"], "left_anti").unionByName(kept.select(*pile.columns))


def _first_bases(pile: DataFrame, of: Origin, n: int) -> DataFrame:
    layout = ["_i0", "_step", "_p0", "_r0", "_lo", "_hi"]
    made = ("pos", "ref_base", "base", "q")
    pieces = of.pieces.withColumns({"reverse": has_flag(F.col("flag"), M.REVERSE), "_d": F.md5("read_name")}).select(
        *[c for c in pile.columns if c not in made], "seq", "quals", "ref_seq", "_d", *layout)
    thin = pieces.mapInArrow(batches.thinned_pieces(n, of.min_base_quality), pieces.schema)
    bin_of = lambda k: F.floor((F.col("_p0") + F.col(k) - 1) / F.lit(BIN)).cast("int")
    parts = thin.withColumn("_bin", F.explode(F.sequence(bin_of("_lo"), bin_of("_hi")))).withColumns({
        "_lo": F.greatest(F.col("_lo"), F.col("_bin") * BIN + 1 - F.col("_p0")), "_hi": F.least(F.col("_hi"), (F.col("_bin") + 1) * BIN - F.col("_p0"))})
    parts = parts.repartition("contig_idx", "_bin").sortWithinPartitions("contig_idx", "_bin")
    rows = parts.mapInArrow(batches.first_bases(n, of.min_base_quality, pile.columns), pile.schema)
    return rows.select("contig_idx", "pos", *[c for c in pile.columns if c not in ("contig_idx", "pos")])


def restrict_to_intervals(df: DataFrame, intervals: DataFrame | None) -> DataFrame:
    """Alignments touching any interval, each once; no intervals means no restriction."""
    if intervals is None:
        return df
    rows = df.filter(~has_flag(F.col("flag"), M.UNMAPPED)) \
        .withColumn("_end", C.reference_end(F.col("pos"), F.col("cigar")))
    return semi_overlap(rows, intervals, "pos", "_end").drop("_end")


def match_ranges(df: DataFrame) -> DataFrame:
    """``contig_idx, start, end`` of every matching run of callable reads."""
    segs = callable_reads(df).select("contig_idx", "pos", F.explode(C.cigar_segments(F.col("cigar"))).alias("s"))
    return segs.filter(F.col("s.op").isin(C.MATCH)).select(
        "contig_idx", (F.col("pos") + F.col("s.ref_off")).alias("start"),
        (F.col("pos") + F.col("s.ref_off") + F.col("s.len") - 1).alias("end"))
