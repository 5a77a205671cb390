"""Genotype calls from summed per-base likelihood terms.

With ``k`` of ``ploidy`` copies carrying the other allele, the log10 likelihood
of a site is a sum of terms that depend only on a base's quality. The terms are
whole millionths from a constant table, so one aggregate with map-side merging
per locus holds everything, and the result does not depend on merge order.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions.bases import MICRO, copy_terms, lookup
from ..functions.intervals import overlap_join
from . import batches
from .normalize import left_normalized
from .pileup import callable_reads, origin
from .reference import reference_pieces

LETTERS = "ACGT"
SNP_THETA = 0.001
INDEL_THETA = 0.000125
INDEL_QUALITY = 45


def log_priors(ploidy: int, theta: float) -> list[float]:
    """log10 prior of 0..ploidy copies: ``theta / k``, the rest on none."""
    some = [theta / k for k in range(1, ploidy + 1)]
    return [math.log10(1 - sum(some))] + [math.log10(p) for p in some]


def _log_sum(values: Column) -> Column:
    return F.array_max(values) + F.log10(
        F.aggregate(values, F.lit(0.0), lambda acc, v: acc + F.pow(F.lit(10.0), v - F.array_max(values))))


def _log_total(values: list[Column]) -> Column:
    """``_log_sum`` of columns: plain arithmetic, which is compiled."""
    top = F.greatest(*values) if len(values) > 1 else values[0]
    return top + F.log10(sum((F.pow(F.lit(10.0), v - top) for v in values), F.lit(0.0)))


def with_genotype(rows: DataFrame, sums: list[Column], ploidy: int, theta: float) -> DataFrame:
    """Adds ``_g``, ``struct<qual, ref_qual, gt>``, from the likelihood sums (millionths) of each copy number."""
    names = [f"_p{k}" for k in range(ploidy + 1)]
    posterior = {n: s / F.lit(float(MICRO)) + F.lit(p) for n, s, p in zip(names, sums, log_priors(ploidy, theta))}
    none, *some = (F.col(n) for n in names)
    top = F.greatest(*some) if ploidy > 1 else some[0]
    text = F.lit(None).cast("string")
    for k in range(ploidy, 0, -1):  # the fewest copies of the most probable
        text = F.when(F.col(names[k]) == top, "/".join(["0"] * (ploidy - k) + ["1"] * k)).otherwise(text)
    found = F.struct(F.round((_log_total([none, *some]) - none) * 10, 2).alias("qual"),
                     F.round((none - _log_total(some)) * 10, 2).alias("ref_qual"), text.alias("gt"))
    # generated, not projected: filters on it then stay above, and it is computed once per locus
    return rows.withColumns(posterior).select("*", F.explode(F.array(found)).alias("_g")).drop(*names)


def locus_sums(pile: DataFrame, ploidy: int, min_base_quality: int = 10, every_locus: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Per locus: counts and likelihood sums of each letter, for each copy number.

    ``every_locus`` keeps loci without a base of sufficient quality, with zeros; ``by`` names further columns of the
    pileup to sum by. A pileup that was not changed is summed from its reads.
    """
    terms = copy_terms(ploidy)
    keys = ["contig_idx", "contig", *by]
    of = origin(pile)
    if of is not None:
        values = [x for b in LETTERS for x in [f"n_{b}", *(f"s{k}_{b}" for k in range(ploidy + 1))]]
        # all of a site in one place, where its sums by other columns meet next
        return of.summed(keys, batches.letter_sums(keys, terms, of.min_base_quality, min_base_quality, every_locus), values, "ref_base string",
                         ["contig_idx", "pos", "ref_base"] if by else None)
    keys += ["pos", "ref_base"]
    good = F.col("q") >= min_base_quality
    rows = pile if every_locus else pile.filter(good)
    rows = rows.select(*keys, F.when(good, F.col("base")).alias("base"),
                       *[lookup(terms[k], F.col("q")).alias(f"t{k}") for k in range(ploidy + 1)])
    aggs = []
    for b in LETTERS:
        hit = F.col("base") == b
        aggs.append(F.count(F.when(hit, 1)).alias(f"n_{b}"))
        aggs += [F.coalesce(F.sum(F.when(hit, F.col(f"t{k}"))), F.lit(0)).alias(f"s{k}_{b}")
                 for k in range(ploidy + 1)]
    return rows.groupBy(*keys).agg(*aggs)


def call_sites(pile: DataFrame, ploidy: int = 2, variable_only: bool = False) -> DataFrame:
    """Every locus with a base of sufficient quality: genotype, quality, confidence in the reference.

    ``alt`` is the most frequent other letter (ties by letter), or ``.``; only
    it and the reference letter count towards depth and likelihood.
    """
    return sites_from_sums(locus_sums(pile, ploidy), ploidy, variable_only)


def sites_from_sums(sums: DataFrame, ploidy: int = 2, variable_only: bool = False, keep_empty: bool = False) -> DataFrame:
    """Genotypes of ``locus_sums``; ``keep_empty`` keeps loci of depth 0."""
    sums = sums.filter(F.col("ref_base").isin(list(LETTERS)))
    total, zero = sum(F.col(f"n_{b}") for b in LETTERS), F.lit(0).cast("bigint")
    of = lambda letter, name: F.coalesce(*[F.when(letter == b, F.col(f"{name}_{b}")) for b in LETTERS], zero)
    seen = of(F.col("ref_base"), "n")
    rows = sums.withColumn("_seen", seen)
    if not keep_empty:
        rows = rows.filter(total > (F.col("_seen") if variable_only else 0))
    others = {b: F.when(F.col("ref_base") == b, zero).otherwise(F.col(f"n_{b}")) for b in LETTERS}
    rows = rows.withColumn("_ad", F.greatest(*others.values()))
    most = F.coalesce(*[F.when((F.col("_ad") > 0) & (others[b] == F.col("_ad")), b) for b in LETTERS])
    rows = rows.withColumn("_alt", most)
    both = [of(F.col("ref_base"), f"s{k}") + of(F.col("_alt"), f"s{ploidy - k}") for k in range(ploidy + 1)]
    rows, none = with_genotype(rows, both, ploidy, SNP_THETA), F.col("_alt").isNull()
    return rows.select(
        "contig_idx", "contig", "pos", F.col("ref_base").alias("ref"), F.coalesce("_alt", F.lit(".")).alias("alt"),
        F.when(none, F.lit(0.0)).otherwise(F.col("_g.qual")).alias("qual"), F.col("_g.ref_qual").alias("ref_qual"),
        F.when(none, "/".join(["0"] * ploidy)).otherwise(F.col("_g.gt")).alias("gt"),
        (F.col("_seen") + F.col("_ad")).alias("dp"), F.col("_ad").alias("ad"))


VARIANT = ["contig_idx", "contig", "pos", "ref", "alt", "qual", "gt", "dp", "ad"]


def call_snps(pile: DataFrame, call_conf: float = 30, emit_conf: float = 30, ploidy: int = 2) -> DataFrame:
    """Single-base variants at QUAL of at least both thresholds."""
    sites = call_sites(pile, ploidy, variable_only=True)
    return sites.filter(F.col("qual") >= max(call_conf, emit_conf)).select(*VARIANT)


def emit_mode(sites: DataFrame, mode: str, conf: float = 30) -> DataFrame:
    """``variants``, ``confident`` (variant or confidently reference) or ``all`` sites."""
    variant = F.col("qual") >= conf
    if mode == "variants":
        return sites.filter(variant)
    if mode == "confident":
        return sites.filter(variant | (F.col("ref_qual") >= conf))
    if mode == "all":
        return sites
    raise ValueError(f"unknown mode {mode!r}")


def indel_events(df: DataFrame) -> DataFrame:
    """Insertions and deletions per read: ``contig_idx, contig, pos`` (the base before), ``op, len, ins``.

    One before the first matched base is anchored on the reference base before it; there is none at a contig's start.
    """
    rows = df.filter(F.col("cigar").rlike("[ID]")).select(
        "contig_idx", "contig", "pos", "seq", F.explode(C.cigar_segments(F.col("cigar"))).alias("s"))
    rows = rows.filter(F.col("s.op").isin("I", "D") & (F.col("pos") + F.col("s.ref_off") > 1))
    inserted = F.when(F.col("s.op") == "I",
                      F.substring(F.col("seq"), F.col("s.read_off") + 1, F.col("s.len"))).otherwise("")
    return rows.select("contig_idx", "contig", (F.col("pos") + F.col("s.ref_off") - 1).alias("pos"),
                       F.col("s.op").alias("op"), F.col("s.len").alias("len"), inserted.alias("ins"))


def read_spans(reads: DataFrame) -> DataFrame:
    """``contig_idx, start, end``; one base more where a read begins or ends with an insertion, beside which it is anchored."""
    begins, ends = (F.col("cigar").rlike(p).cast("int") for p in (r"^(\d+[SH])*\d+I", r"\d+I(\d+[SH])*$"))
    return reads.select("contig_idx", (F.col("pos") - begins).alias("start"), (C.reference_end(F.col("pos"), F.col("cigar")) + ends).alias("end"))


def indel_alleles(events: DataFrame, blocks: DataFrame) -> DataFrame:
    """Counted events with VCF-style ``ref`` and ``alt``, equivalent ones as one.

    Events are summed before they meet the reference, so only candidate alleles
    are joined and moved left; a deletion over block borders is put together from its pieces.
    """
    keys = ["contig_idx", "contig", "pos", "op", "len", "ins"]
    given = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("ad"))
    counted = left_normalized(given, blocks).groupBy(*keys).agg(F.sum("ad").alias("ad"))
    span = F.concat(F.when(F.col("op") == "D", F.col("len") + 1).otherwise(1).cast("string"), F.lit("M"))
    pieces = reference_pieces(counted.withColumn("cigar", span), blocks)
    whole = pieces.groupBy(*keys, "ad").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("ref_from", "ref_seq"))), lambda p: p["ref_seq"]), "").alias("ref"))
    alt = F.when(F.col("op") == "D", F.substring("ref", 1, 1)).otherwise(F.concat("ref", "ins"))
    return whole.select("contig_idx", "contig", "pos", "ref", alt.alias("alt"), "ad")


def call_indels(df: DataFrame, blocks: DataFrame, min_fraction: float = 0.1,
                conf: float = 30, ploidy: int = 2) -> DataFrame:
    """Indels from CIGARs: the best supported allele of a site, if enough reads carry it.

    Depth counts reads that reach past the anchor base; reads are brought to the
    candidate sites, not the other way round.
    """
    reads = callable_reads(df)
    alleles = indel_alleles(indel_events(reads), blocks)
    best = (alleles.groupBy("contig_idx", "contig", "pos")
            .agg(F.min(F.struct((-F.col("ad")).alias("n"), "ref", "alt")).alias("b"))
            .select("contig_idx", "contig", "pos", F.col("b.ref").alias("ref"), F.col("b.alt").alias("alt"),
                    (-F.col("b.n")).alias("ad")))
    spans = read_spans(reads)
    sites = best.select("contig_idx", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))
    over = overlap_join(spans, sites).filter((F.col("start") <= F.col("iv_start")) & (F.col("end") >= F.col("iv_end")))
    depth = over.groupBy("contig_idx", F.col("iv_start").alias("pos")).agg(F.count(F.lit(1)).alias("dp"))
    # an allele that was moved left may begin before a read that carries it
    rows = best.join(depth, ["contig_idx", "pos"], "left").withColumn("dp", F.greatest(F.coalesce("dp", F.lit(0)), "ad"))
    rows = rows.filter(F.col("ad") >= F.col("dp") * min_fraction)
    terms = [t[INDEL_QUALITY] for t in copy_terms(ploidy)]
    likelihoods = [(F.col("dp") - F.col("ad")) * terms[k] + F.col("ad") * terms[ploidy - k] for k in range(ploidy + 1)]
    rows = with_genotype(rows, likelihoods, ploidy, INDEL_THETA).select(
        "contig_idx", "contig", "pos", "ref", "alt", "_g.qual", "_g.gt", "dp", "ad")
    return rows.filter(F.col("qual") >= conf)


def call_both(df: DataFrame, blocks: DataFrame, pile: DataFrame) -> DataFrame:
    """SNPs and indels as one ordered set."""
    both = call_snps(pile).unionByName(call_indels(df, blocks))
    keys = ["contig_idx", "pos", "ref", "alt"]
    return both.repartitionByRange(*keys).sortWithinPartitions(*keys)


def call_general_ploidy(data: DataFrame, ploidy: int, kind: str = "SNP", blocks: DataFrame | None = None) -> DataFrame:
    """The same model with ``ploidy + 1`` genotypes; ``data`` is a pileup (SNP) or alignments (INDEL)."""
    if kind == "SNP":
        return call_snps(data, ploidy=ploidy)
    if kind == "INDEL":
        return call_indels(data, blocks, ploidy=ploidy)
    raise ValueError(f"unknown kind {kind!r}")
