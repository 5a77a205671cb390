"""The three end-to-end runs as compositions of operators.

Stages are lazy DataFrames. A table is stored where later stages read it several
times; everything else is planned together.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.scaling import stored
from ..operators import align, annotate, call, dedup, groom, metrics, pileup, prepare, realign, recalibrate, rescue


@dataclass
class RunOptions:
    """Parameters of a run; thresholds default to the values of the wired steps."""

    read_group: dict[str, str] = field(default_factory=lambda: {
        "id": "run", "sample": "sample", "library": "library", "platform": "ILLUMINA", "unit": "1"})
    trim_quality: int = 0
    seed_length: int = 16
    max_differences: int = 4
    max_gap: int = 10
    #: fragment size and spread within which a mate without a seed is sought beside its partner
    rescue: tuple[int, int] | None = None
    remove_duplicates: bool = False
    min_base_quality: int = 10
    depth_cap: int | None = None
    min_indel_fraction: float = 0.1
    confidence: float = 30
    skip: frozenset[str] = frozenset()


def align_pairs(left: DataFrame, right: DataFrame, contigs: DataFrame, blocks: DataFrame,
                options: RunOptions = RunOptions()) -> DataFrame:
    """Mates to cleaned, ordered alignments with a read group.

    ``left`` and ``right`` come from ``read_fastq`` (mates 1 and 2).
    """
    reads = left.unionByName(right).select("read_name", "mate", "seq", "quals")
    if options.trim_quality:
        reads = prepare.trim_reads(reads, options.trim_quality)
    hits = stored(align.align_reads(reads, blocks, options.seed_length, options.max_differences, options.max_gap), "hits")
    if options.rescue is not None:
        found = rescue.rescue_mates(reads, hits, blocks, *options.rescue, options.max_differences)
        hits = stored(hits.unionByName(found), "hits")
    rows = align.to_alignments(align.pair_alignments(hits), reads, contigs, align.select_single_end(hits))
    rows = groom.fix_mate_info(prepare.attach_read_group(rows, **options.read_group))
    return groom.groom(rows, contigs)


def refine(alignments: DataFrame, blocks: DataFrame, known_snps: DataFrame, known_indels: DataFrame | None,
           options: RunOptions = RunOptions()) -> DataFrame:
    """Duplicates, local realignment, mate repair and quality recalibration."""
    marked = stored(dedup.mark_duplicates(alignments, options.remove_duplicates), "marked")
    targets = stored(realign.realign_targets(marked, known_indels), "targets")
    moved = stored(groom.fix_mate_info(realign.realign_indels(marked, targets, blocks, known_indels)), "moved")
    table = recalibrate.bqsr_table(moved, known_snps, blocks)
    return groom.sort_by_coordinate(recalibrate.bqsr_apply(moved, table))


def call_variants(alignments: DataFrame, blocks: DataFrame, known_ids: DataFrame,
                  intervals: DataFrame | None = None, options: RunOptions = RunOptions()) -> dict[str, DataFrame]:
    """``snps`` (with ids and annotations), ``indels``, and ``caller_metrics``."""
    reads = pileup.restrict_to_intervals(alignments, intervals)
    pile = pileup.pileup(reads, blocks, options.min_base_quality)
    if options.depth_cap is not None:
        pile = pileup.downsample_coverage(pile, options.depth_cap)
    every = pileup.pileup(reads, blocks, 0)
    snps = stored(call.call_snps(pile, options.confidence, options.confidence), "snps")
    snps = annotate.annotate_known_ids(snps, known_ids)
    snps = annotate.ann_site_counts(annotate.ann_allele_balance(snps), every)
    return {"snps": snps,
            "indels": call.call_indels(reads, blocks, options.min_indel_fraction, options.confidence),
            "caller_metrics": annotate.caller_metrics(every, options.min_base_quality, options.confidence)}


def measure(alignments: DataFrame, contigs: DataFrame, blocks: DataFrame,
            baits: DataFrame | None = None, targets: DataFrame | None = None) -> dict[str, DataFrame]:
    """The metric tables; capture metrics only with baits and targets."""
    gc = metrics.gc_bias(alignments, blocks)
    tables = {
        "contig_read_counts": metrics.contig_read_counts(alignments, contigs),
        "alignment_summary": metrics.alignment_summary(alignments, blocks),
        "gc_bias": gc, "gc_bias_summary": metrics.gc_bias_summary(gc),
        "quality_by_cycle": metrics.quality_by_cycle(alignments),
        "quality_distribution": metrics.quality_distribution(alignments),
        "insert_size_metrics": metrics.insert_size_metrics(alignments),
        "insert_size_histogram": metrics.insert_size_histogram(alignments),
        "duplication_metrics": dedup.duplication_metrics(alignments),
    }
    if baits is not None and targets is not None:
        tables["hs_metrics"] = metrics.hs_metrics(alignments, baits, targets)
        tables["depth_of_coverage"] = metrics.depth_of_coverage(alignments, targets)
    return tables


def reads_to_variants(left: DataFrame, right: DataFrame, contigs: DataFrame, blocks: DataFrame, known_snps: DataFrame,
                      known_indels: DataFrame | None, known_ids: DataFrame, intervals: DataFrame | None = None,
                      options: RunOptions = RunOptions()) -> dict[str, DataFrame]:
    """Paired reads to variant calls."""
    aligned = align_pairs(left, right, contigs, blocks, options)
    final = stored(refine(aligned, blocks, known_snps, known_indels, options), "alignments")
    return {"alignments": final, **call_variants(final, blocks, known_ids, intervals, options)}


def alignments_to_variants(alignments: DataFrame, contigs: DataFrame, blocks: DataFrame, known_snps: DataFrame,
                           known_indels: DataFrame | None, known_ids: DataFrame, baits: DataFrame | None = None,
                           targets: DataFrame | None = None, options: RunOptions = RunOptions()) -> dict[str, DataFrame]:
    """Stored alignments to metrics and calls; ``skip`` names of ``refine``, ``measure``, ``call``."""
    result = {"alignments": alignments}
    if "refine" not in options.skip:
        result["alignments"] = stored(refine(alignments, blocks, known_snps, known_indels, options), "alignments")
    final = result["alignments"]
    if "measure" not in options.skip:
        result.update(measure(final, contigs, blocks, baits, targets))
    if "call" not in options.skip:
        result.update(call_variants(final, blocks, known_ids, targets, options))
    return result
