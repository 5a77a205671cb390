"""Every registered query with, where SQL can say it, the same result in SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model as M
from ..functions import cigar as C
from ..functions.bases import phred_string
from ..functions.scaling import dense_ordinal, scratch_path
from ..operators import align, annotate, call, chunk, dedup, groom, metrics, molecules, multiallelic, normalize, optical, pileup, prepare, realign, recalibrate, rescue, sites
from ..operators import reference as ref
from ..sources import readers, writers
from . import oracles as O
from .fixtures import Fixture

_queries: dict[str, Callable] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Fixture], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fixture(spark, sf_dir))
        run.__name__, run.__doc__ = name, fn.__doc__
        _queries[name] = run
        if sql is not None:
            _sql[name] = sql
        return fn
    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _qual(column="quals"):
    return phred_string(F.col(column)).alias("qual")


def _mate(fx: Fixture, mate: int) -> DataFrame:
    return fx.reads.filter(F.col("mate") == mate)


def _pile(fx: Fixture, q: int = 10) -> DataFrame:
    return pileup.pileup(fx.alignments, fx.blocks, q)


# --- sources and sinks -------------------------------------------------------

@query("read_fastq", O.READ_FASTQ)
def _read_fastq(fx):
    """Both mate files written in fragment order and read back in small byte ranges."""
    sets = []
    for mate in (1, 2):
        path = scratch_path(fx.spark, f"fastq{mate}")
        rows = _mate(fx, mate)
        ordered = rows.repartitionByRange("fid").sortWithinPartitions("fid")
        writers.fastq_lines(ordered).write.text(path)
        sets.append(readers.read_fastq(fx.spark, path, mate, split_bytes=1 << 20))
    return sets[0].unionByName(sets[1]).select("read_name", "mate", "seq", _qual(), "ordinal")


def _sam_header(fx: Fixture) -> DataFrame:
    """Header lines of the derived alignments: version, contigs in order, read groups."""
    sq = fx.contig_lengths.select(
        F.lit(1).alias("k"), F.col("contig_idx").alias("n"),
        F.concat(F.lit("@SQ\tSN:"), F.col("contig"), F.lit("\tLN:"), F.col("contig_len").cast("string")).alias("value"))
    rg = fx.alignments.select("read_group.*").distinct().select(
        F.lit(2).alias("k"), F.substring("id", 3, 9).cast("int").alias("n"),
        F.concat_ws("\t", F.lit("@RG"), F.concat(F.lit("ID:"), "id"), F.concat(F.lit("SM:"), "sample"),
                    F.concat(F.lit("LB:"), "library"), F.concat(F.lit("PL:"), "platform"),
                    F.concat(F.lit("PU:"), "unit")).alias("value"))
    hd = fx.spark.createDataFrame([(0, 0, "@HD\tVN:1.6\tSO:coordinate")], "k int, n int, value string")
    return hd.unionByName(sq).unionByName(rg)


def _sam_folder(fx: Fixture) -> str:
    """Two files with the same header, and the alignments, as a set of chunks is."""
    path = scratch_path(fx.spark, "sam")
    for _ in range(2):
        _sam_header(fx).coalesce(1).sortWithinPartitions("k", "n").select("value").write.mode("append").text(path)
    writers.sam_lines(fx.alignments).write.mode("append").text(path)
    return path


@query("read_sam", O.READ_SAM)
def _read_sam(fx):
    rows = readers.read_sam(fx.spark, _sam_folder(fx))
    return rows.select("read_name", "mate", "flag", "contig_idx", "contig", "pos", "mapq", "cigar", "mate_contig",
                       "mate_pos", "tlen", "seq", _qual(), F.col("read_group.library").alias("library"),
                       F.col("tags")["NM"].alias("nm"))


@query("read_sam_header", O.READ_SAM_HEADER)
def _read_sam_header(fx):
    header = readers.read_sam_header(fx.spark, _sam_folder(fx))
    size = readers.header_size(header).withColumn("record_type", F.lit("all"))
    rows = header.groupBy("record_type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("line") + 1).alias("bytes"),
        F.sum(F.try_element_at("tags", F.lit("LN")).cast("bigint")).alias("total_length"))
    return rows.unionByName(size, allowMissingColumns=True)


def _fasta(fx: Fixture) -> str:
    """Contigs in order, 60 bases per line, with text after the name."""
    path = scratch_path(fx.spark, "fasta")
    wrapped = F.regexp_replace("seq", "(.{60})(?=.)", "$1\n")
    rows = fx.contigs.repartitionByRange("contig_idx").sortWithinPartitions("contig_idx")
    rows.select(F.concat(F.lit(">"), "contig", F.lit(" derived\n"), F.lower(wrapped)).alias("value")).write.text(path)
    return path


@query("count_contigs", O.COUNT_CONTIGS)
def _count_contigs(fx):
    return ref.count_contigs(fx.spark.read.text(_fasta(fx)))


@query("read_reference", O.READ_REFERENCE)
def _read_reference(fx):
    contigs, blocks = readers.read_reference(fx.spark, _fasta(fx), split_bytes=1 << 20)
    return blocks.join(contigs.select("contig", "contig_len"), "contig").select(
        "contig_idx", "contig", "contig_len", "block", "start", F.md5("seq").alias("digest"))


@query("read_known_sites", O.READ_KNOWN_SITES)
def _read_known_sites(fx):
    """A written VCF with header lines, missing ids and two alternates in one row."""
    path = scratch_path(fx.spark, "vcf")
    sites = fx.known_snps
    head = fx.spark.createDataFrame([("##fileformat=VCFv4.2",), ("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",)], "value string")
    alt = F.concat_ws(",", "alt", F.when(F.col("pos") % 2 == 0, F.translate("ref", "ACGT", "CATG")))
    name = F.when(F.col("pos") % 3 == 0, ".").otherwise(F.col("id"))
    pad = F.when(F.col("pos") % 5 == 0, "GA").otherwise("")  # alleles with shared ends, which the reader trims
    alt = F.regexp_replace(alt, "([ACGT])", F.concat(F.lit("$1"), pad))
    body = sites.select(F.concat_ws("\t", "contig", F.col("pos").cast("string"), name, F.concat("ref", pad), alt,
                                    F.lit("."), F.lit("."), F.lit(".")).alias("value"))
    head.coalesce(1).write.text(path)
    body.write.mode("append").text(path)
    return readers.read_known_sites(fx.spark, path, fx.contig_lengths).select("contig_idx", "contig", "pos", "id", "ref", "alt")


@query("read_intervals", O.READ_INTERVALS)
def _read_intervals(fx):
    """Targets through BED and baits through an interval list."""
    bed = scratch_path(fx.spark, "targets") + ".bed"
    fx.targets.select(F.concat_ws("\t", "contig", (F.col("start") - 1).cast("string"),
                                  F.col("end").cast("string"), "name").alias("value")).write.text(bed)
    lst = scratch_path(fx.spark, "baits") + ".interval_list"
    fx.spark.createDataFrame([("@HD\tVN:1.6",)], "value string").write.text(lst)
    fx.baits.select(F.concat_ws("\t", "contig", F.col("start").cast("string"), F.col("end").cast("string"),
                                F.lit("+"), "name").alias("value")).write.mode("append").text(lst)
    return readers.read_intervals(fx.spark, bed, "target").unionByName(readers.read_intervals(fx.spark, lst, "bait"))


@query("write_alignments", O.WRITE_ALIGNMENTS)
def _write_alignments(fx):
    path = scratch_path(fx.spark, "aln")
    writers.write_alignments(fx.alignments, path)
    return writers.read_alignments(fx.spark, path).select(
        "read_name", "mate", "flag", "contig_idx", "pos", "ref_end", "mapq", "cigar", "mate_pos", "tlen", "seq", _qual())


@query("region_scan", O.REGION_SCAN)
def _region_scan(fx):
    """The first half of the longest contig."""
    path = scratch_path(fx.spark, "aln")
    writers.write_alignments(fx.alignments, path)
    top = fx.contig_lengths.agg(F.max(F.struct("contig_len", -F.col("contig_idx"))).alias("t")).first()["t"]
    return writers.region_scan(fx.spark, path, -top[1], 1, top[0] // 2).select(
        "read_name", "mate", "contig_idx", "pos", "cigar")


@query("write_variants", O.WRITE_VARIANTS)
def _write_variants(fx):
    """Annotated calls written as VCF text and read back with their annotations."""
    path, every = scratch_path(fx.spark, "calls"), _pile(fx, 0)
    calls = annotate.ann_allele_balance(call.call_snps(_pile(fx)))
    calls = annotate.ann_spanning_deletions(annotate.ann_depth(calls, every), every)
    writers.write_variants(calls, path, contigs=fx.contig_lengths)
    info = lambda key, kind: F.try_element_at("info", F.lit(key)).cast(kind)
    return readers.read_variants(fx.spark, f"{path}/vcf").select(
        "contig", "pos", "id", "ref", "alt", info("DP", "bigint").alias("depth"),
        info("ABHet", "double").alias("allele_balance"), info("Dels", "double").alias("spanning_deletions"))


@query("write_metrics", O.QUALITY_DISTRIBUTION)
def _write_metrics(fx):
    path = scratch_path(fx.spark, "tbl")
    writers.write_metrics(metrics.quality_distribution(fx.alignments), path)
    return fx.spark.read.option("sep", "\t").option("header", True).schema("quality int, bases bigint").csv(path)


# --- chunks and sequence -----------------------------------------------------

@query("chunk_reads", O.CHUNK_READS)
def _chunk_reads(fx):
    sets = [chunk.chunk_reads(_mate(fx, m).select("fid", "read_name", "mate"), 1000, ["fid"]) for m in (1, 2)]
    return sets[0].unionByName(sets[1]).select("read_name", "mate", "ordinal", "chunk")


@query("chunk_alignments", O.CHUNK_ALIGNMENTS)
def _chunk_alignments(fx):
    """Chunk sizes with the header repeated in each, and everything in one chunk for n = 0."""
    rows = fx.alignments.select("contig_idx", "pos", "read_name", "mate")
    parts = []
    for n in (7000, 0):
        cut = chunk.chunk_alignments(rows, n, ["contig_idx", "pos", "read_name", "mate"])
        head = chunk.header_per_chunk(_sam_header(fx).select("value"), cut).groupBy("chunk").agg(
            F.count(F.lit(1)).alias("header_lines"))
        body = cut.groupBy("chunk").agg(F.count(F.lit(1)).alias("alignments"),
                                        F.min(F.struct("contig_idx", "pos")).alias("first"))
        parts.append(body.join(head, "chunk").select(
            F.lit(n).alias("n"), "chunk", "alignments", "header_lines",
            F.col("first.contig_idx").alias("first_contig"), F.col("first.pos").alias("first_pos")))
    return parts[0].unionByName(parts[1])


@query("chunk_by_bytes", O.CHUNK_BY_BYTES)
def _chunk_by_bytes(fx):
    rows = fx.alignments.select("contig_idx", "pos", "read_name", "mate", F.concat_ws(
        "\t", "read_name", F.col("flag").cast("string"), "contig", F.col("pos").cast("string"), "cigar", "seq").alias("line"))
    return chunk.chunk_by_bytes(rows, 10, ["contig_idx", "pos", "read_name", "mate"]).select(
        "read_name", "mate", "offset", "chunk")


@query("write_no_clobber", O.CONTIG_LENGTHS)
def _write_no_clobber(fx):
    """The second write finds the output and leaves it."""
    path = scratch_path(fx.spark, "kept")
    writers.write_no_clobber(fx.contig_lengths, path)
    writers.write_no_clobber(fx.contig_lengths.withColumn("contig", F.lit("other")), path)
    return fx.spark.read.parquet(path)


@query("sequence_windows", O.SEQUENCE_WINDOWS)
def _sequence_windows(fx):
    return ref.sequence_windows(fx.contigs, 120, 20)


@query("find_subsequence", O.FIND_SUBSEQUENCE)
def _find_subsequence(fx):
    return ref.find_subsequence(fx.blocks, "GATTA")


@query("find_patterns", O.FIND_PATTERNS)
def _find_patterns(fx):
    """A piece of 8 to 47 bases of every contig that has so many, sought in all of them at once."""
    patterns = fx.contigs.select(F.col("contig_idx").alias("pattern_id"), F.expr("substr(seq, 1 + contig_idx % 50, 8 + contig_idx % 40)").alias("pattern"))
    patterns = patterns.filter(F.length("pattern") >= 8)
    return ref.find_patterns(fx.blocks, patterns)


@query("subsequence", O.SUBSEQUENCE)
def _subsequence(fx):
    return ref.subsequence(fx.contigs, 101, 80)


# --- reads and alignment -----------------------------------------------------

@query("pair_mates", O.PAIR_MATES)
def _pair_mates(fx):
    """Reads with a run of five equal bases were lost, so some fragments lack a mate."""
    left, right = (_mate(fx, m).filter(~F.col("seq").rlike("A{5}|C{5}|G{5}|T{5}")) for m in (1, 2))
    return prepare.pair_mates(left, right).select("read_name", "left_seq", "right_seq", "status")


@query("trim_reads", O.TRIM_READS)
def _trim_reads(fx):
    return prepare.trim_reads(fx.reads, 20).select("read_name", "mate", "seq", _qual())


@query("align_reads", O.ALIGN_READS)
def _align_reads(fx):
    """Every ungapped placement of every read."""
    return align.align_reads(fx.reads, fx.blocks, max_gap=0).select("read_name", "mate", "strand", "nm", "contig_idx", "pos")


@query("align_reads_gapped")
def _align_reads_gapped(fx):
    """With the one-gap retry for reads that no ungapped placement explains."""
    hits = align.align_reads(fx.reads, fx.blocks)
    return hits.filter(F.col("cigar").rlike("[ID]"))


@query("select_single_end", O.SELECT_SINGLE_END)
def _select_single_end(fx):
    return align.select_single_end(align.align_reads(fx.reads, fx.blocks, max_gap=0)).select(
        "read_name", "mate", "contig_idx", "pos", "strand", "nm", "n_best", "n_hits", "mapq")


def _decoys(fx: Fixture) -> DataFrame:
    """True placements plus two derived ones per read with other difference counts."""
    rows = fx.alignments.select("fid", "read_name", "mate", "contig_idx", "pos", "cigar",
                                F.when(F.col("mate") == 1, "+").otherwise("-").alias("strand"))
    other = F.when(F.col("strand") == "+", "-").otherwise("+")
    spots = F.array(
        F.struct(F.col("pos").alias("pos"), F.col("strand").alias("strand"), F.expr("cast((fid + mate) % 3 AS int)").alias("nm")),
        F.struct((F.col("pos") + 17).alias("pos"), F.col("strand").alias("strand"), F.expr("cast((fid * 7 + mate) % 3 AS int)").alias("nm")),
        F.struct((F.col("pos") + 23).alias("pos"), other.alias("strand"), F.expr("cast((fid * 5 + mate * 2) % 3 AS int)").alias("nm")))
    return rows.select("read_name", "mate", "contig_idx", "cigar", F.explode(spots).alias("s")) \
        .select("read_name", "mate", "contig_idx", "cigar", "s.*", F.lit(1).cast("bigint").alias("n_loci"))


@query("pair_alignments", O.PAIR_ALIGNMENTS)
def _pair_alignments(fx):
    return align.pair_alignments(_decoys(fx), median_insert=170).select(
        "read_name", "mate", "flag", "contig_idx", "pos", "nm", "mate_pos", "tlen")


@query("pair_alignments_of_hits", O.PAIR_ALIGNMENTS_OF_HITS)
def _pair_alignments_of_hits(fx):
    """Pairs among all placements that the aligner finds, repeats included."""
    return align.pair_alignments(align.align_reads(fx.reads, fx.blocks, max_gap=0), median_insert=170).select(
        "read_name", "mate", "flag", "contig_idx", "pos", "nm", "mate_pos", "tlen")


@query("rescue_mates", O.RESCUE_MATES)
def _rescue_mates(fx):
    """Second mates of every tenth fragment have a difference in each of their seeds, so that only their partners place them."""
    rows = fx.alignments.filter("cigar = '50M'")
    lost = F.expr("fid % 10 = 0 AND mate = 2")
    other = lambda at: F.translate(F.substring("seq", at, 1), "ACGT", "CGTA")
    changed = F.concat(F.substring("seq", 1, 9), other(10), F.substring("seq", 11, 15), other(26), F.substring("seq", 27, 15), other(42), F.substring("seq", 43, 8))
    hits = rows.filter(~lost).select("read_name", "mate", F.when(F.col("mate") == 1, "+").otherwise("-").alias("strand"), "contig_idx", "pos",
                                     F.lit(0).alias("nm"), "cigar", F.lit(1).cast("bigint").alias("n_loci"))
    reads = rows.select("read_name", "mate", F.when(F.col("mate") == 2, F.reverse(F.translate(F.when(lost, changed).otherwise(F.col("seq")), "ACGT", "TGCA")))
                        .otherwise(F.col("seq")).alias("seq"))
    return rescue.rescue_mates(reads, hits, fx.blocks, insert=170, spread=40, d=6)


@query("attach_read_group", O.ATTACH_READ_GROUP)
def _attach_read_group(fx):
    rows = prepare.attach_read_group(fx.alignments, "run7", "NA1", "libX", "ILLUMINA", "1")
    return rows.select("read_name", "mate", "read_group.*")


# --- grooming ----------------------------------------------------------------

@query("clean_alignments", O.CLEAN_ALIGNMENTS)
def _clean_alignments(fx):
    rows = groom.clean_alignments(fx.dirty, fx.contig_lengths)
    used = F.aggregate(C.cigar_ops(F.col("cigar")), F.lit(0),
                       lambda a, s: a + F.when(s["op"].isin(C.ON_READ), s["len"]).otherwise(0))
    return rows.select("read_name", "mate", "flag", "pos", "mapq",
                       C.reference_end(F.col("pos"), F.col("cigar")).alias("ref_end"), used.alias("read_bases"))


@query("sort_by_coordinate", O.SORT_BY_COORDINATE)
def _sort_by_coordinate(fx):
    rows = fx.dirty.select("read_name", "mate", "flag", "contig_idx", "pos")
    return dense_ordinal(rows, *groom.coordinate_keys(), name="place", start=1)


@query("merge_alignments", O.MERGE_ALIGNMENTS)
def _merge_alignments(fx):
    """The two mates as separate sets, the second without a mapq column."""
    rows = fx.alignments.select("read_name", "mate", "flag", "contig_idx", "pos", "mapq")
    return groom.merge_alignments(rows.filter("mate = 1"), rows.filter("mate = 2").drop("mapq"))


@query("groom", O.GROOM)
def _groom(fx):
    """Cleaned, ordered, written and read back by its stored ends."""
    path = scratch_path(fx.spark, "groomed")
    writers.write_alignments(groom.groom(fx.dirty, fx.contig_lengths), path)
    return writers.read_alignments(fx.spark, path).groupBy("contig_idx").agg(
        F.count(F.lit(1)).alias("rows"), F.min("pos").alias("first_pos"), F.max("ref_end").alias("last_end"),
        F.sum(F.col("mapq").cast("bigint")).alias("mapq_sum"))


@query("mark_duplicates", O.MARK_DUPLICATES)
def _mark_duplicates(fx):
    return dedup.mark_duplicates(fx.alignments).select("read_name", "mate", "flag")


@query("duplication_metrics", O.DUPLICATION_METRICS)
def _duplication_metrics(fx):
    return dedup.duplication_metrics(fx.alignments)


def _on_flow_cell(fx):
    """Places in the read names; a quarter of all fragments is one copy group on a contig of its own."""
    hot = F.expr("fid % 4 = 0")
    place = F.expr("concat('m:1:f:1:', 1101 + fid % 5 % 2, ':', fid * 7919 % 4001, ':', fid * 104729 % 4003, '#r', fid)")
    return fx.alignments.withColumns({
        "read_name": place, "contig_idx": F.when(hot, -1).otherwise(F.col("contig_idx")),
        "pos": F.when(hot, F.when(F.col("mate") == 1, 1).otherwise(101)).otherwise(F.col("pos")),
        "cigar": F.when(hot, "50M").otherwise(F.col("cigar"))})


@query("optical_duplicates", O.OPTICAL_DUPLICATES)
def _optical_duplicates(fx):
    return optical.optical_duplicates(_on_flow_cell(fx))


@query("optical_metrics", O.OPTICAL_METRICS)
def _optical_metrics(fx):
    return optical.optical_metrics(_on_flow_cell(fx)).select("library", "pairs", "pair_duplicates", "optical_pair_duplicates", "estimated_library_size")


@query("remove_duplicates", O.REMOVE_DUPLICATES)
def _remove_duplicates(fx):
    return dedup.remove_duplicates(fx.alignments).select("read_name", "mate", "contig_idx", "pos")


@query("fix_mate_info", O.FIX_MATE_INFO)
def _fix_mate_info(fx):
    return groom.fix_mate_info(fx.dirty).select("read_name", "mate", "flag", "mate_contig", "mate_pos", "tlen")


# --- realignment and recalibration -------------------------------------------

@query("realign_targets", O.REALIGN_TARGETS)
def _realign_targets(fx):
    return realign.realign_targets(fx.alignments, fx.known_indels)


@query("realign_targets_clusters", O.REALIGN_TARGETS_CLUSTERS)
def _realign_targets_clusters(fx):
    """Clusters of mismatches beside the indels: reads that carry one without a gap show it that way."""
    return realign.realign_targets(fx.alignments, fx.known_indels, blocks=fx.blocks)


@query("realign_indels", O.REALIGN_INDELS)
def _realign_indels(fx):
    """Clipped reads, and alleles longer than a read or with other bases in place of the deleted ones, among the rest."""
    reads, known = fx.misplaced, fx.known_indels.unionByName(fx.long_indels)
    targets = realign.realign_targets(reads, known)
    return realign.realign_indels(reads, targets, fx.blocks, known).select("read_name", "mate", "contig_idx", "pos", "cigar")


@query("bqsr_table", O.BQSR_TABLE)
def _bqsr_table(fx):
    return recalibrate.bqsr_table(fx.alignments, fx.known_snps, fx.blocks)


@query("bqsr_apply", O.BQSR_APPLY)
def _bqsr_apply(fx):
    table = recalibrate.bqsr_table(fx.alignments, fx.known_snps, fx.blocks)
    return recalibrate.bqsr_apply(fx.alignments, table).select("read_name", "mate", _qual())


@query("bqsr_post_table", O.BQSR_POST_TABLE)
def _bqsr_post_table(fx):
    return recalibrate.bqsr_post_table(fx.alignments, fx.known_snps, fx.blocks)


# --- calling -----------------------------------------------------------------

@query("pileup", O.PILEUP)
def _pileup(fx):
    """The pileup counted per locus and letter."""
    return _pile(fx).groupBy("contig_idx", "pos", "ref_base", "base").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("q").cast("bigint")).alias("q_sum"))


@query("downsample_coverage", O.DOWNSAMPLE_COVERAGE)
def _downsample_coverage(fx):
    """A cap of five, so that it binds at this depth; kept names as one digest sum per locus."""
    kept = pileup.downsample_coverage(_pile(fx), 5)
    return kept.groupBy("contig_idx", "pos").agg(
        F.count(F.lit(1)).alias("n"), F.min("read_name").alias("first_name"), F.max("read_name").alias("last_name"),
        F.sum(F.substring("read_name", 2, 12).cast("bigint")).alias("name_sum"))


@query("restrict_to_intervals", O.RESTRICT_TO_INTERVALS)
def _restrict_to_intervals(fx):
    return pileup.restrict_to_intervals(fx.alignments, fx.targets).select("read_name", "mate", "contig_idx", "pos", "cigar")


@query("call_snps", O.CALL_SNPS)
def _call_snps(fx):
    return call.call_snps(_pile(fx))


@query("call_indels", O.CALL_INDELS)
def _call_indels(fx):
    return call.call_indels(fx.alignments, fx.blocks)


@query("left_normalize_indels", O.LEFT_NORMALIZE_INDELS)
def _left_normalize_indels(fx):
    """Deletions and insertions at every 97th base, the inserted bases those of the reference behind them."""
    at = fx.contigs.filter("contig_len >= 110").withColumn("pos", F.explode(F.expr("sequence(97, contig_len - 8, 97)")))
    ins = F.expr("substr(seq, pos + 1, 1 + pos % 4)")
    columns = ["contig_idx", "contig", "pos"]
    events = at.select(*columns, F.lit("D").alias("op"), F.expr("1 + pos % 3").alias("len"), F.lit("").alias("ins")).unionByName(
        at.select(*columns, F.lit("I").alias("op"), F.length(ins).alias("len"), ins.alias("ins")))
    moved = normalize.left_normalized(events, fx.blocks, window=8)
    return moved.groupBy(*moved.columns).agg(F.count(F.lit(1)).alias("events"))


@query("call_snp_alleles", O.CALL_SNP_ALLELES)
def _call_snp_alleles(fx):
    """The pileup with a second other letter in half of the reads at the planted sites."""
    pile = _pile(fx)
    planted = F.expr("(pos * 31 + contig_idx * 17) % 211 = 0 AND base <> '*' AND cast(substr(read_name, 2, 12) AS bigint) % 4 < 2")
    return multiallelic.call_snp_alleles(pile.withColumn("base", F.when(planted, F.translate("ref_base", "ACGT", "CGTA")).otherwise(F.col("base"))))


@query("call_indel_alleles", O.CALL_INDEL_ALLELES)
def _call_indel_alleles(fx):
    """The alignments with another length of the indel in half of the reads that have it."""
    other = F.expr("fid % 4 = 1 AND cigar <> '50M'")
    cigar = F.regexp_replace(F.col("cigar"), "3D", "4D")
    tail = F.expr("cast(regexp_extract(cigar, '([0-9]+)M$', 1) AS int) + 1")
    cigar = F.when(F.col("cigar").contains("3I"), F.concat(F.regexp_extract("cigar", "^([0-9]+M)", 1), F.lit("2I"), tail.cast("string"), F.lit("M"))).otherwise(cigar)
    rows = fx.alignments.withColumn("cigar", F.when(other, cigar).otherwise(F.col("cigar")))
    return multiallelic.call_indel_alleles(rows, fx.blocks)


@query("call_both", O.CALL_BOTH)
def _call_both(fx):
    return call.call_both(fx.alignments, fx.blocks, _pile(fx))


@query("emit_mode", O.EMIT_MODE)
def _emit_mode(fx):
    return call.emit_mode(call.call_sites(_pile(fx)), "confident")


@query("reference_runs", O.REFERENCE_RUNS)
def _reference_runs(fx):
    return sites.reference_runs(call.call_sites(_pile(fx)), fx.contig_lengths)


@query("call_joint", O.CALL_JOINT)
def _call_joint(fx):
    """The reads dealt to four samples by their fragments."""
    rows = fx.alignments.withColumn("sample", F.concat(F.lit("s"), (F.col("fid") % 4).cast("string")))
    return sites.call_joint(pileup.pileup(rows, fx.blocks, 10, more=("sample",)))


@query("call_general_ploidy", O.CALL_GENERAL_PLOIDY)
def _call_general_ploidy(fx):
    snps = call.call_general_ploidy(_pile(fx), 4, "SNP")
    return snps.unionByName(call.call_general_ploidy(fx.alignments, 4, "INDEL", fx.blocks))


@query("annotate_known_ids", O.ANNOTATE_KNOWN_IDS)
def _annotate_known_ids(fx):
    return annotate.annotate_known_ids(call.call_snps(_pile(fx)), fx.known_snps)


@query("ann_allele_balance", O.ANN_ALLELE_BALANCE)
def _ann_allele_balance(fx):
    return annotate.ann_allele_balance(call.call_snps(_pile(fx)))


@query("ann_depth", O.ANN_DEPTH)
def _ann_depth(fx):
    return annotate.ann_depth(call.call_snps(_pile(fx)), _pile(fx, 0)).select("contig_idx", "pos", "ref", "alt", "depth")


@query("ann_spanning_deletions", O.ANN_SPANNING_DELETIONS)
def _ann_spanning_deletions(fx):
    return annotate.ann_spanning_deletions(call.call_snps(_pile(fx)), _pile(fx, 0)) \
        .select("contig_idx", "pos", "ref", "alt", "spanning_deletions")


@query("caller_metrics", O.CALLER_METRICS)
def _caller_metrics(fx):
    return annotate.caller_metrics(_pile(fx, 0))


# --- metrics -----------------------------------------------------------------

@query("contig_read_counts", O.CONTIG_READ_COUNTS)
def _contig_read_counts(fx):
    return metrics.contig_read_counts(fx.dirty, fx.contig_lengths)


@query("hs_metrics", O.HS_METRICS)
def _hs_metrics(fx):
    total = fx.contig_lengths.agg(F.sum(F.col("contig_len").cast("bigint"))).first()[0]
    return metrics.hs_metrics(fx.alignments, fx.baits, fx.targets, total)


@query("alignment_summary", O.ALIGNMENT_SUMMARY)
def _alignment_summary(fx):
    return metrics.alignment_summary(fx.alignments, fx.blocks)


@query("gc_bias", O.GC_BIAS)
def _gc_bias(fx):
    return metrics.gc_bias(fx.alignments, fx.blocks)


@query("gc_bias_summary", O.GC_BIAS_SUMMARY)
def _gc_bias_summary(fx):
    return metrics.gc_bias_summary(metrics.gc_bias(fx.alignments, fx.blocks))


@query("quality_by_cycle", O.QUALITY_BY_CYCLE)
def _quality_by_cycle(fx):
    return metrics.quality_by_cycle(fx.alignments)


@query("quality_distribution", O.QUALITY_DISTRIBUTION)
def _quality_distribution(fx):
    return metrics.quality_distribution(fx.alignments)


@query("insert_size_metrics", O.INSERT_SIZE_METRICS)
def _insert_size_metrics(fx):
    return metrics.insert_size_metrics(fx.alignments)


@query("insert_size_histogram", O.INSERT_SIZE_HISTOGRAM)
def _insert_size_histogram(fx):
    return metrics.insert_size_histogram(fx.alignments)


@query("library_complexity", O.LIBRARY_COMPLEXITY)
def _library_complexity(fx):
    return metrics.library_complexity(prepare.pair_mates(_mate(fx, 1), _mate(fx, 2)))


@query("molecule_complexity", O.MOLECULE_COMPLEXITY)
def _molecule_complexity(fx):
    """A quarter of all pairs is of one molecule, each with an error of its own; a twelfth has a second one in the other read."""
    hit = F.expr("concat(substr(molecule, 1, fid % 50), substr('ACGT', fid div 50 % 4 + 1, 1), substr(molecule, fid % 50 + 2))")
    both = F.expr("concat(substr(molecule, 1, fid * 7 % 50), 'T', substr(molecule, fid * 7 % 50 + 2))")
    rows = fx.reads.withColumn("molecule", F.when(F.col("mate") == 1, "ACGTA" * 10).otherwise("GATTC" * 10))
    seq = F.when(F.expr("fid % 4 > 0"), F.col("seq")).when(F.col("mate") == 1, hit).when(F.expr("fid % 12 = 0"), both).otherwise(F.col("molecule"))
    rows = rows.withColumn("seq", seq).drop("molecule")
    return molecules.molecule_complexity(prepare.pair_mates(rows.filter("mate = 1"), rows.filter("mate = 2")))


@query("depth_of_coverage", O.DEPTH_OF_COVERAGE)
def _depth_of_coverage(fx):
    return metrics.depth_of_coverage(fx.alignments, fx.targets)


@query("depth_of_coverage_summary", O.DEPTH_SUMMARY)
def _depth_of_coverage_summary(fx):
    return metrics.depth_summary(metrics.depth_of_coverage(fx.alignments, fx.targets))
