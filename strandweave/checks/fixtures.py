"""Reads, reference and known sites derived from the given tables.

Every document becomes a contig (each letter of the whole text, of any alphabet,
maps onto A, C, G, T by its code point) and every order a read pair on one of them.
Variants, sequencing errors, low-quality tails and copies are planted by
arithmetic, so the same rows can be derived in plain SQL (``fixture_sql``).
Contigs under ``MIN_CONTIG`` bases are too short to hold a fragment: they stay in
the reference, and the orders are dealt over the others, by a dense number.
A third of the reads is of a group without a library.
"""

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, scaling
from ..operators.reference import reference_blocks

MIN_CONTIG = 300
READ = 50
INSERTED = "TGC"
SNP_EVERY = 211

_stored: dict[tuple[str, str, str], str] = {}


def _as_bases(batches):
    """Contigs from the letters of the texts, a batch of documents at once."""
    for batch in batches:
        points, starts = arrays.code_points(batch["letters"])
        seq = arrays.texts(np.frombuffer(b"ACGT", np.uint8)[points % 4], starts)
        length = pa.array(np.diff(starts).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch["contig_idx"], batch["contig"], seq, length], ["contig_idx", "contig", "seq", "contig_len"])


def _sequenced(tmpl, fid, mate, contig_idx, pos0, a, carries, deletes, hap):
    """What the sequencer reads of a template, with errors and variants, and the qualities; every base of a batch at once."""
    letters, starts = arrays.ascii_letters(tmpl)
    fid, mate, contig_idx, pos0, a, carries, deletes, hap = (arrays.numbers(c)[:, None] for c in (fid, mate, contig_idx, pos0, a, carries, deletes, hap))
    i = np.arange(READ)[None, :]
    inside = i < np.diff(starts)[:, None]
    seen = np.zeros(inside.shape, np.uint8)
    seen[inside] = letters
    behind = (carries == 1) & (i >= a)
    place = pos0 + i + 1 + np.where(behind, np.where(deletes == 1, 3, -3), 0)
    inserted = behind & (deletes == 0) & (i < a + len(INSERTED))
    varies = ((place * 31 + contig_idx * 17) % SNP_EVERY == 0) & ((place % 2 == 0) | (hap == 1))
    wrong = (fid * 13 + mate * 5 + i * 7) % 101 == 0
    seq = np.where(wrong, arrays.chosen("ACGT", "CGTA")[seen], np.where(varies & ~inserted, arrays.chosen("ACGT", "GTAC")[seen], seen))
    late = np.where(mate == 1, i, READ - 1 - i) >= 46
    quals = np.where(late, 6 + np.fmod(fid, 5), 28 + np.fmod(fid + i, 12)).astype(np.int32)
    ends = np.arange(len(tmpl) + 1, dtype=np.int32) * READ
    return pa.StructArray.from_arrays([arrays.texts(seq[inside], starts), pa.ListArray.from_arrays(pa.array(ends), pa.array(quals.ravel()))], ["seq", "quals"])


class Fixture:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _store(self, name: str, build) -> DataFrame:
        """Written once per application, then scanned as any stored input would be."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _stored:
            path = scaling.scratch_path(self.spark, name)
            # a fixed count keeps every core busy even where the bytes are few
            parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")),
                        self.spark.sparkContext.defaultParallelism)
            with scaling.shuffles_removed(self.spark):
                build(parts).write.parquet(path)
            _stored[key] = path
        return self.spark.read.parquet(_stored[key])

    @cached_property
    def contigs(self) -> DataFrame:
        """contig_idx, contig, contig_len, seq"""
        return self._store("contigs", self._contigs)

    def _contigs(self, parts: int) -> DataFrame:
        letters = F.regexp_replace("text", r"[^\p{L}]+", "")
        rows = self.table("documents").repartitionByRange(parts, "doc_id").select(
            F.col("doc_id").cast("int").alias("contig_idx"), F.concat(F.lit("chr"), F.col("doc_id").cast("string")).alias("contig"), letters.alias("letters"))
        return rows.mapInArrow(_as_bases, "contig_idx int, contig string, seq string, contig_len int").filter("contig_len > 0")

    @cached_property
    def contig_lengths(self) -> DataFrame:
        return self.contigs.select("contig_idx", "contig", "contig_len")

    @cached_property
    def blocks(self) -> DataFrame:
        return reference_blocks(self.contigs)

    @cached_property
    def hosts(self) -> DataFrame:
        """Contigs long enough for fragments, with a dense number, capture start and indel anchor."""
        return self._store("hosts", self._hosts)

    def _hosts(self, parts: int) -> DataFrame:
        long = self.contigs.filter(F.col("contig_len") >= MIN_CONTIG)
        number = scaling.broadcast_if_small(scaling.dense_ordinal(long.select("contig_idx"), "contig_idx", name="host_no"))
        return (long.join(number, "contig_idx")
                .withColumn("w0", ((F.col("contig_idx") * 37) % (F.col("contig_len") - 290)).cast("int"))
                .withColumn("anchor", F.col("w0") + 40))

    def _fragments(self) -> DataFrame:
        n_hosts = self.hosts.count()
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("fid"),
            F.expr(f"(o_orderkey * 13 + o_custkey * 7) % {max(n_hosts, 1)}").alias("host_no"),
            F.expr("o_orderkey * 7919 + o_custkey * 31").alias("x"),
            F.expr("cast(150 + (o_custkey % 10) * 5 AS int)").alias("isize"))
        frag = orders.join(self.hosts, "host_no").withColumns({
            "fstart": F.expr("cast(CASE WHEN fid % 8 <> 0 THEN w0 + (x % 20) * 3 "
                             "ELSE x % (contig_len - 260) END AS int)"),
            "hap": F.expr("cast(fid % 2 AS int)"),
        })
        return frag.select(
            "fid", "contig_idx", "contig", "contig_len", "anchor", "fstart", "isize", "hap",
            F.expr("substr(seq, fstart + 1, isize + 3)").alias("win"))

    @cached_property
    def alignments(self) -> DataFrame:
        return self._store("alignments", self._alignments)

    def _alignments(self, parts: int) -> DataFrame:
        r = self._fragments().withColumn("mate", F.explode(F.array(F.lit(1), F.lit(2))))
        r = r.withColumn("pos0", F.expr(f"CASE WHEN mate = 1 THEN fstart ELSE fstart + isize - {READ} END"))
        r = r.repartitionByRange(parts, "contig_idx", "pos0", "fid")
        r = r.withColumns({"a": F.expr("anchor - pos0"), "off": F.expr("pos0 - fstart"),
                           "deletes": F.expr("contig_idx % 2 = 0")})
        r = r.withColumns({"carries": F.expr("hap = 1 AND a BETWEEN 8 AND 40"),
                           "gapped": F.expr("hap = 1 AND a BETWEEN 8 AND 30")})
        r = r.withColumn("tmpl", F.expr(f"""
            CASE WHEN carries AND deletes THEN concat(substr(win, off + 1, a), substr(win, off + a + 4, {READ} - a))
                 WHEN carries THEN concat(substr(win, off + 1, a), '{INSERTED}', substr(win, off + a + 1, {READ - 3} - a))
                 ELSE substr(win, off + 1, {READ}) END"""))
        r = r.withColumn("s", F.arrow_udf(_sequenced, "seq string, quals array<int>")("tmpl", "fid", "mate", "contig_idx", "pos0", "a", "carries", "deletes", "hap"))
        cigar = F.expr(f"""CASE WHEN gapped AND deletes THEN concat(a, 'M3D', {READ} - a, 'M')
                           WHEN gapped THEN concat(a, 'M3I', {READ - 3} - a, 'M') ELSE '{READ}M' END""")
        group = F.expr("cast(fid % 3 AS string)")
        return r.select(
            "fid", F.concat(F.lit("r"), F.col("fid").cast("string")).alias("read_name"), "mate",
            F.expr("CASE WHEN mate = 1 THEN 99 ELSE 147 END").alias("flag"),
            "contig_idx", "contig", F.expr("pos0 + 1").alias("pos"), F.lit(60).alias("mapq"),
            cigar.alias("cigar"), F.col("contig").alias("mate_contig"),
            F.expr(f"CASE WHEN mate = 1 THEN fstart + isize - {READ - 1} ELSE fstart + 1 END").alias("mate_pos"),
            F.expr("CASE WHEN mate = 1 THEN isize ELSE -isize END").alias("tlen"),
            "s.seq", "s.quals",
            F.struct(F.concat(F.lit("rg"), group).alias("id"), F.lit("s1").alias("sample"),
                     F.when(F.col("fid") % 3 < 2, F.concat(F.lit("lib"), group)).alias("library"),
                     F.lit("ILLUMINA").alias("platform"), F.lit("1").alias("unit")).alias("read_group"),
            F.expr("map('NM', 'i:0')").alias("tags")).sortWithinPartitions("contig_idx", "pos", "fid")

    @cached_property
    def dirty(self) -> DataFrame:
        """Alignments with some pushed past the contig end and some unmapped."""
        lens = self.contig_lengths.select("contig_idx", "contig_len")
        return self.alignments.join(lens, "contig_idx").withColumns({
            "pos": F.expr("cast(CASE WHEN fid % 97 = 0 THEN contig_len - 19 ELSE pos END AS int)"),
            "flag": F.expr("CASE WHEN fid % 50 = 0 THEN flag + 4 ELSE flag END"),
        }).drop("contig_len")

    @cached_property
    def reads(self) -> DataFrame:
        """What the sequencer would emit: mate 2 reads the other strand."""
        back = F.col("mate") == 2
        return self.alignments.select(
            "fid", "read_name", "mate",
            F.when(back, F.reverse(F.translate("seq", "ACGT", "TGCA"))).otherwise(F.col("seq")).alias("seq"),
            F.when(back, F.reverse("quals")).otherwise(F.col("quals")).alias("quals"))

    @cached_property
    def known_snps(self) -> DataFrame:
        """contig_idx, contig, pos, id, ref, alt"""
        pieces = self.blocks.select("contig_idx", "contig", "start", F.expr("substr(seq, 1, 1000)").alias("s"))
        bases = pieces.select("contig_idx", "contig",
                              F.posexplode(F.split("s", "")).alias("k", "ref"), "start") \
            .withColumn("pos", F.expr("start + k"))
        return (bases.filter(f"(pos * 31 + contig_idx * 17) % {SNP_EVERY} = 0")
                .select("contig_idx", "contig", "pos",
                        F.expr("concat('rs', cast(contig_idx * 1000000L + pos AS string))").alias("id"),
                        "ref", F.translate("ref", "ACGT", "GTAC").alias("alt")))

    @cached_property
    def known_indels(self) -> DataFrame:
        h = self.hosts
        return h.select(
            "contig_idx", "contig", F.col("anchor").alias("pos"), F.lit(".").alias("id"),
            F.expr("CASE WHEN contig_idx % 2 = 0 THEN substr(seq, anchor, 4) ELSE substr(seq, anchor, 1) END").alias("ref"),
            F.expr(f"CASE WHEN contig_idx % 2 = 0 THEN substr(seq, anchor, 1) ELSE concat(substr(seq, anchor, 1), '{INSERTED}') END").alias("alt"))

    def _ranges(self, kind: str, widen: int) -> DataFrame:
        parts = F.array(
            F.struct(F.expr("w0 + 41").alias("start"), F.expr("w0 + 160").alias("end"), F.lit("a").alias("part")),
            F.struct(F.expr("w0 + 181").alias("start"), F.expr("w0 + 280").alias("end"), F.lit("b").alias("part")))
        return self.hosts.select("contig_idx", "contig", F.explode(parts).alias("p")).select(
            "contig_idx", "contig",
            F.greatest(F.lit(1), F.col("p.start") - widen).cast("int").alias("start"),
            (F.col("p.end") + widen).cast("int").alias("end"),
            F.concat("contig", F.col("p.part")).alias("name"), F.lit(kind).alias("kind"))

    @cached_property
    def targets(self) -> DataFrame:
        return self._ranges("target", 0)

    @cached_property
    def baits(self) -> DataFrame:
        return self._ranges("bait", 10)

    @cached_property
    def long_indels(self) -> DataFrame:
        """Known alleles that delete 70 bases, on some contigs with seven others in their place."""
        h = self.hosts.filter("contig_idx % 3 < 2").withColumn("pos", F.expr("w0 + 90"))
        return h.select("contig_idx", "contig", "pos", F.lit(".").alias("id"), F.expr("substr(seq, pos, 71)").alias("ref"),
                        F.expr("concat(substr(seq, pos, 1), CASE WHEN contig_idx % 3 = 1 THEN 'GATTACA' ELSE '' END)").alias("alt"))

    @cached_property
    def misplaced(self) -> DataFrame:
        """The alignments, some with clipped ends, and reads of the long alleles that are laid out without a gap."""
        columns = ["read_name", "mate", "flag", "contig_idx", "contig", "pos", "cigar", "seq", "quals"]
        clipped = F.expr("fid % 7 = 0 AND cigar = '50M'")
        given = self.alignments.withColumns({
            "pos": F.when(clipped & (F.col("mate") == 2), F.col("pos") + 5).otherwise(F.col("pos")),
            "cigar": F.when(clipped, F.when(F.col("mate") == 2, "5S45M").otherwise("45M5S")).otherwise(F.col("cigar"))})
        h = self.hosts.filter("contig_idx % 3 < 2").withColumns({
            "spot": F.expr("w0 + 90"), "ins": F.expr("CASE WHEN contig_idx % 3 = 1 THEN 'GATTACA' ELSE '' END"),
            "k": F.explode(F.sequence(F.lit(0), F.lit(7)))})
        more = h.select(
            F.expr("concat('x', contig_idx, '_', k)").alias("read_name"), F.lit(1).alias("mate"), F.lit(0).alias("flag"), "contig_idx",
            "contig", F.expr("spot - 19 - k").alias("pos"), F.lit("50M").alias("cigar"),
            F.expr("concat(substr(seq, spot - 19 - k, 20 + k), ins, substr(seq, spot + 71, 30 - k - length(ins)))").alias("seq"),
            F.array_repeat(F.lit(30), 50).alias("quals"))
        return given.select(*columns).unionByName(more.select(*columns))
