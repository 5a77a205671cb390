"""Placing a mate by its partner alone, where no seed of its own matches."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bases import bind, differences, reverse_complement
from .align import select_single_end
from .reference import reference_text

#: Bases in one packed word of two bits each.
WORD = 31
_LOW_BITS = 0x1555555555555555


def packed(text: Column, longest: int) -> Column:
    """Words of ``WORD`` bases, two bits each; letters other than A, C, G, T count as A."""
    digits = F.translate(F.regexp_replace(text, "[^ACGT]", "A"), "ACGT", "0123")
    pieces = [F.substring(digits, 1 + at, WORD) for at in range(0, longest, WORD)]
    return F.array(*[F.coalesce(F.conv(p, 4, 10).cast("bigint"), F.lit(0).cast("bigint")) for p in pieces])


def packed_differences(a: Column, b: Column) -> Column:
    """Bases in which two packed texts differ: two bits that are not alike leave a bit in their lower place."""
    def wrong(x, y):
        return bind(x.bitwiseXOR(y), lambda w: F.bit_count(w.bitwiseOR(F.shiftrightunsigned(w, 1)).bitwiseAND(F.lit(_LOW_BITS))))
    return F.aggregate(F.zip_with(a, b, wrong), F.lit(0), lambda t, n: t + n)


def rescue_mates(reads: DataFrame, hits: DataFrame, blocks: DataFrame, insert: int, spread: int, d: int = 4) -> DataFrame:
    """Placements, in the form of ``align_reads``, of reads without one whose mate has some.

    A mate is sought where its partner's best placement expects it: on the other strand, for fragments of ``insert``
    bases, ``spread`` more or less. The window of the reference comes by (contig, block); the mate is compared with
    every place in it, as packed words first, and base by base where at most ``d`` packed bases differ. Fewest
    differences win, then the fragment nearest to ``insert``, then the leftmost place. No seed is needed, so a
    difference in every seed does no harm. Mates of unplaced reads stay unplaced.
    """
    key = ["read_name", "mate"]
    best = select_single_end(hits).select(
        "read_name", (3 - F.col("mate")).alias("mate"), "contig_idx", F.col("pos").alias("_pos"), F.col("strand").alias("_strand"),
        F.aggregate(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MD]"), F.lit(1)), F.lit(0), lambda t, x: t + x.cast("int")).alias("_span"))
    lone = reads.select(*key, "seq").join(hits.select(*key).distinct(), key, "left_anti").join(best, key)
    lone = lone.filter(F.length("seq") > 0).withColumns({
        "strand": F.when(F.col("_strand") == "+", "-").otherwise("+"),
        "bases": F.when(F.col("_strand") == "+", reverse_complement(F.col("seq"))).otherwise(F.col("seq"))})
    n = F.length("bases")
    # where the mate would start in a fragment of exactly the expected size
    expected = F.when(F.col("_strand") == "+", F.col("_pos") + insert - n).otherwise(F.col("_pos") + F.col("_span") - insert)
    lone = lone.select(*key, "strand", "bases", "contig_idx", expected.cast("int").alias("expected"))
    longest = lone.agg(F.max(F.length("bases"))).first()[0]
    if longest is None:
        return hits.filter("false").select(*key, "strand", "contig_idx", "pos", "nm", "cigar", "n_loci")
    first = F.greatest(F.col("expected") - spread, F.lit(1))
    near = reference_text(lone, blocks, first, F.col("expected") + spread + n - 1, "window").filter(F.length("window") >= n)
    near = near.withColumn("_packed", packed(F.col("bases"), longest))
    places = near.withColumn("o", F.explode(F.sequence(F.lit(0), F.length("window") - n))).withColumn(
        "text", F.substring("window", F.col("o") + 1, n))
    alike = places.filter(packed_differences(F.col("_packed"), packed(F.col("text"), longest)) <= d)
    found = alike.select(*key, "strand", "contig_idx", (first + F.col("o")).cast("int").alias("pos"), "expected", n.alias("n"),
                         differences(F.col("bases"), F.col("text")).alias("nm")).filter(F.col("nm") <= d)
    one = found.groupBy(*key).agg(F.min(F.struct("nm", F.abs(F.col("pos") - F.col("expected")).alias("off"), "pos", "contig_idx", "strand", "n")).alias("b"))
    return one.select(*key, "b.strand", "b.contig_idx", "b.pos", "b.nm", F.concat(F.col("b.n").cast("string"), F.lit("M")).alias("cigar"),
                      F.lit(1).cast("bigint").alias("n_loci"))
