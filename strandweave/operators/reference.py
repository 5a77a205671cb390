"""Reference sequence as overlapping blocks, and the one join that uses them.

A read meets the reference through (contig, block). Blocks repeat the first
bases of the next one, so a read no longer than the overlap needs only the
block it starts in; a longer one is divided into pieces along block borders.
Known sites can be masked inside the blocks beforehand, which saves a join at
base level later.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions.scaling import stored
from ..functions.words import WordFilter, windows_with_words
from ..model import BLOCK, OVERLAP


def block_of(pos: Column, block: int = BLOCK) -> Column:
    return F.floor((pos - 1) / F.lit(block)).cast("int")


def reference_blocks(contigs: DataFrame, block: int = BLOCK, overlap: int = OVERLAP) -> DataFrame:
    """``contig_idx, contig, block, start, seq`` from whole contig sequences."""
    last = block_of(F.length("seq"), block)
    return (contigs.filter(F.length("seq") > 0)
            .select("contig_idx", "contig", "seq", F.explode(F.sequence(F.lit(0), last)).alias("block"))
            .select("contig_idx", "contig", "block",
                    (F.col("block") * block + 1).alias("start"),
                    F.substring("seq", F.col("block") * block + 1, F.lit(block + overlap)).alias("seq")))


def mask_blocks(blocks: DataFrame, sites: DataFrame, block: int = BLOCK, overlap: int = OVERLAP) -> DataFrame:
    """Blocks with every known site (``contig_idx, pos``) replaced by ``N``.

    The per-block position list is bounded by the block length.
    """
    first = F.greatest(block_of(F.col("pos") - overlap, block), F.lit(0))
    spots = (sites.select("contig_idx", "pos")
             .withColumn("block", F.explode(F.sequence(first, block_of(F.col("pos"), block))))
             .groupBy("contig_idx", "block")
             .agg(F.sort_array(F.collect_set("pos")).alias("_at")))
    start = F.struct(F.lit(0).alias("done"), F.lit("").alias("text"))

    def put(acc, p):
        k = p - F.col("start")
        return F.struct((k + 1).alias("done"), F.concat(
            acc["text"], F.substring(F.col("seq"), acc["done"] + 1, k - acc["done"]), F.lit("N")).alias("text"))

    def finish(acc):
        return F.concat(acc["text"], F.substring(F.col("seq"), acc["done"] + 1, F.length("seq")))

    inside = F.filter("_at", lambda p: p < F.col("start") + F.length("seq"))
    masked = F.when(F.col("_at").isNull(), F.col("seq")).otherwise(F.aggregate(inside, start, put, finish))
    return (blocks.join(spots, ["contig_idx", "block"], "left")
            .withColumn("seq", masked).drop("_at"))


def reference_pieces(df: DataFrame, blocks: DataFrame, block: int = BLOCK, overlap: int = OVERLAP) -> DataFrame:
    """Adds ``ref_from, ref_to, ref_seq``: the reference under each read.

    One row per read whose span fits the overlap; a longer read gives one row
    per block, each owning ``ref_from..ref_to``.
    """
    end = C.reference_end(F.col("pos"), F.col("cigar"))
    rows = df.withColumn("_end", end)
    here, there = block_of(F.col("pos"), block), block_of(F.col("_end"), block)
    fits = F.col("_end") - F.col("pos") < overlap
    rows = rows.withColumn("block", F.explode(
        F.when(fits, F.array(here)).otherwise(F.sequence(here, there))))
    side = blocks.select("contig_idx", "block", F.col("start").alias("_start"), F.col("seq").alias("_seq"))
    lo = F.greatest(F.col("pos"), F.col("_start"))
    hi = F.when(fits, F.col("_end")).otherwise(F.least(F.col("_end"), F.col("_start") + (block - 1)))
    return (rows.join(side, ["contig_idx", "block"])
            .withColumn("ref_from", lo).withColumn("ref_to", hi.cast("int"))
            .withColumn("ref_seq", F.substring("_seq", F.col("ref_from") - F.col("_start") + 1,
                                               F.col("ref_to") - F.col("ref_from") + 1))
            .drop("_end", "block", "_start", "_seq"))


def reference_text(df: DataFrame, blocks: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """Adds ``name``, the reference from ``first`` to ``last`` (shorter at a contig's end); rows off the contig are dropped.

    Pieces of several blocks are put together by all columns of ``df``, which must be comparable; equal rows become one.
    """
    rows = df.withColumns({"_at": F.greatest(first, F.lit(1)).cast("int"), "_to": last.cast("int")}).filter("_at <= _to")
    lined = rows.withColumnsRenamed({c: f"_{c}_" for c in ("pos", "cigar") if c in df.columns}).withColumns({
        "pos": F.col("_at"), "cigar": F.concat((F.col("_to") - F.col("_at") + 1).cast("string"), F.lit("M"))})
    pieces = reference_pieces(lined, blocks).drop("pos", "cigar").withColumnsRenamed(
        {f"_{c}_": c for c in ("pos", "cigar") if c in df.columns})
    one = (F.col("ref_from") == F.col("_at")) & (F.col("ref_to") == F.col("_to"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ref_from", "ref_seq"))), lambda x: x["ref_seq"]), "")
    several = pieces.filter(~one).groupBy(*df.columns).agg(text.alias(name))
    return pieces.filter(one).select(*df.columns, F.col("ref_seq").alias(name)).unionByName(several)


def windows_of(df: DataFrame, text: Column, count: Column, width: int, keep: list[str],
               step: int = 1, run: int = 64) -> DataFrame:
    """``keep`` plus ``k, window``: the first ``count`` windows of ``text``, ``step`` apart.

    Reaching into a long string costs its length, so it is cut to short runs
    first and the windows are taken from those.
    """
    rows = df.select(*keep, text.alias("_t"), count.alias("_n")).filter(F.col("_n") > 0)
    rows = rows.withColumn("_r", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / run).cast("int"))))
    rows = rows.select(*keep, (F.col("_r") * run).alias("_first"), F.least(F.lit(run), F.col("_n") - F.col("_r") * run).alias("_n"),
                       F.substring("_t", F.col("_r") * (run * step) + 1, F.lit((run - 1) * step + width)).alias("_t"))
    rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return rows.select(*keep, (F.col("_first") + F.col("_k")).alias("k"),
                       F.substring("_t", F.col("_k") * step + 1, F.lit(width)).alias("window"))


def count_contigs(fasta_lines: DataFrame) -> DataFrame:
    """How many lines of a FASTA text (column ``value``) open a contig."""
    return fasta_lines.filter(F.col("value").startswith(">")).agg(F.count(F.lit(1)).alias("contigs"))


def sequence_windows(contigs: DataFrame, width: int, overlap: int) -> DataFrame:
    """Substrings of ``width`` bases every ``width - overlap``; the last may be short."""
    step = width - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than width")
    count = F.floor((F.greatest(F.length("seq") - F.lit(overlap), F.lit(1)) - 1) / F.lit(step)).cast("int") + 1
    rows = windows_of(contigs.filter(F.length("seq") > 0), F.col("seq"), count, width, ["contig_idx", "contig"], step)
    return rows.select("contig_idx", "contig", (F.col("k") * step + 1).alias("start"), F.col("window").alias("seq"))


def find_subsequence(blocks: DataFrame, query: str, block: int = BLOCK, overlap: int = OVERLAP) -> DataFrame:
    """Every position (overlapping ones too) where ``query`` occurs.

    A block is searched only when it holds the query at all; a match belongs to
    the block in which it starts.
    """
    n = len(query)
    if n - 1 > overlap:
        raise ValueError("use reference blocks whose overlap is at least the query length")
    rows = windows_of(blocks.filter(F.col("seq").contains(query)), F.col("seq"),
                      F.least(F.lit(block), F.length("seq") - (n - 1)), n, ["contig_idx", "contig", "start"])
    return rows.filter(F.col("window") == query).select(
        "contig_idx", "contig", (F.col("start") + F.col("k")).cast("int").alias("pos"))


def _spots_of(blocks: DataFrame, words: DataFrame, n: int, block: int) -> DataFrame:
    """``window, contig_idx, contig, at``: the places of all ``words`` (column ``window``) of ``n`` letters, and of few others."""
    lined = blocks.select("contig_idx", "contig", "start", F.substring("seq", 1, block + n - 1).alias("_t"),
                          F.least(F.lit(block), F.length("seq") - (n - 1)).alias("_n"))
    kept = dict(lined.select("contig_idx", "contig", "start").dtypes)
    return lined.mapInArrow(*windows_with_words(kept, WordFilter(words, "window", n), n, 0)).select(
        "window", "contig_idx", "contig", (F.col("start") + F.col("k")).cast("int").alias("at"))


def find_patterns(blocks: DataFrame, patterns: DataFrame, k: int = 12, block: int = BLOCK) -> DataFrame:
    """``pattern_id, contig_idx, contig, pos`` of every occurrence of every row of ``patterns`` (pattern_id, pattern).

    Each pattern is sought by the one of its ``k``-mers that the reference holds least often: those that patterns have are
    counted where they are, and only the places of the chosen ones are shuffled and compared with the whole pattern,
    over block borders if need be. Shorter patterns are words of their own length. Null and empty patterns have no
    occurrence; equal ones are sought once.
    """
    size = F.length("pattern")
    sought = patterns.filter(size > 0).select("pattern").distinct()
    lengths = [r[0] for r in sought.select(F.least(size, F.lit(k)).alias("n")).distinct().collect()]  # at most k
    found = None
    for n in sorted(lengths):
        mine = sought.filter(F.least(size, F.lit(k)) == n)
        words = mine.withColumn("o", F.explode(F.sequence(F.lit(0), size - n))).select("pattern", "o", F.substring("pattern", F.col("o") + 1, F.lit(n)).alias("window"))
        if n < k:  # the word is the pattern
            hits = _spots_of(blocks, mine.select(F.col("pattern").alias("window")), n, block).withColumnRenamed("window", "pattern").join(
                mine, "pattern").select("pattern", "contig_idx", "contig", F.col("at").alias("pos"))
        else:
            words = stored(words, "pattern-parts")
            often = _spots_of(blocks, words, n, block).groupBy("window").agg(F.count(F.lit(1)).alias("n"))
            best = words.join(often, "window").groupBy("pattern").agg(F.min(F.struct("n", "o", "window")).alias("b"))
            best = stored(best.select("pattern", "b.o", "b.window"), "pattern-words")
            places = best.join(_spots_of(blocks, best, n, block), "window").select(
                "pattern", "contig_idx", "contig", (F.col("at") - F.col("o")).alias("pos")).filter("pos >= 1")
            hits = reference_text(places, blocks, F.col("pos"), F.col("pos") + F.length("pattern") - 1, "_t") \
                .filter(F.col("_t") == F.col("pattern")).drop("_t")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = blocks.filter("false").select(F.lit("").alias("pattern"), "contig_idx", "contig", F.lit(0).alias("pos"))
    return patterns.join(found, "pattern").select("pattern_id", "contig_idx", "contig", "pos")


def subsequence(contigs: DataFrame, pos: int, length: int) -> DataFrame:
    """``length`` bases from 1-based ``pos`` of every contig (shorter at its end)."""
    return contigs.select("contig_idx", "contig", F.substring("seq", pos, length).alias("seq"))
