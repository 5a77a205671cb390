"""All sites of the reference, in runs, and allele counts over several samples."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bases import MICRO, bind
from ..functions.intervals import merge_many
from ..functions.scaling import stored
from .call import LETTERS, SNP_THETA, locus_sums


def reference_runs(sites: DataFrame, contigs: DataFrame, conf: float = 30, width: int = 10_000) -> DataFrame:
    """``contig_idx, contig, start, end, state``: every base of every contig, in longest runs of one state.

    ``sites`` are those of ``call_sites``: ``variant`` where QUAL reaches ``conf``, ``reference`` where the confidence
    in the reference does, else ``unsure``; ``none`` where there is no base of sufficient quality. A run of any length
    is one row, so bases without reads cost a row for a stretch, not one each. Runs are formed inside bins and joined
    over their borders.
    """
    state = F.when(F.col("qual") >= conf, "variant").when(F.col("ref_qual") >= conf, "reference").otherwise("unsure")
    bin_of = F.floor((F.col("pos") - 1) / F.lit(width)).cast("int")
    loci = sites.select("contig_idx", "pos", bin_of.alias("_bin"), state.alias("state"))
    own = Window.partitionBy("contig_idx", "_bin", "state").orderBy("pos")
    runs = loci.withColumn("_run", F.col("pos") - F.row_number().over(own)).groupBy("contig_idx", "_bin", "state", "_run").agg(
        F.min("pos").alias("start"), F.max("pos").alias("end")).drop("_run")
    runs = stored(runs, "reference-runs")  # looked at once a state, and the sites are many times as many
    # what is between the runs of a bin, and after the last; a bin without any is one such stretch
    last = F.floor((F.col("contig_len") - 1) / F.lit(width)).cast("int")
    bins = contigs.filter("contig_len > 0").select("contig_idx", "contig_len", F.explode(F.sequence(F.lit(0), last)).alias("_bin"))
    edge = bins.select("contig_idx", "_bin", F.lit(None).cast("string").alias("state"), (
        F.least((F.col("_bin") + 1) * width, "contig_len") + 1).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))
    along = Window.partitionBy("contig_idx", "_bin").orderBy("start")
    before = F.coalesce(F.lag("end").over(along), F.col("_bin") * width)
    empty = runs.unionByName(edge).withColumn("_from", (before + 1).cast("int")).filter("_from < start").select(
        "contig_idx", F.col("_from").alias("start"), (F.col("start") - 1).cast("int").alias("end"))
    parts = [merge_many(runs.filter(F.col("state") == s).select("contig_idx", "start", "end"), gap=1).withColumn("state", F.lit(s))
             for s in ("variant", "reference", "unsure")]
    parts.append(merge_many(empty, gap=1).withColumn("state", F.lit("none")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.join(contigs.select("contig_idx", "contig"), "contig_idx").select(
        "contig_idx", "contig", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "state")


def _convolved(samples: Column) -> Column:
    """(z, scale): z[k] sums the likelihoods of all genotypes of all samples that hold k alternates, over 10^scale.

    Adding a sample: z'[k] = L0 z[k] + 2 L1 z[k-1] + L2 z[k-2]; the two orders of a heterozygote are counted apart.
    """
    start = F.struct(F.array(F.lit(1.0)).alias("z"), F.lit(0.0).alias("scale"))

    def step(acc, s):
        top = F.greatest(s["l0"], s["l1"], s["l2"])
        part = lambda n: F.pow(F.lit(10.0), (s[n] - top) / F.lit(float(MICRO)))
        weights = F.struct(part("l0").alias("a"), (2 * part("l1")).alias("b"), part("l2").alias("c"))

        def added(w):
            z = acc["z"]
            of = lambda k: F.when((k >= 0) & (k < F.size(z)), F.get(z, k)).otherwise(0.0)
            grown = F.transform(F.sequence(F.lit(0), F.size(z) + 1), lambda k: of(k) * w["a"] + of(k - 1) * w["b"] + of(k - 2) * w["c"])
            return bind(grown, lambda g: F.struct(F.transform(g, lambda x: x / F.array_max(g)).alias("z"), (
                acc["scale"] + top / F.lit(float(MICRO)) + F.log10(F.array_max(g))).alias("scale")))

        return bind(weights, added)

    return F.aggregate(samples, start, step)


def call_joint(pile: DataFrame, sample: str = "sample", conf: float = 30, theta: float = SNP_THETA) -> DataFrame:
    """Sites that some sample does not share with the reference, and how many copies do not, over all samples at once.

    ``pile`` has a column naming the sample. Per locus the other letter is the most frequent one over all samples (ties
    by letter). The number of alternate copies among 2 n, n samples with a base at the site, has prior ``theta / k``;
    its likelihood is the mean over all genotypes with k copies, by a dynamic programme over the samples. ``qual`` is
    of no copy at all, ``ac`` the most probable number of copies, ``an`` is 2 n. A null sample is one of its own.
    """
    sums = locus_sums(pile, 2, by=(sample,)).withColumn("contig", F.struct("contig", F.col(sample).alias("s")))
    sums = sums.filter(F.col("ref_base").isin(list(LETTERS)))
    site = ["contig_idx", "pos", "ref_base"]
    # all samples of a site are in one place: their total stands beside each, without a join
    whole = Window.partitionBy(*site)
    totals = sums.withColumns({f"_{b}": F.sum(f"n_{b}").over(whole) for b in LETTERS})
    others = F.array(*[F.struct(F.when(F.col("ref_base") == b, F.lit(0).cast("bigint")).otherwise(F.col(f"_{b}")).alias("n"), F.lit(-i).alias("o"))
                       for i, b in enumerate(LETTERS)])
    rows = totals.withColumn("_o", F.array_max(others)).filter("_o.n > 0").withColumn("alt", F.substring(F.lit(LETTERS), 1 - F.col("_o.o"), F.lit(1)))
    pick = lambda k, letter: sum(F.when(F.col(letter) == b, F.col(f"s{k}_{b}")).otherwise(0) for b in LETTERS)
    held = sum(F.when((F.col("ref_base") == b) | (F.col("alt") == b), F.col(f"n_{b}")).otherwise(0) for b in LETTERS)
    rows = rows.select(*site, "alt", "contig.contig", F.col("contig.s").alias("s"), held.alias("dp"),
                       *[(pick(k, "ref_base") + pick(2 - k, "alt")).alias(f"l{k}") for k in range(3)]).filter("dp > 0")
    sites = rows.groupBy(*site, "contig", "alt").agg(
        F.sum("dp").alias("dp"), F.sort_array(F.collect_list(F.struct("s", "l0", "l1", "l2"))).alias("_l"))
    sites = sites.withColumn("_n", 2 * F.size("_l")).select("*", F.explode(F.array(_convolved(F.col("_l")))).alias("_z"))
    # log10 of 2n over k, as a running sum
    choose = F.aggregate(F.sequence(F.lit(1), F.col("_n")), F.array(F.lit(0.0)), lambda acc, k: F.concat(
        acc, F.array(F.get(acc, k - 1) + F.log10((F.col("_n") - k + 1) / k))))
    harmonic = F.aggregate(F.sequence(F.lit(1), F.col("_n")), F.lit(0.0), lambda acc, k: acc + F.lit(theta) / k)
    sites = sites.withColumns({"_c": choose, "_none": F.log10(1 - harmonic)})
    posterior = F.transform("_z.z", lambda z, k: F.when(z > 0, F.log10(z) - F.get("_c", k) + F.when(k == 0, F.col("_none")).otherwise(
        F.lit(math.log10(theta)) - F.log10(F.greatest(k, F.lit(1))))))
    sites = sites.select("*", F.explode(F.array(bind(posterior, lambda p: F.struct(
        (F.array_position(p, F.array_max(p)).cast("int") - 1).alias("ac"),
        (F.array_max(p) + F.log10(F.aggregate(p, F.lit(0.0), lambda t, x: t + F.coalesce(F.pow(F.lit(10.0), x - F.array_max(p)), F.lit(0.0))))
         - F.get(p, F.lit(0))).alias("q"))))).alias("_p"))
    return sites.filter(F.col("_p.q") * 10 >= conf).select(
        "contig_idx", "contig", "pos", F.col("ref_base").alias("ref"), "alt", F.round(F.col("_p.q") * 10, 2).alias("qual"),
        F.col("_p.ac").alias("ac"), F.col("_n").cast("int").alias("an"), "dp")
