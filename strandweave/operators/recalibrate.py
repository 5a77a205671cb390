"""Base quality recalibration from mismatches at sites not known to vary."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions.bases import base_at, bind, complement, has_flag
from ..functions.scaling import cut_lineage, lookup_join
from . import batches
from .pileup import callable_reads, read_pieces
from .reference import mask_blocks

LOWEST_QUALITY = 6
HIGHEST_QUALITY = 60


def machine_cycle(flag: Column, mate: Column, i: Column, length: Column) -> Column:
    """1-based place in sequencing order, negative for the second mate."""
    at = F.when(has_flag(flag, M.REVERSE), length - i).otherwise(i + 1)
    return F.when(mate == 2, -at).otherwise(at).cast("int")


def _empirical() -> Column:
    rate = (F.col("errors") + 1) / (F.col("observations") + 2)
    return F.round(F.log10(rate) * -10).cast("int")


def bqsr_table(df: DataFrame, known_sites: DataFrame, blocks: DataFrame,
               min_quality: int = LOWEST_QUALITY) -> DataFrame:
    """Observations and mismatches by read group, quality, cycle and context.

    Known sites are masked inside the reference blocks, so bases are never
    shuffled: the one wide shuffle brings reads to their blocks, and bases are
    summed to the finest cells in the same stage, a batch of reads at once. The coarser covariates are
    grouping sets over those few cells.
    """
    masked = mask_blocks(blocks, known_sites)
    reverse = has_flag(F.col("flag"), M.REVERSE)
    keep = [F.col("read_group.id").alias("read_group"), "seq", "quals", reverse.alias("reverse"),
            F.when(F.col("mate") == 2, -1).otherwise(1).alias("sign"),
            F.when(reverse, F.length("seq")).otherwise(1).alias("c0"), F.when(reverse, -1).otherwise(1).alias("c1")]
    pieces = read_pieces(callable_reads(df), masked, keep)
    cells = pieces.drop("contig_idx", "op").mapInArrow(
        batches.error_cells(min_quality), "read_group string, reported_q int, cycle int, context string, n bigint, e bigint")
    g, q, c, x = (F.col(k) for k in ("read_group", "reported_q", "cycle", "context"))
    sets = cells.groupingSets([[g], [g, q], [g, q, c], [g, q, x]], g, q, c, x).agg(
        F.sum("n").alias("observations"), F.sum("e").alias("errors"),
        F.grouping("reported_q").alias("no_q"), F.grouping("cycle").alias("no_c"),
        F.grouping("context").alias("no_x"))
    no_q, no_c, no_x = (F.col(k) == 1 for k in ("no_q", "no_c", "no_x"))
    sets = sets.filter(no_x | F.col("context").isNotNull())
    return sets.select(
        "read_group", "reported_q",
        F.when(no_q, "read_group").when(no_c & no_x, "quality").when(no_x, "cycle")
        .otherwise("context").alias("covariate"),
        F.when(no_c & no_x, "").when(no_x, F.col("cycle").cast("string"))
        .otherwise(F.col("context")).alias("value"),
        "observations", "errors", _empirical().alias("empirical_q"))


def _codes(seq: Column) -> Column:
    """Bases as 0..3 in letter order, -1 for anything else."""
    return F.transform(F.split(seq, ""), lambda b: F.instr(F.lit("ACGT"), b) - 1)


def _lookup_arrays(table: DataFrame, reach: int) -> DataFrame:
    """One row per read group: dense arrays addressed by quality, cycle and context.

    ``q_of[q]`` is the quality-level answer, ``cycle_shift[q][cycle + reach]`` and
    ``context_shift[q][4 * previous + current]`` the further steps.
    """
    quality = table.filter("covariate = 'quality'").select("read_group", "reported_q", F.col("empirical_q").alias("base_q"))
    fine = table.filter("covariate IN ('cycle', 'context')").join(quality, ["read_group", "reported_q"])
    code = F.when(F.col("covariate") == "cycle", F.col("value").try_cast("int")).otherwise(
        (F.instr(F.lit("ACGT"), F.substring("value", 1, 1)) - 1) * 4
        + F.instr(F.lit("ACGT"), F.substring("value", 2, 1)) - 1)
    entry = F.struct(code.alias("k"), (F.col("empirical_q") - F.col("base_q")).alias("v"))
    # entries per quality are bounded by read length and by sixteen contexts
    per_q = fine.groupBy("read_group", "reported_q", "base_q").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("covariate") == "cycle", entry))).alias("c"),
        F.map_from_entries(F.collect_list(F.when(F.col("covariate") == "context", entry))).alias("x"))

    def dense(column, lo, hi):
        return F.transform(F.sequence(F.lit(lo), F.lit(hi)), lambda k: F.coalesce(F.try_element_at(column, k), F.lit(0)))

    per_q = per_q.select("read_group", "reported_q", F.struct(
        F.col("base_q"), dense(F.col("c"), -reach, reach).alias("c"), dense(F.col("x"), 0, 15).alias("x")).alias("s"))
    by_q = per_q.groupBy("read_group").agg(F.map_from_entries(F.collect_list(F.struct("reported_q", "s"))).alias("m"))
    at_q = F.transform(F.sequence(F.lit(0), F.lit(93)), lambda q: F.try_element_at(F.col("m"), q))
    return by_q.select(F.col("read_group").alias("_rg"), at_q.alias("_steps"))


def _few(tables: DataFrame, max_groups: int = 1_000, max_steps: int = 1 << 20) -> tuple[list, list] | None:
    """Names and steps of the read groups where all of them are small enough to go to every task."""
    size = F.aggregate("_steps", F.lit(0), lambda t, s: t + F.coalesce(F.size(s["c"]) + F.size(s["x"]), F.lit(0)))
    rows, steps = tables.limit(max_groups + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    if rows > max_groups or steps > max_steps:
        return None
    held = tables.filter("_rg IS NOT NULL").collect()
    return [r["_rg"] for r in held], [[s and (s["base_q"], s["c"], s["x"]) for s in r["_steps"]] for r in held]


def bqsr_apply(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Replaces ``quals``: group, quality, cycle and context steps added up, clamped.

    Without a table the rows are copied. Qualities under 6 and cells the table
    has not seen keep their value. The table becomes one row of constant-time
    arrays per read group. While the read groups are few, these go to every task and
    the qualities of a batch of reads change at once; else they are joined, and
    qualities change by ``transform`` in place. No base is exploded.
    """
    if table is None:
        return df
    table = cut_lineage(table)
    reach = table.filter("covariate = 'cycle'").agg(F.max(F.abs(F.col("value").cast("int")))).first()[0] or 1
    arrays = cut_lineage(_lookup_arrays(table, reach))
    few = _few(arrays)
    if few is not None:
        groups, steps = few
        code = F.coalesce(F.array_position(F.lit(groups).cast("array<string>"), F.col("read_group.id")), F.lit(0)).cast("int") - 1
        fresh = F.arrow_udf(batches.renewed_qualities(steps, reach, LOWEST_QUALITY, HIGHEST_QUALITY), "array<int>")(
            code, "seq", "quals", has_flag(F.col("flag"), M.REVERSE), F.when(F.col("mate") == 2, -1).otherwise(1))
        return df.withColumn("quals", fresh)
    rows = lookup_join(df.withColumn("_rg", F.col("read_group.id")), arrays, ["_rg"],
                       ["read_name", "mate"], "left")
    reverse = has_flag(F.col("flag"), M.REVERSE)
    sign = F.when(F.col("mate") == 2, -1).otherwise(1)
    forward_codes = _codes(F.col("seq"))
    other_strand = F.transform(F.reverse(forward_codes), lambda c: F.when(c >= 0, F.lit(3) - c).otherwise(c))
    ordered = F.struct(
        F.when(reverse, other_strand).otherwise(forward_codes).alias("codes"),
        F.when(reverse, F.reverse("quals")).otherwise(F.col("quals")).alias("quals"), sign.alias("sign"))

    def renewed(read):
        def renew(q, i):
            step = F.get("_steps", q)
            here, prev = F.get(read["codes"], i), F.get(read["codes"], i - 1)
            known = (i > 0) & (here >= 0) & (prev >= 0)
            cycle = F.coalesce(F.get(step["c"], read["sign"] * (i + 1) + reach), F.lit(0))
            context = F.when(known, F.coalesce(F.get(step["x"], prev * 4 + here), F.lit(0))).otherwise(0)
            total = F.least(F.greatest(step["base_q"] + cycle + context, F.lit(1)), F.lit(HIGHEST_QUALITY))
            return F.when((q < LOWEST_QUALITY) | step.isNull(), q).otherwise(total)
        return F.transform(read["quals"], renew)

    fresh = bind(ordered, renewed)
    fresh = F.when(F.col("_steps").isNull(), F.col("quals")).when(reverse, F.reverse(fresh)).otherwise(fresh)
    # never NULL where there were qualities, and declared so: no second evaluation in a null check
    rows = rows.withColumn("quals", F.coalesce(fresh, F.array().cast("array<int>")))
    return rows.select(*df.columns)


def bqsr_post_table(df: DataFrame, known_sites: DataFrame, blocks: DataFrame) -> DataFrame:
    """Cells before and after recalibration, on one row each where both have them."""
    before = cut_lineage(bqsr_table(df, known_sites, blocks))
    after = bqsr_table(bqsr_apply(df, before), known_sites, blocks)
    keys = ["read_group", "reported_q", "covariate", "value"]
    names = ["observations", "errors", "empirical_q"]
    left = before.select(*[F.coalesce(F.col(k), F.lit(-1)).alias(k) if k == "reported_q" else F.col(k) for k in keys],
                         *[F.col(n).alias(f"{n}_before") for n in names])
    right = after.select(*[F.coalesce(F.col(k), F.lit(-1)).alias(k) if k == "reported_q" else F.col(k) for k in keys],
                         *[F.col(n).alias(f"{n}_after") for n in names])
    return left.join(right, keys, "full_outer")
