"""Mixing sources to target weights by entropy balancing.

The rates closest to one in relative entropy that give every source its target number of words, none above
``cap``, are min(cap, exp(lambda_source * size)): exponentially tilted. The convex dual has one lambda per source
and is solved by guarded Newton steps, each one aggregate over a histogram of sizes. Rates become whole copies by
systematic rounding along the documents ordered by source and size, so a source's words miss its target by no
more than about its largest document. All sums that decide something are of integers, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scaling import cut_lineage, dense_ordinal, lookup_join, running_total
from .common import WORD, stored, table

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2
_UNIT = float(1 << 20)


def word_count(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_no, source_size, target) from (source, size) rows.

    Sources in code point order, null last, take the weights in turn. Targets share ``share`` of all sizes by
    weight; those above ``cap`` times their source stop there and the excess is shared again.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranked = dense_ordinal(sums.withColumn("_last", F.col("source").isNull()), "_last", "source", name="source_no")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    ranked = cut_lineage(ranked.withColumns({"w": weight, "most": F.col("source_size") * float(cap)}))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped = 0.0, -1
    while True:  # a source that is stopped stays so, as the level only rises
        over = F.col("most") < F.lit(level) * F.col("w")
        n, held, free = ranked.agg(F.count_if(over), F.sum(F.when(over, F.col("most"))), F.sum(F.when(~over, F.col("w")))).first()
        if n == stopped or not free:
            break
        stopped, level = n, (total - (held or 0.0)) / free
    return ranked.select("source", "source_no", "source_size", "n",
                         F.least("most", F.lit(level) * F.col("w")).alias("target"))


def solve_tilts(histogram: DataFrame, targets: DataFrame, cap: int = CAP, tolerance: float = 1e-8,
                rounds: int = 80) -> DataFrame:
    """(source_no, mean, tilt): rate of a document is min(cap, exp(tilt * size / mean)).

    ``histogram``: (source_no, size, n). A source whose target is its cap or nothing needs no solving: its tilt is
    null and its rate the cap.
    """
    state = cut_lineage(targets.select(
        "source_no", "target", (F.col("source_size") / F.col("n")).alias("mean"),
        ((F.col("target") >= F.col("source_size") * float(cap) * (1 - tolerance)) | (F.col("target") <= 0)).alias("done"),
        F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")))
    few = state.count() <= 10_000  # 7 numbers a source
    for _ in range(rounds):
        todo = state.filter(~F.col("done"))
        x = F.col("size") / F.col("mean")
        raw = F.exp(F.least(F.col("tilt") * x, F.lit(50.0)))
        words = (F.col("size") * F.col("n")).cast("double")
        fixed = lambda c: F.sum(F.floor(c * _UNIT).cast("decimal(38,0)")).cast("double") / _UNIT
        sums = (histogram.join(F.broadcast(todo) if few else todo, "source_no").groupBy("source_no").agg(
            fixed(words * F.least(raw, F.lit(float(cap)))).alias("g"),
            fixed(F.when(raw < cap, words * x * raw).otherwise(0.0)).alias("slope")))
        miss = F.col("g") - F.col("target")
        nxt = state.join(F.broadcast(sums) if few else sums, "source_no", "left")
        low = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
        nxt = nxt.withColumns({"_low": low, "_high": high, "_newton": F.when(F.col("slope") > 0, F.col("tilt") - miss / F.col("slope"))})
        inside = ((F.col("_low").isNull() | (F.col("_newton") > F.col("_low")))
                  & (F.col("_high").isNull() | (F.col("_newton") < F.col("_high"))))
        reach = F.greatest(F.lit(1.0), F.abs("tilt"))
        guarded = (F.when(F.col("_newton").isNotNull() & inside
                          & (F.abs(F.col("_newton") - F.col("tilt")) <= 4 * reach), F.col("_newton"))
                   .when(F.col("_low").isNull(), F.col("tilt") - reach)
                   .when(F.col("_high").isNull(), F.col("tilt") + reach)
                   .otherwise((F.col("_low") + F.col("_high")) / 2))
        near = F.abs(miss) <= F.col("target") * tolerance
        stays = F.col("done") | F.coalesce(near, F.lit(False))
        state = cut_lineage(nxt.select(
            "source_no", "target", "mean", stays.alias("done"), F.when(stays, F.col("tilt")).otherwise(guarded).alias("tilt"),
            F.col("_low").alias("low"), F.col("_high").alias("high")))
        if state.filter(~F.col("done")).isEmpty():
            break
    full = targets.select("source_no", ((F.col("target") >= F.col("source_size") * float(cap) * (1 - tolerance))).alias("full"))
    return state.join(full, "source_no").select("source_no", "mean", F.when(~F.col("full"), F.col("tilt")).alias("tilt"))


def mix(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Adds source_size, target, n (equal rows) and copies (of all equal rows together) to each distinct row.

    ``sizes`` holds source, size (null counts as 0) and columns that tell rows apart. Sources without words have
    target 0; documents without words get the cap and add nothing. An empty table gives no rows.
    """
    keys = [c for c in sizes.columns if c not in ("source", "size")]
    sizes = stored(sizes.withColumn("size", F.coalesce("size", F.lit(0)).cast("long")), "sizes")
    targets = source_targets(sizes, weights, share, cap)
    numbered = targets.select("source", "source_no")
    joined = lookup_join(sizes.withColumns({"_null": F.col("source").isNull(), "source": F.coalesce("source", F.lit(""))}),
                         numbered.withColumns({"_null": F.col("source").isNull(), "source": F.coalesce("source", F.lit(""))}),
                         ["source", "_null"], keys)
    rows = joined.withColumn("source", F.when(~F.col("_null"), F.col("source"))).drop("_null")
    histogram = stored(rows.filter("size > 0").groupBy("source_no", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    tilts = solve_tilts(histogram, targets, cap).join(targets.select("source_no", "source_size", "target"), "source_no")
    groups = rows.groupBy("source", "source_no", "size", *keys).agg(F.count(F.lit(1)).alias("n"))
    rated = lookup_join(groups, tilts, ["source_no"], keys)
    rate = F.coalesce(F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0)))),
                      F.lit(float(cap)))
    rated = rated.withColumn("_rate", F.round(rate * _UNIT).cast("long") * F.col("n"))
    placed = running_total(rated, "source_no", "size", *keys, weight=F.col("_rate"), name="_before")
    whole = lambda c: F.floor(c / F.lit(int(_UNIT)).cast("decimal(38,0)"))
    before, after = F.col("_before").cast("decimal(38,0)"), (F.col("_before") + F.col("_rate")).cast("decimal(38,0)")
    return (placed.withColumn("copies", (whole(after) - whole(before)).cast("long"))
            .drop("_rate", "_before", "total", "mean", "tilt", "source_no"))


def _part(copies: F.Column, n: F.Column, i: F.Column) -> F.Column:
    """What the i-th of n equal rows gets."""
    return F.expr("(copies * (i + 1)) div n - (copies * i) div n") if i is None else (
        F.floor(copies * (i + 1) / n) - F.floor(copies * i / n)).cast("long")


def mixed_documents(docs: DataFrame, text: str = "text", weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The documents, each repeated as often as the mix takes it; columns unchanged.

    Rows of equal doc_id, text and source share their copies. One shuffle of the texts, by a key of the row.
    """
    key = F.unhex(F.md5(F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                                    F.coalesce("source", F.lit("null")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))))
    keyed = docs.withColumn("_row_key", key)
    copies = mix(keyed.select(F.col("_row_key"), "source", word_count(text).alias("size")), weights, share, cap)
    joined = keyed.join(copies.select("_row_key", F.col("n").alias("_n"), F.col("copies").alias("_copies")), "_row_key")
    from pyspark.sql import Window
    joined = joined.withColumn("_i", F.row_number().over(Window.partitionBy("_row_key").orderBy("_n")) - 1)
    times = _part(F.col("_copies"), F.col("_n"), F.col("_i")).cast("int")
    return (joined.withColumn("_times", F.explode(F.array_repeat(F.lit(0), times)))
            .select(*docs.columns))


def op7_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size"))
    each = mix(docs).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return each.select("doc_id", "size", "source_size", "target",
                       (_part(F.col("copies"), F.col("n"), F.col("i")) * F.col("size")).alias("taken"))
