"""Molecules behind read pairs, when one sequencing error must not count as another molecule."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.components import components
from ..functions.scaling import stored
from .dedup import library_size


def _marks(read: str, side: int):
    """Two 64-bit hashes of every (read, position, base); a set of pairs is named by their exclusive or."""
    letters = F.filter(F.split(read, ""), lambda c: c != "")
    return F.transform(letters, lambda c, i: F.struct(
        i.alias("at"), F.xxhash64(F.lit(side), i, c).alias("a"), F.xxhash64(c, F.lit(side), i).alias("b")))


def _folded(marks, lane: str):
    return F.aggregate(marks, F.lit(0).cast("bigint"), lambda acc, m: acc.bitwiseXOR(m[lane]))


def _links(sets: DataFrame, same: str, other: str) -> DataFrame:
    """(a, b): sets with an equal read ``same`` whose reads ``other`` differ in one base.

    Each position is left out in turn: what has the same rest is linked, in a chain. Such a group holds at most one set
    for each letter of the alphabet, however many copies and errors a molecule has. Sets whose ``same`` no other set has
    are left out before.
    """
    key = [F.xxhash64(F.lit(0), same).alias("p"), F.xxhash64(F.lit(1), same).alias("q")]
    company = stored(sets.groupBy(*key).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("p", "q"), "company")
    rows = sets.select("id", *key, other).join(company, ["p", "q"], "left_semi")
    marks = rows.select("id", "p", "q", _marks(other, 0).alias("m"))
    marks = marks.select("id", "p", "q", F.inline("m"), _folded(F.col("m"), "a").alias("all_a"), _folded(F.col("m"), "b").alias("all_b"))
    rest = marks.select("id", "p", "q", "at", F.col("a").bitwiseXOR(F.col("all_a")).alias("a"), F.col("b").bitwiseXOR(F.col("all_b")).alias("b"))
    before = F.lag("id").over(Window.partitionBy("p", "q", "at", "a", "b").orderBy("id"))
    return rest.select(F.col("id").alias("a"), before.alias("b")).filter("b is not null")


def molecules(pairs: DataFrame) -> DataFrame:
    """(left_seq, right_seq, n, molecule) of every distinct pair of reads, ``n`` times seen.

    Pairs of equal lengths that differ in one base in all are of one molecule, and so is what such steps connect. Pairs
    without one of their reads are left out. The molecule's number has no meaning but its equality.
    """
    whole = pairs.filter("left_seq is not null and right_seq is not null")
    sets = stored(whole.groupBy("left_seq", "right_seq").agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("id", F.monotonically_increasing_id()), "sets")
    links = _links(sets, "left_seq", "right_seq").unionByName(_links(sets, "right_seq", "left_seq"))
    found = components(links, "a", "b").select(F.col("node").alias("id"), "component")
    return sets.join(found, "id", "left").select("left_seq", "right_seq", "n", F.coalesce("component", "id").alias("molecule"))


def molecule_complexity(pairs: DataFrame) -> DataFrame:
    """``library_complexity`` over molecules: how many have each number of pairs, and the estimated number in the library."""
    sizes = molecules(pairs).groupBy("molecule").agg(F.sum("n").alias("set_size"))
    hist = sizes.groupBy("set_size").agg(F.count(F.lit(1)).alias("sets"))
    whole = Window.partitionBy()  # one row per distinct size
    return hist.withColumn("unique_estimate", library_size(
        F.sum(F.col("set_size") * F.col("sets")).over(whole), F.sum("sets").over(whole)))
