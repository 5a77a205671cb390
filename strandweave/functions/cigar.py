"""CIGAR handling with built-in column expressions only.

Nearly all reads are one plain match run, so each helper has a cheap branch
for ``<n>M``; ``coalesce`` evaluates the general walk only for the others.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_OP = r"(\d+)([MIDNSHP=X])"
ON_REFERENCE = ["M", "D", "N", "=", "X"]
ON_READ = ["M", "I", "S", "=", "X"]
MATCH = ["M", "=", "X"]


def plain_match(cigar: Column) -> Column:
    """Length when the whole CIGAR is one ``M`` run, else NULL."""
    return F.when(
        cigar.endswith("M"),
        F.substring(cigar, F.lit(1), F.length(cigar) - 1).try_cast("int"))


def cigar_ops(cigar: Column) -> Column:
    """``array<struct<len:int,op:string>>``; empty for ``*``."""
    lens = F.regexp_extract_all(cigar, F.lit(_OP), F.lit(1))
    ops = F.regexp_extract_all(cigar, F.lit(_OP), F.lit(2))
    return F.zip_with(lens, ops, lambda n, o: F.struct(n.cast("int").alias("len"), o.alias("op")))


def cigar_text(ops: Column) -> Column:
    return F.array_join(F.transform(ops, lambda s: F.concat(s["len"].cast("string"), s["op"])), "")


def _walk(cigar: Column) -> Column:
    seg_type = "array<struct<op:string,len:int,read_off:int,ref_off:int>>"
    start = F.struct(
        F.lit(0).alias("r"), F.lit(0).alias("f"), F.array().cast(seg_type).alias("segs"))

    def step(acc, s):
        return F.struct(
            (acc["r"] + F.when(s["op"].isin(ON_READ), s["len"]).otherwise(0)).alias("r"),
            (acc["f"] + F.when(s["op"].isin(ON_REFERENCE), s["len"]).otherwise(0)).alias("f"),
            F.concat(acc["segs"], F.array(F.struct(
                s["op"].alias("op"), s["len"].alias("len"),
                acc["r"].alias("read_off"), acc["f"].alias("ref_off")))).alias("segs"))

    return F.aggregate(cigar_ops(cigar), start, step, lambda acc: acc["segs"])


def cigar_segments(cigar: Column) -> Column:
    """Operations with the 0-based read and reference offsets where each begins."""
    n = plain_match(cigar)
    one = F.when(n.isNotNull(), F.array(F.struct(
        F.lit("M").alias("op"), n.alias("len"),
        F.lit(0).alias("read_off"), F.lit(0).alias("ref_off"))))
    return F.coalesce(one, _walk(cigar))


def _total(cigar: Column, kinds) -> Column:
    return F.aggregate(
        cigar_ops(cigar), F.lit(0),
        lambda acc, s: acc + F.when(s["op"].isin(kinds), s["len"]).otherwise(0))


def reference_span(cigar: Column) -> Column:
    return F.coalesce(plain_match(cigar), _total(cigar, ON_REFERENCE))


def reference_end(pos: Column, cigar: Column) -> Column:
    return (pos + reference_span(cigar) - 1).cast("int")


def _clip(cigar: Column, pattern: str) -> Column:
    def part(group):
        return F.coalesce(F.regexp_extract(cigar, pattern, group).try_cast("int"), F.lit(0))
    return F.when(plain_match(cigar).isNotNull(), F.lit(0)).otherwise(part(1) + part(2))


def leading_clip(cigar: Column) -> Column:
    return _clip(cigar, r"^(?:(\d+)H)?(?:(\d+)S)?")


def trailing_clip(cigar: Column) -> Column:
    return _clip(cigar, r"(?:[^\d](\d+)S)?(?:(?<=[^\d])(\d+)H)?$")


def five_prime(pos: Column, cigar: Column, reverse: Column) -> Column:
    """Unclipped position of the first sequenced base."""
    return F.when(reverse, reference_end(pos, cigar) + trailing_clip(cigar)) \
        .otherwise(pos - leading_clip(cigar)).cast("int")
