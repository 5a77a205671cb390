"""Column helpers for base strings and phred qualities."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_PHRED = 93
#: log10 likelihood terms are kept as whole millionths, so sums are exact and
#: do not depend on the order in which partitions are merged
MICRO = 1_000_000


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    The optimizer may copy a column's expression to every place that names it,
    also into lambdas, where it would run once per element; a bound value cannot
    be copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def differences(a: Column, b: Column) -> Column:
    """Number of places where two equally long texts differ."""
    def count(t):
        return F.size(F.filter(F.zip_with(F.split(t["a"], ""), F.split(t["b"], ""), lambda x, y: ~x.eqNullSafe(y)), lambda w: w))
    return bind(F.struct(a.alias("a"), b.alias("b")),
                lambda t: F.when(t["a"] == t["b"], 0).otherwise(count(t)))


def has_flag(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) != 0


def complement(base: Column) -> Column:
    return F.translate(base, "ACGTacgt", "TGCAtgca")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(complement(seq))


def phred_values(qual: Column) -> Column:
    """Printable quality string (offset 33) to an array of integers."""
    # one pass over the text; cutting a letter out by its number would walk the string each time
    letters = F.when(F.length(qual) > 0, F.split(qual, "")).otherwise(F.array().cast("array<string>"))
    return F.when(qual.isNotNull(), F.transform(letters, lambda c: F.ascii(c) - 33))


def phred_string(quals: Column) -> Column:
    return F.array_join(F.transform(quals, lambda q: F.char(q + 33)), "")


def base_at(seq: Column, offset: Column) -> Column:
    """The base at a 0-based offset."""
    return F.substring(seq, offset + 1, F.lit(1))


def copy_terms(ploidy: int) -> list[list[int]]:
    """terms[k][q]: millionths of log10 P(base seen | k of ``ploidy`` copies differ from it)."""
    table = []
    for k in range(ploidy + 1):
        row = []
        for q in range(MAX_PHRED + 1):
            e = 10.0 ** (-max(q, 1) / 10.0)
            p = (ploidy - k) / ploidy * (1 - e) + k / ploidy * e / 3
            row.append(math.floor(math.log10(p) * MICRO + 0.5))
        table.append(row)
    return table


def lookup(values: list[int], index: Column) -> Column:
    """Constant-table lookup that stays inside generated code."""
    return F.get(F.lit(values).cast("array<bigint>"), index)
