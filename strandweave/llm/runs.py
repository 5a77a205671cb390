"""Runs of repeated word sequences in a text, found through string synchronising sets.

A run is a longest stretch of words with smallest period q (words q apart are equal) that holds the period at least
``EXPONENT`` times. Words are numbered per text, so equality is exact. At the scale t = 4, 8, 16, ... a window of t
words has a hash; position i belongs to the synchronising set if the least hash of the windows at i .. i + t, highly
periodic windows left out, is that of i or i + t. Whether i belongs depends only on the 2 t words from i on, its
context; so inside a run of period q, t <= q < 2 t, positions of the set repeat at distance q, and every t positions
there is one. Neighbouring positions of equal context hence propose every such period. A proposal is extended by
comparing words, and kept if it is long enough and no divisor is a period too.

Windows of period t / 4 or less are the highly periodic ones, which the set leaves out: they lie inside runs of
smaller scales. The periods below 4, which no scale covers, are found by comparing the words 1, 2 and 3 apart.
Work is O(n log^2 n) array steps for n words at most; the scales end early where no two contexts are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, table

#: Least number of periods in a run, and its least number of words.
EXPONENT, MIN_LENGTH = 4, 6
_FIRST = 4  # the smallest scale
_ODD, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _TURN
    return h ^ (h >> np.uint64(32))


def _stretches(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the longest stretches of True of at least ``least``."""
    edge = np.flatnonzero(np.diff(equal, prepend=False, append=False))
    return [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= least]


def _matches(x: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from a and b on (with step -1: before them) are equal in turn; a < b."""
    done, width = 0, 64
    while True:
        if step > 0:
            n = min(width, len(x) - b - done)
            different = np.flatnonzero(x[a + done:a + done + n] != x[b + done:b + done + n])
        else:
            n = min(width, a - done)
            different = np.flatnonzero((x[a - done - n:a - done] != x[b - done - n:b - done])[::-1])
        if len(different):
            return done + int(different[0])
        done += n
        if n < width:
            return done
        width *= 4


def _divisors(p: int) -> list[int]:
    """p divided by each of its prime factors."""
    out, f, rest = [], 2, p
    while f * f <= rest:
        if rest % f == 0:
            out.append(p // f)
            while rest % f == 0:
                rest //= f
        f += 1
    return [*out, p // rest] if rest > 1 else out


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i : i + width], for every i where they all are."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:len(least) - step], least[step:])
        have += step
    return least


def synchronising_set(hashes: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """Positions i whose window or that at i + t has the least hash of those at i .. i + t.

    ``hashes`` and ``periodic`` are of the windows of t words; periodic ones are left out. Positions whose windows
    are all left out are not in the set.
    """
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    open_ = np.where(periodic, top, hashes >> np.uint64(1))
    least = _window_minimum(open_, t + 1)
    return np.flatnonzero((least != top) & ((least == open_[:len(least)]) | (least == open_[t:])))


def repeats(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of an integer array, by start, then period."""
    n, found = len(x), {}
    for q in range(1, _FIRST):
        if n < EXPONENT * q:
            break
        for a, b in _stretches(x[:-q] == x[q:], (EXPONENT - 1) * q):
            if q == 1 or not (x[a:a + q] == x[a + 1:a + q + 1]).all():  # 1 divides 2 and 3
                found[a, q] = b - a + q
    hashes, size, t = _mixed((x.astype(np.uint64) + np.uint64(1)) * _ODD), 1, _FIRST
    while EXPONENT * t <= n:
        while size < t:  # window hashes by doubling
            hashes = _mixed(hashes[:-size] * _ODD + hashes[size:])
            size *= 2
        periodic = np.zeros(len(hashes) + 1, np.int64)
        for (a, q), length in found.items():
            if 4 * q <= t <= length:
                periodic[a] += 1
                periodic[a + length - t + 1] -= 1
        sync = synchronising_set(hashes, np.cumsum(periodic[:-1]) > 0, t)
        context = _mixed(hashes[sync] * _ODD + hashes[sync + t])
        order = np.argsort(context, kind="stable")
        same = context[order[1:]] == context[order[:-1]]
        if not same.any() and not found:
            break  # a longer context that repeats would hold one that repeats here
        first = sync[order[:-1][same]]
        period = sync[order[1:][same]] - first
        near = (period >= t) & (period < 2 * t)
        known: dict[int, int] = {}  # end of the last stretch of each period
        for s, p in sorted(zip(first[near].tolist(), period[near].tolist())):
            if s < known.get(p, 0):
                continue
            back, on = _matches(x, s, s + p, -1), _matches(x, s, s + p, 1)
            known[p] = s + on
            start, length = s - back, back + on + p
            if length >= EXPONENT * p and not any(
                    (x[start:start + p] == x[start + d:start + d + p]).all() for d in _divisors(p)):
                found[start, p] = length
        t *= 2
    return sorted((a, length, q) for (a, q), length in found.items() if length >= MIN_LENGTH)


def numbered(words: list) -> np.ndarray:
    """Equal words get equal numbers."""
    numbers: dict = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:-1]) == 0


RUNS = "array<struct<start:long,length:long,period:long>>"
_RESULT = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct(
    [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])


def with_runs(docs: DataFrame, text: str = "text", out: str = "found") -> DataFrame:
    """Adds ``out``: n_words, the runs by start and period, and the text without repeats (kept words, one space between).

    A null, empty or blank text has no words, no runs and an empty text without repeats. Every row is worked on by
    itself, so repeated rows get equal results; a column of the name ``out`` is replaced. A text is read whole,
    however long, by the task that has its row.
    """
    kept = [c for c in docs.columns if c != out]
    given = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(out, T.StructType.fromDDL(
        f"n_words long, runs {RUNS}, collapsed string"))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(len(kept)):
                words = value.as_py().encode().split()  # splits at ASCII white space
                runs = repeats(numbered(words)) if len(words) >= MIN_LENGTH else []
                stay = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))] if runs else words
                rows.append({"n_words": len(words), "collapsed": b" ".join(stay).decode(),
                             "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]})
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(rows, _RESULT)], schema.names)

    return given.mapInArrow(find, schema)


def planted_text(doc_id: Column, text: Column) -> Column:
    """The text with the periodic tail that the contract of the query plants in a tenth of the documents.

    With h the CRC-32 of the decimal doc_id and g = h // 10: if h is divisible by 10, each of the n words from
    a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8). Others, and null ids, stay.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
    h = F.crc32(doc_id.cast("string"))
    g, n = F.floor(h / 10), F.size(words)
    a = F.when(n > 0, F.pmod(g, F.greatest(n, F.lit(1)))).cast("int")
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("int")
    # one struct per text, so that the words are not split again for each of them
    given = F.transform(F.array(F.struct(words.alias("w"), a.alias("a"), p.alias("p"))), lambda s: F.array_join(
        F.transform(s["w"], lambda w, i: F.when(i < s["a"], w).otherwise(F.get(s["w"], s["a"] + (i - s["a"]) % s["p"]))), " "))
    return F.when((h % 10 == 0) & (n > 0), F.get(given, F.lit(0))).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, as digests and the longest one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = with_runs(docs.select("doc_id", planted_text(F.col("doc_id"), F.col("text")).alias("text"))).select(
        "doc_id", F.col("found.runs").alias("r"), F.col("found.collapsed").alias("c"), F.col("found.n_words").alias("n_words"))
    best = F.array_max(F.transform("r", lambda x: F.struct(x["length"].alias("l"), (-x["start"]).alias("s"), (-x["period"]).alias("p"))))
    line = F.transform("r", lambda x: F.concat(F.concat_ws(",", *[x[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return rows.withColumn("b", best).select(
        "doc_id", F.size("r").cast("long").alias("n_runs"), (-F.col("b.s")).alias("start"), F.col("b.l").alias("length"),
        (-F.col("b.p")).alias("period"), F.expr("1000 * b.l div -b.p").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("c", 256).alias("collapsed_sha256"), "n_words")

