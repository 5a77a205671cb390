"""Chunk numbers for reads and alignments, as columns rather than as files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scaling import dense_ordinal, running_total


def chunk_reads(df: DataFrame, n: int, keys: list | None = None) -> DataFrame:
    """``chunk = floor(ordinal / n)``; the last chunk may be short.

    A reader's ``ordinal`` is used when present, else rows are numbered by
    ``keys``. Two mate tables with the same names get the same chunks.
    """
    if n < 1:
        raise ValueError("entries per chunk must be positive")
    if keys is not None:
        df = dense_ordinal(df, *keys)
    return df.withColumn("chunk", F.floor(F.col("ordinal") / F.lit(n)).cast("bigint"))


def chunk_alignments(df: DataFrame, n: int, keys: list | None = None) -> DataFrame:
    """As ``chunk_reads``; ``n = 0`` keeps everything in one chunk."""
    if n == 0:
        return df.withColumn("chunk", F.lit(0).cast("bigint"))
    return chunk_reads(df, n, keys)


def header_per_chunk(header: DataFrame, chunked: DataFrame) -> DataFrame:
    """The header lines repeated for every chunk (columns of ``header`` plus ``chunk``)."""
    last = chunked.agg(F.max("chunk")).first()[0]
    if last is None:
        return header.withColumn("chunk", F.lit(0).cast("bigint")).limit(0)
    return header.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))))


def chunk_by_bytes(df: DataFrame, k: int, keys: list, line: str = "line") -> DataFrame:
    """About ``k`` chunks of equal bytes; a record lies in the chunk where it starts."""
    if k < 1:
        raise ValueError("the number of chunks must be positive")
    rows = running_total(df, *keys, weight=F.octet_length(line) + 1)
    return rows.withColumn("chunk", F.floor(F.col("offset") * k / F.col("total")).cast("bigint")) \
        .drop("total")
