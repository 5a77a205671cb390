"""Small helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scaling import scratch_path

#: A word, everywhere in this folder: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage through a Parquet table in the folder of ``spark.checkpoint.dir``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_text_key(docs: DataFrame, text: str = "text", key: str = "text_key") -> DataFrame:
    """Adds a 128-bit key of the text (null counts as empty), so equal texts are worked on once."""
    return docs.withColumn(key, F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))


def first_seen(rows: DataFrame, key: str, columns: list[str], remember: int = 200_000) -> DataFrame:
    """Drops rows whose key this task has already passed on.

    Thins repeated texts before a shuffle, so that one hot key sends about one row per task. A task forgets
    its oldest keys beyond ``remember``: what follows must expect some repeated keys.
    """
    kept = rows.select(key, *[c for c in columns if c != key])

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, older = set(), set()
        for batch in batches:
            fresh = []
            for i, k in enumerate(batch.column(0).to_pylist()):
                if k not in seen and k not in older:
                    seen.add(k)
                    fresh.append(i)
                    if len(seen) > remember // 2:
                        seen, older = set(), seen
            yield batch.take(pa.array(fresh, pa.int64()))

    return kept.mapInArrow(thin, kept.schema)


class Memo(dict):
    """Dictionary filled on demand by ``make(key)``; of more than ``limit`` entries those not used lately go.

    Keys of over ``LONGEST`` characters or bytes are made anew each time, and the kept ones have at most
    ``limit_bytes`` together, so that texts of long unbroken runs cannot fill a worker.
    """

    LONGEST = 512

    def __init__(self, make, limit: int = 400_000, limit_bytes: int = 32 << 20):
        super().__init__()
        self.make, self.half, self.older = make, limit // 2, {}
        self.half_bytes, self.held = limit_bytes // 2, 0

    def __missing__(self, key):
        size = len(key) if isinstance(key, (str, bytes)) else 0
        if size > self.LONGEST:
            return self.make(key)
        value = self.older.pop(key, self)
        if value is self:
            value = self.make(key)
        self.held += size
        if len(self) >= self.half or self.held > self.half_bytes:
            self.older, self.held = dict(self), size
            self.clear()
        self[key] = value
        return value


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file: a path stays, a bare name is looked up among the installed ones."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)
