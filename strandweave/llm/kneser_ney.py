"""Interpolated modified Kneser-Ney language model of word pairs, counted in Spark, stored as sorted hash arrays.

Training reads the texts twice. First every word's 64-bit hash is counted; the sorted hashes of a shard (their leading
bits) are an array in a file, and a word's number is its rank among all. Then pairs of neighbouring words are counted
under scrambled keys of their two numbers, again as sorted arrays by leading bits, so that frequent words spread over
all shards. Tasks send each shard their counts as packed sorted arrays, merged there; a pair or word of any frequency
is one entry a task. The number of shards follows the bytes of the texts.

Scoring maps the arrays into memory and searches them with the sorted distinct keys of a few megabytes of text at a
time. In a shared folder that is no mounted file system, the arrays are read shard by shard instead.

With c the count of a pair, s the sum over the pairs that begin with the same word, D a discount for counts of 1, 2 and
more (each order has its own, from the numbers of entries that occur 1 to 4 times), the probability of a word is
``max(c - D, 0) / s + g / s * p(word)``, where g is the sum of what was discounted; p(word) is the same over the number
of distinct words before it, mixed with a uniform share for each of the V known words and one for all unknown ones.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scaling import scratch_path
from .common import Memo, stored, table

#: Bytes of text for a shard of the model; bytes that a task works on at once; entries a task gathers before it sends.
SHARD_BYTES, CHUNK_BYTES, GATHERED = 16 << 20, 4 << 20, 3_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Discounts where the corpus has no entries that occur 1, 2, 3 or 4 times to estimate them from.
USUAL = (0.5, 1.0, 1.5)


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


#: Marks around a text; no word holds a blank.
BEGIN, END = _word_hash(b"begin "), _word_hash(b"end ")


# --- packed counts ----------------------------------------------------------

def pack(keys: np.ndarray, *counts: np.ndarray) -> bytes:
    """Sorted keys as differences, and columns of counts, by planes of bytes, compressed."""
    planes = [np.ascontiguousarray(np.asarray(c, "<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
              for c in (np.diff(keys, prepend=np.uint64(0)), *counts)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(columns, 8, -1)
    out = [np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def summed(keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Distinct sorted keys, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return [keys[first], *[np.add.reduceat(c[order], first) if len(keys) else c for c in counts]]


def _shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


class _Gathered:
    """Counts of a task, merged as they come, given out as rows (shard, data)."""

    def __init__(self, bits: int):
        self.bits, self.parts, self.size = bits, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > GATHERED:
            merged = summed(*map(np.concatenate, zip(*self.parts)))
            self.parts, self.size = [tuple(merged)], len(merged[0])
            if self.size > GATHERED // 2:
                yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            keys, counts = summed(*map(np.concatenate, zip(*self.parts)))
            self.parts, self.size = [], 0
            borders = np.searchsorted(_shard_of(keys, self.bits), np.arange((1 << self.bits) + 1))
            for shard, (a, b) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist())):
                if b > a:
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([pack(keys[a:b], counts[a:b])], pa.binary())],
                                                     ["shard", "data"])


# --- arrays in files --------------------------------------------------------

def _files(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:/", "file:///", 1))


def write_arrays(folder: str, *arrays: np.ndarray) -> str:
    """One new file of all arrays, one after the other."""
    uri = f"{folder}/{uuid.uuid4().hex}.bin"
    files, path = _files(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    with files.open_output_stream(path) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).tobytes())
    return uri


def read_array(uri: str, kind: str, at: int, n: int) -> np.ndarray:
    """An array of a file: mapped into memory where the file system is mounted, else read."""
    if not n:
        return np.zeros(0, kind)
    if uri.startswith(("/", "file:")):
        return np.memmap("/" + uri.removeprefix("file:").lstrip("/"), kind, "r", at, (n,))
    files, path = _files(uri)
    with files.open_input_file(path) as file:
        return np.frombuffer(file.read_at(n * np.dtype(kind).itemsize, at), kind)


@dataclass
class Table:
    """Sorted hash array in shards by leading bits: for each shard (file, entries, ranks before it, kind of the counts)."""
    bits: int
    shards: dict[int, tuple[str, int, int, str]]
    beside: dict[int, str] = field(default_factory=dict)  # files of further columns, by shard
    more: tuple[str, ...] = ()

    def find(self, keys: np.ndarray) -> list[np.ndarray]:
        """Rank of each sorted key (-1: not there), its count and its further columns (0: not there)."""
        rank, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.uint64)
        further = [np.zeros(len(keys), kind) for kind in self.more]
        borders = np.searchsorted(_shard_of(keys, self.bits), np.arange((1 << self.bits) + 1)).tolist()
        for shard, (uri, n, before, kind) in self.shards.items():
            a, b = borders[shard], borders[shard + 1]
            if a == b:
                continue
            have = read_array(uri, "<u8", 0, n)
            place = np.searchsorted(have, keys[a:b])
            hit = np.flatnonzero(have[np.minimum(place, n - 1)] == keys[a:b])
            place, hit = place[hit], a + hit
            rank[hit] = before + place
            count[hit] = read_array(uri, kind, 8 * n, n)[place]
            for k, column in enumerate(further):
                column[hit] = read_array(self.beside[shard], self.more[k], 8 * n * k, n)[place]
        return [rank, count, *further]


# --- texts ------------------------------------------------------------------

def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text in parts that end between words."""
    at = 0
    while len(data) - at > CHUNK_BYTES:
        end = at + CHUNK_BYTES
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def token_streams(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, bool, np.ndarray, np.ndarray]]:
    """(batch, whether this is its last stream, row of each token in the batch, hashes of the tokens).

    Each text's words come between BEGIN and END. The texts of a stream are about CHUNK_BYTES together; a longer one
    goes on in the next stream, which then begins with the token before it, given the row -1.
    """
    words = Memo(_word_hash, 150_000)
    for batch in batches:
        texts, last = batch.column(column), None
        parts: list[np.ndarray] = []
        rows: list[tuple[int, int]] = []
        size = 0

        def stream():
            nonlocal parts, rows, size
            out = (np.repeat([r for r, _ in rows], [n for _, n in rows]), np.concatenate(parts))
            parts, rows, size = [], [], 0
            return out

        for i in range(len(texts)):
            data = (texts[i].as_py() or "").encode().lower()
            for k, piece in enumerate(_pieces(data)):
                if size + len(piece) > CHUNK_BYTES and parts:
                    row, hashes = stream()
                    last = hashes[-1]
                    yield batch, False, row, hashes
                if k == 0:
                    parts.append(np.array([BEGIN], np.uint64))
                    rows.append((i, 1))
                elif not parts:
                    parts.append(np.array([last], np.uint64))
                    rows.append((-1, 1))
                found = piece.split()  # lower() and split() of bytes know ASCII only
                parts.append(np.fromiter(map(words.__getitem__, found), np.uint64, len(found)))
                rows.append((i, len(found)))
                size += len(piece) + 16
            parts.append(np.array([END], np.uint64))
            rows.append((i, 1))
        if parts:
            yield batch, True, *stream()


# --- training ---------------------------------------------------------------

@dataclass
class Model:
    words: Table  # columns: count, number of distinct words before it, sum and discounts of the pairs it begins
    pairs: Table  # column: count
    tokens: int
    vocabulary: int
    entries: int  # distinct words and BEGIN
    distinct_pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    uniform: float  # share of the uniform distribution in that of a word alone


def _scrambled(left: np.ndarray, right: np.ndarray, entries: int) -> np.ndarray:
    return (left.astype(np.uint64) * np.uint64(entries) + right.astype(np.uint64)) * _ODD


def _unscrambled(keys: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    plain = keys * np.uint64(pow(int(_ODD), -1, 1 << 64))
    return plain // np.uint64(entries), plain % np.uint64(entries)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """For counts of 1, 2 and more, from the numbers of entries with each count."""
    out = []
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    for k, (have, more) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1):
        d = k - (k + 1) * y * more / have if have else 0.0
        out.append(d if 0 < d < k else USUAL[k - 1])
    return tuple(out)


def _of_count(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(count, 3).astype(np.int64)]


def _count_kind(counts: np.ndarray) -> str:
    return "<u4" if not len(counts) or counts.max() < 1 << 32 else "<u8"


_SHARD = "shard int, uri string, n long, total long, n1 long, n2 long, n3 long, n4 long, data binary, kind string"


def _row(shard: int, uri: str | None, counts: np.ndarray, data: bytes | None = None, kind: str = "<u8") -> dict:
    few = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6) if len(counts) else np.zeros(6, np.int64)
    return {"shard": shard, "uri": uri, "n": len(counts), "total": int(counts.sum()) if len(counts) else 0,
            **{f"n{k}": int(few[k]) for k in range(1, 5)}, "data": data, "kind": kind}


def _merged(group: pd.DataFrame, columns: int) -> list[np.ndarray]:
    return summed(*map(np.concatenate, zip(*[unpack(d, columns) for d in group["data"]])))


def train(docs: DataFrame, text: str = "text", shard_bytes: int = SHARD_BYTES) -> Model:
    """The model of all texts of ``docs``; null texts are empty, repeated rows count each time, other columns are ignored.

    An empty table gives a model that knows no word. The driver gathers one row for each shard. More than 4.2 billion
    distinct words are refused, as the key of a pair would not be unique in 64 bits.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long") + 16)).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1.0, size / shard_bytes))))
    folder = scratch_path(spark, "model")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Gathered(bits)
        for _, _, rows, hashes in token_streams(batches, 0):
            keys, counts = np.unique(hashes[rows >= 0], return_counts=True)
            counts[keys == np.uint64(BEGIN)] = 0  # it has a number but is no token
            yield from gathered.add(keys, counts.astype(np.uint64))
        yield from gathered.rows()

    def merge_words(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(group, 2)
        return pd.DataFrame([_row(int(group["shard"].iloc[0]), write_arrays(folder, keys, counts), counts)])

    def per_shard(rows: DataFrame, merge, name: str) -> DataFrame:
        return stored(rows.groupBy("shard").applyInPandas(merge, _SHARD), name)

    packed = texts.mapInArrow(count_words, "shard int, data binary")
    found = sorted(map(tuple, per_shard(packed, merge_words, "words").select("shard", "uri", "n", "total").collect()))
    before = np.cumsum([0, *[n for _, _, n, _ in found]]).tolist()
    words = Table(bits, {shard: (uri, n, b, "<u8") for (shard, uri, n, _), b in zip(found, before)})
    entries = before.pop()  # the words of a shard have the numbers from before[...] on
    if entries >= 1 << 32:
        raise ValueError("more distinct words than the key of a pair can hold")

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Gathered(bits)
        for _, _, rows, hashes in token_streams(batches, 0):
            distinct, place = np.unique(hashes, return_inverse=True)
            ids = words.find(distinct)[0][place]
            second = np.flatnonzero(hashes[1:] != np.uint64(BEGIN)) + 1
            keys, counts = np.unique(_scrambled(ids[second - 1], ids[second], entries), return_counts=True)
            yield from gathered.add(keys, counts.astype(np.uint64))
        yield from gathered.rows()

    def merge_pairs(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(group, 2)
        kind = _count_kind(counts)
        out = [_row(int(group["shard"].iloc[0]), write_arrays(folder, keys, counts.astype(kind)), counts, kind=kind)]
        left, right = _unscrambled(keys, entries)
        one = lambda of: of.astype(np.uint64)
        nothing, ones = np.zeros(len(keys), np.uint64), np.ones(len(keys), np.uint64)
        merged = summed(np.concatenate([left, right]), np.concatenate([nothing, ones]), np.concatenate([counts, nothing]),
                        *[np.concatenate([one(c), nothing]) for c in (counts == 1, counts == 2, counts > 2)])
        borders = [*np.searchsorted(merged[0], np.array(before, np.uint64)).tolist(), len(merged[0])]
        for shard, a, b in zip(words.shards, borders[:-1], borders[1:]):
            if b > a:
                out.append(_row(shard, None, np.zeros(0, np.uint64), pack(*[c[a:b] for c in merged])))
        return pd.DataFrame(out)

    pairs_found = per_shard(texts.mapInArrow(count_pairs, "shard int, data binary"), merge_pairs, "pairs")
    pair_rows = pairs_found.filter("uri is not null").drop("data").collect()
    few = discounts(*[sum(r[f"n{k}"] for r in pair_rows) for k in range(1, 5)])
    pairs = Table(bits, {r["shard"]: (r["uri"], r["n"], 0, r["kind"]) for r in pair_rows})

    def merge_stats(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        _, n, first, _ = words.shards[shard]
        ids, prior, total, *each = _merged(group, 6)
        place = (ids - np.uint64(first)).astype(np.int64)
        columns = [np.zeros(n, "<u8"), np.zeros(n, "<u8"), np.zeros(n, "<f8")]
        columns[0][place], columns[1][place] = prior, total
        columns[2][place] = sum(d * e for d, e in zip(few, each))
        return pd.DataFrame([_row(shard, write_arrays(folder, *columns), columns[0])])

    stats = per_shard(pairs_found.filter("uri is null").select("shard", "data"), merge_stats, "stats").drop("data").collect()
    words.beside, words.more = {r["shard"]: r["uri"] for r in stats}, ("<u8", "<u8", "<f8")
    after = [sum(r[f"n{k}"] for r in stats) for k in range(1, 5)]
    total, distinct, vocabulary, once = sum(f[3] for f in found), sum(r["n"] for r in pair_rows), max(0, entries - 1), discounts(*after)
    # what the discounts leave of the distinct pairs, for all words alike; every known word has some word before it
    left_over = once[0] * after[0] + once[1] * after[1] + once[2] * (vocabulary - after[0] - after[1])
    return Model(words, pairs, total, vocabulary, entries, distinct, few, once, left_over / distinct if distinct else 1.0)


# --- scoring ----------------------------------------------------------------

SCORES = "n_tokens long, n_known long, base_score double, score double"


def log_probabilities(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known, base, score) of every token of a stream but its first; those of BEGIN mean nothing."""
    distinct, place = np.unique(hashes, return_inverse=True)
    ids, count, prior, total, held = (c[place] for c in model.words.find(distinct))
    base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
    word = (np.maximum(prior - _of_count(prior, model.word_discounts), 0) / max(1, model.distinct_pairs)
            + model.uniform / (model.vocabulary + 1))
    left, right = ids[:-1], ids[1:]
    both = np.flatnonzero((left >= 0) & (right >= 0))
    keys, back = np.unique(_scrambled(left[both], right[both], model.entries), return_inverse=True)
    pair = np.zeros(len(left), np.uint64)
    pair[both] = model.pairs.find(keys)[1][back]
    below = total[:-1].astype(float)
    seen = below > 0
    of = np.where(seen, below, 1.0)
    mixed = np.where(seen, np.maximum(pair - _of_count(pair, model.pair_discounts), 0) / of + held[:-1] / of * word[1:], word[1:])
    return count[1:] > 0, base[1:], np.log10(mixed)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds n_tokens, n_known, base_score and score (log10 probability of the text) to every row.

    A null text is empty: its only token is the end. Columns of these names are replaced; rows are scored one by one,
    so repeated rows get equal scores.
    """
    kept = [c for c in docs.columns if c not in ("n_tokens", "n_known", "base_score", "score")]
    given = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = T.StructType([*docs.select(*kept).schema.fields, *T.StructType.fromDDL(SCORES).fields])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch, last, rows, hashes in token_streams(batches, len(kept)):
            if sums is None:
                sums = np.zeros((4, batch.num_rows))
            known, base, full = log_probabilities(model, hashes)
            real = np.flatnonzero((hashes[1:] != np.uint64(BEGIN)) & (rows[1:] >= 0))
            for k, value in enumerate((np.ones(len(real)), known[real], base[real], full[real])):
                sums[k] += np.bincount(rows[1:][real], value, batch.num_rows)
            if last:
                whole = [pa.array(x.astype(np.int64)) for x in sums[:2]]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *whole, *map(pa.array, sums[2:])], schema.names)
                sums = None

    return given.mapInArrow(scored, schema)


def held_out(doc_id: str = "doc_id"):
    """Whether the CRC-32 of the decimal id leaves 1 when divided by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(False))


def op12_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model of those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out())
    model = train(docs.filter(~F.col("held_out")))
    rows = score(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
                       F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
