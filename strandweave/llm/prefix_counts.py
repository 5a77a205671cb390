"""Exact token counts of every prefix of a text, by prefix dynamic programming.

In byte-pair encoding the last token of a prefix depends only on which token may follow which: a sequence is the
encoding of its bytes exactly if each neighbouring pair encodes to itself. So the state of a prefix of i bytes is
its last token, found from the states of shorter prefixes, and its count is the shorter one's plus one. The states
are computed once per distinct piece (the vocabulary's own pattern cuts texts into pieces) and joined to texts.

Stored per text: one signed byte per code point, the change of the count at that prefix (a longer prefix may need
fewer tokens). Running sums of these answer how long any prefix is and where a budget ends, without encoding.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, table, tokenizer_path

PREFIX_TYPE = "struct<n_tokens:long,steps:binary>"
_ARROW = pa.struct([("n_tokens", pa.int64()), ("steps", pa.binary())])
#: Splits text into pieces, as byte-level BPE vocabularies of this family fix it.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond these characters the library's own splitting is used, so that its tables of letters decide.
_UNUSUAL = re.compile("[^\x00-ʯ ά-ώА-я‐-‧一-龥]")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 as itself, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class PrefixCounter:
    """Prefix counts under one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        spec = json.load(open(path, encoding="utf-8"))
        letters = byte_letters()
        raw = lambda t: bytes(letters[c] for c in t)
        added = [t["content"] for t in spec["added_tokens"]]
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {(raw(a), raw(b)): r for r, (a, b) in enumerate(pairs)}
        self.longest: dict[bytes, int] = {}  # length of the longest token with these last three bytes
        for token in self.ids:
            if len(token) > 2:
                self.longest[token[-3:]] = max(len(token), self.longest.get(token[-3:], 0))
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.find = regex.compile(PIECES).findall
        self.spaces = regex.compile(r"\s\s+(?=\S)").finditer
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.follows = Memo(lambda ab: self._merge(ab[0] + ab[1]) == [ab[0], ab[1]], 1_000_000)
        self.alone = Memo(lambda t: self._merge(t) == [t], 200_000)
        self.steps_of = Memo(self._word_steps)

    def _merge(self, data: bytes) -> list[bytes]:
        """Plain byte-pair merging, for pairs of tokens only."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(ab, 1 << 60), i) for i, ab in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def byte_counts(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of one piece, from 0 bytes on."""
        counts, last = [0], [b""]
        ids, follows, longest = self.ids, self.follows, self.longest.get
        for i in range(1, len(piece) + 1):
            reach = longest(piece[i - 3:i], 2) if i > 2 else 2
            for j in range(i - reach if i > reach else 0, i):
                token = piece[j:i]
                if token in ids and (follows[last[j], token] if j else self.alone[token]):
                    counts.append(counts[j] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token for byte {piece[i - 1]}")
        return counts

    def _char_counts(self, piece: str) -> list[int]:
        if piece in ("'re", "'ve", "'ll"):  # two characters of these are two pieces
            return [0, self._char_counts("'")[1], self._char_counts("'")[1] + self._char_counts(piece[1])[1],
                    self.byte_counts(piece.encode())[-1]]
        data = piece.encode()
        counts = self.byte_counts(data)
        if len(data) == len(piece):
            return counts
        return [0] + [counts[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]

    def _word_steps(self, piece: str) -> bytes:
        counts = self._char_counts(piece)
        steps = [b - a for a, b in zip(counts, counts[1:])]
        if min(steps) < -128 or max(steps) > 127:
            raise ValueError("a count changes by more than a signed byte holds")
        return bytes([s & 255 for s in steps])

    @staticmethod
    def _packed(steps: np.ndarray) -> bytes:
        if len(steps) and (steps.min() < -128 or steps.max() > 127):
            raise ValueError("a count changes by more than a signed byte holds")
        return steps.astype(np.int8).tobytes()

    def pieces(self, text: str) -> list[str]:
        if _UNUSUAL.search(text):
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return self.find(text)

    def _ordinary(self, text: str) -> bytes:
        steps = b"".join(map(self.steps_of.__getitem__, self.pieces(text)))
        # white space before a word loses its last character to the word (or a piece of its own), but a prefix
        # that ends with the white space still has it as one piece
        out, count = None, lambda piece: self._char_counts(piece)[-1]
        for m in self.spaces(text):
            run, at = m[0], m.end() - 1
            if more := count(run) - count(run[:-1]) - count(run[-1]):
                out = np.frombuffer(steps, np.int8).astype(np.int64) if out is None else out
                out[at] += more
                out[at + 1] -= more
        return steps if out is None else self._packed(out)

    def steps(self, text: str) -> bytes:
        """Change of the token count at each code point; their sum is the text's count."""
        parts, at = [], 0
        for m in self.added.finditer(text) if self.added else ():
            before, inside = text[at:m.start()], self._ordinary(text[at:m.end() - 1])
            done = int(np.frombuffer(inside, np.int8)[:len(before)].sum())
            parts += [inside, self._packed(np.array([done + 1 - int(np.frombuffer(inside, np.int8).sum())]))]
            at = m.end()
        return b"".join([*parts, self._ordinary(text[at:])]) if parts else self._ordinary(text)


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def with_prefix_counts(docs: DataFrame, text: str = "text", out: str = "prefix",
                       tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Adds ``out``: the number of tokens and the steps of every prefix. A null text counts as empty.

    Strings of added tokens inside texts count as one token, as the library has it; nothing is added around them.
    One row per row; a column named like ``out`` is replaced.
    """
    path = tokenizer_path(tokenizer)

    @F.arrow_udf(PREFIX_TYPE)
    def counted(texts: pa.Array) -> pa.Array:
        counter = _counter(path)
        steps = [counter.steps(t or "") for t in texts.to_pylist()]
        return pa.array([{"n_tokens": int(np.frombuffer(s, np.int8).sum(dtype=np.int64)), "steps": s} for s in steps], _ARROW)

    return docs.withColumn(out, counted(F.col(text)))


@F.arrow_udf(T.LongType())
def tokens_of_prefix(steps: pa.Array, chars: pa.Array) -> pa.Array:
    """Tokens of the first ``chars`` code points (all, if the text is shorter), from the stored steps."""
    return pa.array([None if s is None or n is None else int(np.frombuffer(s, np.int8)[:max(0, n)].sum(dtype=np.int64))
                     for s, n in zip(steps.to_pylist(), chars.to_pylist(), strict=True)], pa.int64())


@F.arrow_udf(T.LongType())
def chars_within(steps: pa.Array, budget: pa.Array) -> pa.Array:
    """Length in code points of the longest prefix that needs at most ``budget`` tokens."""
    out = []
    for s, n in zip(steps.to_pylist(), budget.to_pylist(), strict=True):
        fits = None if s is None or n is None else np.flatnonzero(
            np.concatenate([[0], np.cumsum(np.frombuffer(s, np.int8), dtype=np.int64)]) <= n)
        out.append(None if fits is None else int(fits[-1]) if len(fits) else 0)
    return pa.array(out, pa.int64())


def truncated(docs: DataFrame, budget: int, text: str = "text", prefix: str = "prefix") -> DataFrame:
    """The texts cut to the longest prefix within the budget; rows need their prefix counts."""
    cut: Column = chars_within(F.col(prefix)["steps"], F.lit(budget).cast("long")).cast("int")
    return docs.withColumn(text, F.when(F.col(prefix)["n_tokens"] > budget, F.substring(F.col(text), F.lit(1), cut))
                           .otherwise(F.col(text)))


def op3_prefix_counts(spark: SparkSession, sf_dir: str, limit: int = 1024) -> DataFrame:
    """Token counts of every whole text of ``documents``."""
    docs = with_prefix_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col("prefix.n_tokens").alias("n_tokens"), (F.col("prefix.n_tokens") > limit).alias("over_limit"))
