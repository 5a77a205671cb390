"""BPE encoding with content-defined chunks, each encoded once.

A rolling hash of the characters cuts texts where their content says so, hence texts that share a passage share
chunks. Chunks found in more than one text are encoded where the first of them (by key) is; the others receive the
tokens. All other chunks are encoded in place and never move. Words cut by a chunk border are repaired: they are
encoded again together with more and more whole words of both sides, until the outer words' tokens come out as in
the chunks themselves.

Equal texts are worked on once, so null and repeated ids do no harm; what moves is each distinct text once, the keys
of chunks, and the tokens of texts that share chunks.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memo, first_seen, stored, table, tokenizer_path, with_text_key

#: A cut about every 2**CUT_BITS characters, none within LEAST of the one before; words kept on each edge of a piece.
CUT_BITS, LEAST, EDGE_WORDS = 10, 256, 4
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
_SPACE = re.compile("[ \t\n\v\f\r]")
#: Texts of these characters only have one composed form and lower case whatever the context.
_PLAIN = re.compile("[\x00-\x7f\xc0-\xff]*")
_STOP = re.compile("(?<=[a-z\xdf-\xf6\xf8-\xff])([,.])(?= )")


def cut_points(text: str) -> list[int]:
    """Ends of the chunks of a text, the last one being its length."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    h = _GEAR[(codes ^ (codes >> 8)) & 255]
    for width in (1, 2, 4, 8):  # now each hash covers 2, 4, 8, 16 characters
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h = wider
    cuts = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    ends, at = [], 0
    while (k := np.searchsorted(cuts, at + LEAST)) < len(cuts):
        at = int(cuts[k])
        ends.append(at)
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return ends


def chunks(text: str) -> list[str]:
    ends = cut_points(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def chunk_key(chunk: str) -> bytes:
    return xxhash.xxh3_128_digest(chunk.encode())


class Encoder:
    """Encodes chunks with a tokenizers file whose pre-tokenizer never joins across ASCII white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.names = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(size)]
        self.numbers = [b"%d" % i for i in range(size)]
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.lowers = self.whole("ÀB, C.") == self.whole("àb , c .")
        self.word = Memo(lambda w: self.whole(w) if w else b"", 160_000)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def words(self, text: str) -> bytes:
        """Tokens of words between spaces; fewer distinct ones are met if case and stops, which the vocabulary's own rules
        lower and split off anyway, go first. Strings of added tokens keep their case."""
        if self.lowers and "<|" not in text and _PLAIN.fullmatch(text):
            text = _STOP.sub(r" \1", text.lower())
        return b"".join(map(self.word.__getitem__, text.split(" ")))

    def chunk(self, text: str) -> dict:
        """A piece: tokens of the words wholly inside, and the edges needed to join it to its neighbours."""
        first, last = _SPACE.search(text), _last_space(text)
        if first is None:
            return {"head": text, "tail": None, "ids": b""}
        inside = _spaced(text[first.end():last + 1])
        left = inside.split(" ", 2 * EDGE_WORDS)[:2 * EDGE_WORDS]
        right = inside.rsplit(" ", 2 * EDGE_WORDS)[-2 * EDGE_WORDS:]
        left, right = [w for w in left if w][:EDGE_WORDS], [w for w in right if w][-EDGE_WORDS:]
        return {"head": " ".join([text[:first.start()], *left]), "tail": " ".join([*right, text[last + 1:]]),
                "ids": self.words(inside)}

    def join(self, left: list[str], middle: str, right: list[str]) -> bytes:
        """Tokens of the characters around a border, agreed on with the whole words beside them."""
        if not middle:
            return b""
        for n in range(1, EDGE_WORDS + 1):
            a, b = left[-n:], right[:n]
            before, after = b"".join(map(self.word.__getitem__, a)), b"".join(map(self.word.__getitem__, b))
            both = self.whole(" ".join([*a, middle, *b]))
            if both.startswith(before) and both.endswith(after) and len(both) >= len(before) + len(after):
                return both[len(before):len(both) - len(after)]
        raise ValueError("this vocabulary joins text across white space")

    def assemble(self, pieces: list[dict]) -> np.ndarray:
        """The tokens of a text from its chunks' pieces in order."""
        out, left, open_word = [], [], ""
        for p in pieces:
            if p["tail"] is None:  # no white space in the chunk: the word goes on
                open_word += p["head"]
                continue
            head, *right = p["head"].split(" ")
            out += [self.join(left, open_word + head, right), p["ids"]]
            *left, open_word = p["tail"].split(" ")
        out.append(self.join(left, open_word, []))
        return np.frombuffer(b"".join(out), self.kind)

    def digest(self, ids: np.ndarray) -> tuple[int, str, str]:
        """Number of tokens, digest of the decimal ids, digest of the decoded text."""
        ids = ids.tolist()
        numbers, names = b" ".join(map(self.numbers.__getitem__, ids)), b" ".join(map(self.names.__getitem__, ids))
        return len(ids), hashlib.sha256(numbers).hexdigest(), hashlib.sha256(names).hexdigest()


def _spaced(text: str) -> str:
    """ASCII white space as spaces."""
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return text


def _last_space(text: str) -> int:
    return max(text.rfind(c) for c in " \t\n\v\f\r")


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_REFS = pa.schema([("text_key", pa.binary()), ("chunk_key", pa.binary())])
_PIECES = pa.schema([("text_key", pa.binary()), ("seq", pa.int32()), ("chunk_key", pa.binary()), ("shared", pa.bool_()),
                     ("head", pa.string()), ("tail", pa.string()), ("ids", pa.binary()), ("n_tokens", pa.int64()),
                     ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
PIECES = ("text_key binary, seq int, chunk_key binary, shared boolean, head string, tail string, ids binary, "
          "n_tokens long, ids_sha256 string, decoded_sha256 string")
_DONE = pa.schema([_PIECES.field(n) for n in ("text_key", "n_tokens", "ids_sha256", "decoded_sha256")])


def shared_chunks(texts: DataFrame) -> DataFrame:
    """(text_key, own, need): per text that shares chunks, those it encodes for all and those it receives.

    Texts may be repeated; a task cuts those that it remembers only once.
    """
    def refs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Memo(lambda _: False, 100_000)
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), []
            for key, text in zip(keys, batch.column(1).to_pylist(), strict=True):
                if not seen[key]:
                    seen[key] = True
                    rows += [(key, c) for c in {chunk_key(c) for c in chunks(text or "")}]
            yield _batch(rows, _REFS)

    found = stored(texts.select("text_key", "text").mapInArrow(refs, "text_key binary, chunk_key binary"), "chunk-refs")
    # stored, so that the join below has two plain shuffles, of which a hot chunk's rows can be split
    shared = stored(found.groupBy("chunk_key").agg(F.min("text_key").alias("owner"), F.max("text_key").alias("_other"))
                    .filter("owner <> _other").drop("_other"), "shared-chunks")
    roles = found.join(shared, "chunk_key")
    mine = F.col("owner") == F.col("text_key")
    return roles.groupBy("text_key").agg(F.collect_set(F.when(mine, F.col("chunk_key"))).alias("own"),
                                         F.collect_set(F.when(~mine, F.col("chunk_key"))).alias("need"))


def encode_chunks(texts: DataFrame, roles: DataFrame, path: str) -> DataFrame:
    """Rows of three kinds: finished texts (n_tokens set), pieces of texts that wait for others' chunks (seq set; ids
    null where one is awaited), and pieces encoded for others (shared)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = _encoder(path), None
        for batch in batches:
            rows = []
            for key, text, own, need in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == before:  # the same text from another task
                    continue
                before, own, need = key, set(own or ()), set(need or ())
                parts, pieces, seen = chunks(text or ""), [], {}
                for part in parts:
                    name = chunk_key(part) if own or need else part
                    if name in need:
                        pieces.append((name, None))
                    else:
                        if name not in seen:
                            seen[name] = encoder.chunk(part)
                            if name in own:
                                p = seen[name]
                                rows.append((None, None, name, True, p["head"], p["tail"], p["ids"], None, None, None))
                        pieces.append((name, seen[name]))
                if need:
                    rows += [(key, i, name if p is None else None, False, *((None,) * 3 if p is None else (p["head"], p["tail"], p["ids"])),
                              None, None, None) for i, (name, p) in enumerate(pieces)]
                else:
                    rows.append((key, None, None, False, None, None, None, *encoder.digest(encoder.assemble([p for _, p in pieces]))))
            yield _batch(rows, _PIECES)

    # a merge join at every size: broadcasting the roles of small inputs would only hide what larger ones move
    joined = texts.hint("merge").join(roles, "text_key", "left").select("text_key", "text", "own", "need")
    return joined.mapInArrow(encode, PIECES)


def encoded_digests(docs: DataFrame, text: str = "text", tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """(text_key, n_tokens, ids_sha256, decoded_sha256) of every distinct text of ``docs``; null counts as empty."""
    path = tokenizer_path(tokenizer)
    keyed = with_text_key(docs, text).select("text_key", F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = first_seen(keyed, "text_key", ["text"])
    pieces = stored(encode_chunks(texts, stored(shared_chunks(keyed), "chunk-roles"), path), "chunk-pieces")
    for_all = stored(pieces.filter("shared").select("chunk_key", "head", "tail", "ids").dropDuplicates(["chunk_key"]),
                     "shared-pieces")
    waiting = pieces.filter("seq is not null")
    here = ["text_key", "seq", "head", "tail", "ids"]
    complete = (waiting.filter("chunk_key is not null").select("text_key", "seq", "chunk_key")
                .join(for_all, "chunk_key").select(*here)
                .unionByName(waiting.filter("chunk_key is null").select(*here)))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, key, parts = _encoder(path), None, {}
        finished = lambda: (key, *encoder.digest(encoder.assemble([parts[i] for i in sorted(parts)])))
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["text_key"] != key:
                    if parts:
                        rows.append(finished())
                    key, parts = row["text_key"], {}
                parts[row["seq"]] = row
            yield _batch(rows, _DONE)
        if parts:
            yield _batch([finished()], _DONE)

    joined = (complete.repartition("text_key").sortWithinPartitions("text_key", "seq")
              .mapInArrow(assemble, "text_key binary, n_tokens long, ids_sha256 string, decoded_sha256 string"))
    alone = pieces.filter("n_tokens is not null").select(*joined.columns)
    return stored(alone.unionByName(joined).dropDuplicates(["text_key"]), "digests")


def op6_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and decoded text of every whole text of ``documents``, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (with_text_key(docs).select("doc_id", "text_key").join(encoded_digests(docs), "text_key")
            .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
