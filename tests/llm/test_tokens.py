import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandweave.llm import chunk_bpe, prefix_counts
from strandweave.llm.common import tokenizer_path

from .data import DOCS, clashing, documents, words

PARTS = ["a", "'", "'re", "'ll", "'s", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", " ", "é", "é", "ß", "漢字", "🙂", "1",
         "²", "!", "<|endoftext|>", "<|startoftext|>", "<|", "<|ENDOFTEXT|>", "Ö", "the", " and", "İ", "Σ", "ΟΔΟΣ", "​", "Abc,", "x."]


def mixed(r, n):
    return "".join(r.choice(PARTS) for _ in range(r.randrange(n)))


def encoded(name, texts):
    return [e.ids for e in Tokenizer.from_file(tokenizer_path(name)).encode_batch(texts, add_special_tokens=False)]


def test_every_prefix_count_is_the_librarys():
    r, counter = random.Random(3), prefix_counts.PrefixCounter(tokenizer_path("byte_bpe_50k.json"))
    for text in [mixed(r, 14) for _ in range(2000)] + [words(60, 1), "", "a" * 300, " " * 40 + "x"]:
        want = [len(x) for x in encoded("byte_bpe_50k.json", [text[:i] for i in range(1, len(text) + 1)])]
        assert np.cumsum(np.frombuffer(counter.steps(text), np.int8)).tolist() == want, text


def test_budgets_without_encoding(spark):
    docs = clashing(documents(spark), ["prefix"])
    rows = prefix_counts.with_prefix_counts(docs)
    assert rows.columns == docs.columns and rows.count() == docs.count()
    cut = prefix_counts.truncated(rows, 20).select("text", "prefix.n_tokens", F.col("prefix.steps").alias("s"))
    part = rows.select("text", prefix_counts.tokens_of_prefix(F.col("prefix.steps"), F.lit(33).cast("long")).alias("n"))
    for r in part.collect():
        assert r["n"] == len(encoded("byte_bpe_50k.json", [(r["text"] or "")[:33]])[0])
    for r in cut.collect():
        assert r["text"] is None or len(encoded("byte_bpe_50k.json", [r["text"]])[0]) <= 20
    assert prefix_counts.with_prefix_counts(spark.createDataFrame([], DOCS)).count() == 0


def test_counts_query(spark, tmp_path):
    documents(spark, [(9, words(2000, 8), "en", "a", 0)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in
                 prefix_counts.op3_prefix_counts(spark, str(tmp_path)).collect())
    texts = [(r["doc_id"] or 0, r["text"] or "") for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    counts = map(len, encoded("byte_bpe_50k.json", [t for _, t in texts]))
    assert got == sorted((i, len(t.encode()), n, n > 1024) for (i, t), n in zip(texts, counts))


def test_chunks_join_exactly():
    r, encoder = random.Random(4), chunk_bpe.Encoder(tokenizer_path("word_bpe_49k.json"))
    for text in [mixed(r, 3000) for _ in range(60)] + ["", "a" * 5000, " " * 5000, words(3000, 2), "ab" * 4000]:
        parts = chunk_bpe.chunks(text)
        assert "".join(parts) == text
        got = encoder.assemble([encoder.chunk(p) for p in parts])
        assert got.tolist() == encoded("word_bpe_49k.json", [text])[0]


def test_cuts_follow_the_content():
    passage = words(3000, 7)
    one, two = chunk_bpe.chunks(words(40, 1) + " " + passage), chunk_bpe.chunks(words(75, 2) + " " + passage)
    assert len(set(one) & set(two)) > len(one) // 2


def shared_texts(spark):
    passage = words(1500, 11, 3000)
    near = [(100 + i, f"{words(20 + i, i)} {passage} {words(10, 50 + i)}", "en", "a", 0) for i in range(6)]
    return documents(spark, near)


def test_shared_chunks_are_encoded_once(spark):
    texts = chunk_bpe.with_text_key(shared_texts(spark)).selectExpr("text_key", "coalesce(text, '') text")
    roles = chunk_bpe.shared_chunks(texts)
    pieces = chunk_bpe.encode_chunks(texts, roles, tokenizer_path("word_bpe_49k.json"))
    assert pieces.filter("shared").groupBy("chunk_key").count().filter("count > 1").count() == 0
    assert pieces.filter("shared").count() > 3
    needed = roles.selectExpr("explode(need) k").distinct()
    assert needed.join(pieces.filter("shared"), F.col("k") == F.col("chunk_key"), "left_anti").count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_encoding_query(spark, tmp_path, empty):
    docs = spark.createDataFrame([], DOCS) if empty else shared_texts(spark)
    clashing(docs, ["n_tokens", "text_key"]).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"] or 0, *r[1:]) for r in chunk_bpe.op6_chunk_reuse(spark, str(tmp_path)).collect())
    library, sha = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"] or 0, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want)
