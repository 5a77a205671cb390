import hashlib

from tokenizers import Tokenizer

import corpus_pipeline
from strandweave.llm import mixing, pii
from strandweave.llm.common import tokenizer_path

from . import test_forest_join, test_quality
from .data import DOCS, words


def corpus(spark):
    extra = [(7000, words(100, 77) + " mail a.b@c.org or +49 30 1234567", "en", "b", 1), (7001, "", "en", "b", 1)]
    return (test_quality.docs(spark).unionByName(test_forest_join.near(spark))
            .unionByName(spark.createDataFrame(extra, DOCS)))


def test_stages(spark, tmp_path):
    corpus(spark).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    results = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        results.append((before, docs.collect()))
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    key = lambda r: (r["doc_id"] or 0, r["text"] or "")
    before, after = results[0]
    assert {key(r) for r in after} < {key(r) for r in before} and all(test_quality.counts(r["text"])[0] >= 50 for r in after)
    before, after = results[1]
    assert sorted(r["doc_id"] or 0 for r in after) == sorted({c or 0 for _, c, *_ in test_forest_join.brute(before)})
    before, after = results[2]
    assert len(after) == len(before) and not any(pii.proposals(r["text"])[k] for r in after for k in pii.BASE_KINDS)
    assert any("[EMAIL] or [PHONE]" in r["text"] for r in after)
    before, after = results[3]
    size = lambda rows: sum(len(r["text"].encode().split()) for r in rows)
    assert abs(size(after) - mixing.SHARE * size(before)) < 4 * 6000 and {key(r) for r in after} <= {key(r) for r in before}
    before, after = results[4]
    library, sha = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [(r["doc_id"] or 0, library.encode(r["text"], add_special_tokens=False).ids) for r in before]
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after) == sorted(
        (i, len(x), sha(" ".join(map(str, x))), sha(library.decode(x, skip_special_tokens=False))) for i, x in ids)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
