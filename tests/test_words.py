"""Filters of words, and what they keep out of shuffles."""

import random

import numpy as np
from pyspark.sql import functions as F

from strandweave.functions import scaling
from strandweave.functions.words import WordFilter, word_hashes
from strandweave.operators import align, reference
from strandweave.operators.reference import find_patterns, reference_blocks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hashes_of_equal_words_are_equal():
    rng = random.Random(1)
    text = "".join(rng.choice("ACGTN$") for _ in range(400))
    for k in (1, 2, 7, 12, 16, 31, 84):
        hashes = word_hashes(np.frombuffer(text.encode(), np.uint8), k)
        again = word_hashes(np.frombuffer((text[150:] + "AC").encode(), np.uint8), k)
        words = [text[i:i + k] for i in range(len(text) - k + 1)]
        assert len(hashes) == len(words) and list(hashes[150:]) == list(again[:len(words) - 150])
        assert len(set(words)) == len({int(h) for h in hashes})
    assert not len(word_hashes(np.zeros(3, np.uint8), 7))


def test_seeds_meet_contexts_of_their_own_words_only(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ACGTN") for _ in range(n)) for n in (3500, 1000, 1020, 40, 9)]
    texts[1] = texts[0][1990:2990]
    blocks = reference_blocks(spark.createDataFrame([(i, f"c{i}", t) for i, t in enumerate(texts)], "contig_idx int, contig string, seq string"))
    k, reach = 16, 34
    sought = [texts[0][p:p + k] for p in (0, 965, 966, 999, 1000, 2100, 3484)] + [texts[3][-k:], "A" * k]
    words = spark.createDataFrame([(w,) for w in sought], "kmer string")
    want = {}
    for c, t in enumerate(texts):
        padded = "$" * reach + t + "$" * reach
        for p in range(len(t) - k + 1):
            want.setdefault(padded[p:p + 2 * reach + k], []).append((c << 32) + p + 1)
    every = align.seed_index(blocks, k, reach)
    assert {(r.context, r.locus, r.n_loci) for r in every.collect()} == {(c, min(v), len(v)) for c, v in want.items()}
    some = align.seed_index(blocks, k, reach, wanted=WordFilter(words, "kmer", k))
    assert plan(some).count("Exchange hashpartitioning") == 1 and "Join" not in plan(some)
    got = {(r.kmer, r.context, r.locus, r.n_loci) for r in some.collect()}
    assert got >= {(c[reach:reach + k], c, min(v), len(v)) for c, v in want.items() if c[reach:reach + k] in sought}
    assert len(got) < 60  # of thousands


def test_patterns_shuffle_places_of_their_words_only(spark, monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("ACGT") for _ in range(20_000))
    blocks = reference_blocks(spark.createDataFrame([(0, "c", text)], "contig_idx int, contig string, seq string"))
    patterns = spark.createDataFrame([(i, text[p:p + n]) for i, (p, n) in enumerate([(990, 30), (0, 12), (19_970, 30), (5, 13)])], "pattern_id int, pattern string")
    spots, plain = [], reference._spots_of
    monkeypatch.setattr(reference, "_spots_of", lambda *a: spots.append(plain(*a)) or spots[-1])
    got = sorted((r.pattern_id, r.pos) for r in find_patterns(blocks, patterns).collect())
    assert got == [(0, 991), (1, 1), (2, 19_971), (3, 6)]
    assert len(spots) == 2 and all(x.count() < 60 for x in spots)  # of 20,000 places


def test_stored_tables_leave_no_shuffle_files(spark):
    key = scaling._REMOVED
    with scaling.shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) in (None, "false")
    assert scaling.stored(spark.range(10).repartition(F.col("id")), "rows").count() == 10 and spark.conf.get(key, None) in (None, "false")
