import math
import random
import zlib
from collections import Counter

import pytest

from strandweave.llm import kneser_ney as kn

from .data import DOCS, clashing, documents, words


def tokens(text):
    return (text or "").encode().lower().split()


class Plain:
    """The model by its formulas, with dictionaries."""

    def __init__(self, texts):
        self.pairs, self.words = Counter(), Counter()
        for t in map(tokens, texts):
            self.words.update([*t, None])
            self.pairs.update(zip(["<"] + t, t + [None]))
        self.before = Counter(b for _, b in self.pairs)
        self.total = Counter()
        for (a, _), c in self.pairs.items():
            self.total[a] += c
        self.d2, self.d1 = self.discounts(self.pairs), self.discounts(self.before)
        self.held = Counter()
        for (a, _), c in self.pairs.items():
            self.held[a] += self.d2[min(c, 3) - 1]

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        d = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0 for k in (1, 2, 3)]
        return [x if 0 < x < k + 1 else u for k, (x, u) in enumerate(zip(d, (0.5, 1.0, 1.5)))]

    def word(self, b):
        n = len(self.pairs)
        if not n:
            return 1.0
        left = sum(self.d1[min(c, 3) - 1] for c in self.before.values())
        c = self.before[b]
        return (c - self.d1[min(c, 3) - 1] if c else 0) / n + left / n / (len(self.words) + 1)

    def probability(self, a, b):
        s, c = self.total[a], self.pairs[a, b]
        if not s:
            return self.word(b)
        return (c - self.d2[min(c, 3) - 1] if c else 0) / s + self.held[a] / s * self.word(b)

    def scores(self, text):
        t, n, v = tokens(text), sum(self.words.values()), len(self.words)
        base = sum(math.log10((self.words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*t, None])
        full = sum(math.log10(self.probability(a, b)) for a, b in zip(["<"] + t, t + [None]))
        return len(t) + 1, sum(self.words[w] > 0 for w in [*t, None]), n, base, full


def close(a, b):
    return all(x == y or isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a, b, strict=True))


def given(spark):
    r = random.Random(4)
    rows = [(100 + i, words(r.randrange(1, 200), i, r.choice([20, 300, 9000])).title() + " Ünï\x1cÉ  ", "en", "a", 0) for i in range(120)]
    return documents(spark, rows)


@pytest.mark.parametrize("small", [False, True])
def test_against_formulas(spark, tmp_path, monkeypatch, small):
    if small:  # many shards, short streams, texts over several streams
        monkeypatch.setattr(kn, "CHUNK_BYTES", 700)
        monkeypatch.setattr(kn, "GATHERED", 500)
        monkeypatch.setattr(kn, "SHARD_BYTES", 4000)
        monkeypatch.setattr(kn.train, "__defaults__", ("text", 4000))
    data = given(spark)
    data.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = data.collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    model = Plain(r["text"] for r in rows if not held(r["doc_id"]))
    want = sorted([(r["doc_id"], held(r["doc_id"]), *model.scores(r["text"])) for r in rows], key=repr)
    got = sorted([tuple(r)[:7] for r in kn.op12_kneser_ney(spark, str(tmp_path)).collect()], key=repr)
    assert len(got) == len(want) and all(close(a, b) for a, b in zip(got, want))
    # over known and unknown words the probabilities of what follows sum to one
    for a in ["<", *list(model.words)[:20], b"unheard"]:
        assert math.isclose(sum(model.probability(a, b) for b in model.words) + model.probability(a, b"unheard"), 1)


def test_learns(spark):
    texts = spark.createDataFrame([(f"a b c d e f{i % 7}",) for i in range(60)], "text string")
    model = kn.train(texts)
    rows = kn.score(spark.createDataFrame([("a b c d e f1",), ("f1 e d c b a",)], "text string"), model).collect()
    assert rows[0]["score"] > rows[1]["score"] + 3 and math.isclose(rows[0]["base_score"], rows[1]["base_score"])


def test_columns_and_nothing(spark, tmp_path):
    data = clashing(given(spark), ["score", "n_known", "_scores", "shard", "data"])
    rows = kn.score(data, kn.train(data.filter("false"))).collect()
    assert len(rows) == data.count() and {r["shard"] for r in rows} == {"mine"}
    assert {(r["n_known"], r["score"], r["base_score"]) for r in rows} == {(0, 0.0, 0.0)}
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert kn.op12_kneser_ney(spark, str(tmp_path)).count() == 0
