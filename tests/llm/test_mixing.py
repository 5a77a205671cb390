import math
import random

from pyspark.sql import functions as F

from strandweave.llm import mixing

from .data import DOCS, clashing, documents, words


def docs(spark):
    r = random.Random(7)
    rows = [(i, words(max(1, int(r.lognormvariate(4, 1))), i), "en", r.choice(["a", "a", "a", "b", "é", None]), 0) for i in range(400)]
    return documents(spark, rows)


def targets(sizes, total_share=1.5, cap=2):
    """Water filling by hand."""
    names = sorted(k for k in sizes if k is not None) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, stopped = total_share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in stopped else level * weight[s] for s in names}
        stopped |= over


def test_query(spark, tmp_path):
    clashing(docs(spark), ["size", "target"]).write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op7_entropy_mixing(spark, str(tmp_path)).collect()
    again = mixing.op7_entropy_mixing(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    given = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    count = lambda t: len((t or "").encode().split())
    assert sorted((r["doc_id"] or 0, count(r["text"])) for r in given) == sorted((r["doc_id"] or 0, r["size"]) for r in got)
    sizes = {}
    for r in given:
        sizes[r["source"]] = sizes.get(r["source"], 0) + count(r["text"])
    want = targets(sizes)
    by_target = {}
    for r in got:
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 2 * r["size"]
        key = (r["source_size"], round(r["target"], 6))
        by_target[key] = by_target.get(key, 0) + r["taken"]
    assert set(by_target) == {(sizes[s], round(want[s], 6)) for s in sizes}
    largest = max(count(r["text"]) for r in given)
    for (_, target), taken in by_target.items():
        assert abs(taken - target) <= largest


def test_rates_are_tilted_exponentially(spark):
    sizes = spark.createDataFrame([("a", s, i) for i, s in enumerate([1, 5, 9, 40, 200, 7, 7, 3] * 30)]
                                  + [("b", 10, 1000 + i) for i in range(900)], "source string, size long, id long")
    base = mixing.source_targets(sizes.select("source", "size"))
    tilts = {r["source_no"]: r for r in mixing.solve_tilts(
        sizes.join(base.select("source", "source_no"), "source").groupBy("source_no", "size").agg(F.count("*").alias("n")), base).collect()}
    for r in base.collect():
        t = tilts[r["source_no"]]
        mine = [x["size"] for x in sizes.filter(F.col("source") == r["source"]).collect()]
        rate = lambda s: 2.0 if t["tilt"] is None else min(2.0, math.exp(t["tilt"] * s / t["mean"]))
        assert abs(sum(s * rate(s) for s in mine) / r["target"] - 1) < 1e-5


def test_documents_are_repeated(spark):
    data = docs(spark)
    out = mixing.mixed_documents(clashing(data, ["source_no", "copies", "n"]))
    assert out.columns[:5] == data.columns
    most = dict(map(tuple, data.groupBy("doc_id", "text").count().selectExpr("concat_ws('|', doc_id, md5(text))", "count").collect()))
    for key, n in out.groupBy("doc_id", "text").count().selectExpr("concat_ws('|', doc_id, md5(text))", "count").collect():
        assert n <= 2 * most[key]
    total = lambda d: d.select(F.sum(mixing.word_count())).first()[0]
    assert abs(total(out) - 1.5 * total(data)) < 6000 * 2
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mixed_documents(empty).count() == 0


def test_no_words_at_all(spark):
    data = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", None, None, 0)], DOCS)
    assert {r["copies"] for r in mixing.mix(data.select("doc_id", "source", mixing.word_count().alias("size"))).collect()} == {2}
