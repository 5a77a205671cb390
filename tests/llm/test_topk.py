import math
import random

import pytest

from strandweave.llm import topk
from strandweave.llm.common import stored

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, n=230):
    r = random.Random(1)
    rows = [(i, [r.uniform(-1, 1) if r.random() < 0.7 else 0.0 for _ in range(r.choice([8, 8, 5]))], 0) for i in range(n)]
    rows += [(i, [0.5] * 8, 1) for i in range(300, 340)] + [(300, [0.5] * 8, 1), (300, [-0.5] * 8, 1), (250, [0.1] * 8, 0), (None, [1.0], 0), (400, None, 0), (401, [], 0),
             (450, [1.0, None], 0), (402, [float("nan")], 0), (403, [float("inf")], 0)]
    return spark.createDataFrame(rows, VECTORS)


def brute(rows, k):
    """Every row by itself: rows of one id are candidates for each other."""
    table = [(r["vec_id"], [math.floor(256 * x) for x in r["embedding"]]) for r in rows if r["vec_id"] is not None and r["embedding"]
             and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    out = []
    for n, (q, v) in enumerate(table):
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(table) if m != n)[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 60)
    data = vectors(spark)
    rows = stored(topk.quantized(data, "vec_id", "embedding"), "v")
    got = topk.top_k(rows.filter("vec_id % 50 = 0"), rows, 5).collect()
    assert sorted(map(tuple, got)) == brute(data.collect(), 5)


def test_few_and_none(spark):
    rows = stored(topk.quantized(vectors(spark).filter("vec_id in (0, 1, 2)"), "vec_id", "embedding"), "v")
    assert topk.top_k(rows.filter("vec_id = 0"), rows, 5).count() == 2
    none = topk.quantized(spark.createDataFrame([], VECTORS), "vec_id", "embedding")
    assert topk.top_k(none, none, 5).count() == 0 and topk.top_k(rows, none, 5).count() == 0


def test_query_and_sql(spark, tmp_path):
    import duckdb
    vectors(spark).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = sorted(map(tuple, topk.op8_exact_topk(spark, str(tmp_path)).collect()))
    assert got == sorted(con.sql(topk.OP8_SQL).fetchall()) == brute(vectors(spark).collect(), 5)


def test_scores_that_could_overflow_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        topk.quantized(spark.createDataFrame([(50, [3e38], 0)], VECTORS), "vec_id", "embedding").collect()
