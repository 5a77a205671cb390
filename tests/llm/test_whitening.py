import math
import random

import numpy as np
import pytest

from strandweave.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int, whitened string"


def vectors(spark, n=700, width=40):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 0.05 + 0.01 * d) + 0.2 * (d % 3) for d in range(width)], 0, "mine") for i in range(n)]
    rows += [(7, [0.25] * width, 1, "x"), (7, [0.25] * width, 1, "x"), (None, [0.5] * width, 0, "x"), (900, None, 0, "x"),
             (901, [1.0, None], 0, "x"), (902, [float("nan")] * width, 0, "x"), (903, [float("-inf")] * width, 0, "x"),
             (904, [0.125, -0.5], 0, "x"), (905, [], 0, "x")]
    return spark.createDataFrame(rows, VECTORS)


def grid(data, width):
    out = []
    for r in data.collect():
        v = r["embedding"]
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((r["vec_id"], [math.floor(64 * x) + 1_000_000 for x in v] + [1_000_000] * (width - len(v))))
    return out


@pytest.mark.parametrize("blocks", [1024, 64])
def test_against_arrays(spark, monkeypatch, blocks):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(whitening, "BLOCKS_A_PRODUCT", 3)
    data = vectors(spark)
    given = grid(data, 40)
    x = np.array([v for _, v in given], object)
    n, total = len(x), x.sum(axis=0)
    deviation = ((n * x - total) ** 2).sum(axis=1)
    centred = np.array((n * x - total) / n, float)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    rows = whitening.whitened(data).collect()
    assert len(rows) == 32 * n and {r["n"] for r in rows} == {n}
    assert sorted({(r["component"], round(r["explained"], 12)) for r in rows}) == [
        (k + 1, round(values[-1 - k] / values.sum(), 12)) for k in range(32)]
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    for k in range(32):
        want = sorted(zip([repr(i) for i, _ in given], deviation.tolist(), np.abs(centred @ directions[:, -1 - k]) / math.sqrt(values[-1 - k])))
        got = sorted((repr(r["vec_id"]), r["deviation"], abs(r["whitened"])) for r in rows if r["component"] == k + 1)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-8)


def test_no_spread_and_nothing(spark):
    assert whitening.whitened(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whitened(vectors(spark).filter("vec_id in (900, 901, 902, 903, 905)")).count() == 0
    same = spark.createDataFrame([(i, [0.5, 0.25], 0, "") for i in range(9)], VECTORS)
    assert whitening.whitened(same).count() == 0
    line = spark.createDataFrame([(i, [i / 64, 0.25, -2 * i / 64], 0, "") for i in range(9)], VECTORS)
    rows = whitening.whitened(line).collect()
    assert len(rows) == 9 and {r["component"] for r in rows} == {1} and rows[0]["identity_error"] < 1e-9
    assert abs(rows[0]["explained"] - 1) < 1e-12
