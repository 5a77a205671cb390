"""Clusters on the flow cell, and components, against all pairs."""

import random

import pytest

from strandweave.functions.components import components
from strandweave.operators import optical


def groups(nodes, linked):
    name = {n: n for n in nodes}

    def root(n):
        while name[n] != n:
            n = name[n]
        return n
    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        name[y] = x
    return {n: root(n) for n in nodes}


def test_components(spark):
    r = random.Random(4)
    order = r.sample(range(1000), 400)
    edges = [*zip(order, order[1:]), *((r.randrange(2000, 2300), r.randrange(2000, 2300)) for _ in range(160)), (5000, 5001), (5001, 5000)]
    edges += [(9000 + k, 8999) for k in range(50)]
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    got = components(spark.createDataFrame([*edges, (None, 1), (7, None)], "a long, b long"), "a", "b").collect()
    assert len(got) == len(nodes) and dict(map(tuple, got)) == groups(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("distance", [0, 3, 100])
def test_clusters_against_all_pairs(spark, distance):
    r, rows = random.Random(distance), []
    for k in range(700):
        spread = 12 * (distance + 1)
        place = f"m:1:f:{k % 2}:{1101 + k % 3}:{r.randrange(spread)}:{r.randrange(spread)}#{k}"
        rows.append(("lib", place if k % 50 else f"plain{k}", 60, 5, 9 + (k % 7 == 0), 2, r.randrange(4)))
    df = spark.createDataFrame(rows, "library string, read_name string, mapq int, end_a long, end_b long, ends long, score long")

    def place(name):
        parts = name.split("#")[0].split(":")
        return parts[:-2], int(parts[-2]), int(parts[-1])
    at = {x[1]: (x[4], x[6], *place(x[1])) for x in rows if ":" in x[1]}
    linked = [(a, b) for a in at for b in at if a < b and at[a][0] == at[b][0] and at[a][2] == at[b][2]
              and abs(at[a][3] - at[b][3]) <= distance and abs(at[a][4] - at[b][4]) <= distance]
    of = groups(at, linked)
    want = {}
    for n, c in of.items():
        want.setdefault(c, []).append((-at[n][1], n))
    got = sorted((x.read_name, x.n) for x in optical.optical_clusters(df, distance).collect())
    assert got == sorted((min(v)[1], len(v)) for v in want.values())
    if distance:
        assert max(map(len, want.values())) > 5
    assert optical.optical_clusters(df.filter("false"), distance).count() == 0
