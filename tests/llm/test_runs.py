import hashlib
import random
import zlib

import numpy as np
import pytest

from strandweave.llm import runs

from .data import DOCS, clashing, documents


def brute(x):
    """Every run by its definition: all periods, all longest stretches, smallest period of each."""
    x, found = list(x), []
    for q in range(1, len(x)):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(x[k] == x[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted((a, length, q) for a, length, q in found)


def cases():
    r = random.Random(7)
    yield from ([], [1], [1] * 5, [1] * 6, [1, 2] * 4, [1, 2] * 3, [1, 2, 1] * 9, [1] * 300, [1, 1, 2] * 40 + [3] + [1, 1, 2] * 40)
    for k in range(250):
        n, letters = r.randrange(1, 160), r.choice([1, 2, 2, 3, 8])
        yield [r.randrange(letters) for _ in range(n)]
    for k in range(250):  # planted periods of all sizes, nested, with changes
        period = [r.randrange(r.choice([2, 3, 50])) for _ in range(r.randrange(1, 70))]
        if k % 3 == 0:
            period = period[:7] * r.randrange(1, 12) + [99]
        x = [r.randrange(5) for _ in range(r.randrange(20))] + (period * 9)[:r.randrange(3 * len(period), 9 * len(period))]
        x += [r.randrange(5) for _ in range(r.randrange(20))] + (x[3:30] * 6 if k % 2 else [])
        if k % 4 == 0:
            x[r.randrange(len(x))] = 77
        yield x


def test_against_all_periods():
    for x in cases():
        assert runs.repeats(np.array(x, np.int64)) == brute(x), x


def test_a_text_of_many_words():
    r = random.Random(1)
    period = [r.randrange(9) for _ in range(7919)]
    x = [r.randrange(3000) for _ in range(12_345)] + period * 6 + [1]
    assert (12_345, 6 * 7919, 7919) in [(a, n, q) for a, n, q in runs.repeats(np.array(x)) if q == 7919] or any(
        q == 7919 and n >= 6 * 7919 and a <= 12_345 for a, n, q in runs.repeats(np.array(x)))


def planted(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 or not n:
        return w
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = planted(doc_id, text)
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    found = brute([number[x] for x in w])
    drop = {i for a, n, q in found for i in range(a + q, a + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return {"doc_id": doc_id, "n_runs": len(found), "start": best and best[0], "length": best and best[1],
            "period": best and best[2], "exponent_milli": best and 1000 * best[1] // best[2],
            "runs_sha256": sha("".join(f"{a},{n},{q}\n" for a, n, q in found).encode()),
            "collapsed_sha256": sha(b" ".join(x for i, x in enumerate(w) if i not in drop)), "n_words": len(w)}


@pytest.mark.parametrize("empty", [False, True])
def test_query(spark, tmp_path, empty):
    r = random.Random(2)
    ids = [i for i in range(100, 4000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    rows = [(i, " ".join(r.choice("abcdefgh") for _ in range(r.randrange(0, 150))), "en", "s", 0) for i in ids]
    rows += [(i, " x \x1cy\tz  " * 7 + "é", "en", "s", 0) for i in range(40, 44)]
    data = spark.createDataFrame([], DOCS) if empty else documents(spark, rows).filter("coalesce(length(text), 0) < 9000")
    data.write.parquet(f"{tmp_path}/documents.parquet")
    got = [x.asDict() for x in runs.op11_periodic_runs(spark, str(tmp_path)).collect()]
    want = [expected(x["doc_id"], x["text"]) for x in data.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert empty or sum(x["n_runs"] for x in got) > 20


def test_columns_stay(spark):
    data = clashing(documents(spark), ["found", "runs", "w", "n_words"])
    rows = runs.with_runs(data, out="found2").collect()
    assert len(rows) == data.count() and {x["runs"] for x in rows} == {"mine"}
    for x in rows:
        assert x["found2"]["collapsed"] == " ".join(w.decode() for w in (x["text"] or "").encode().split())
