import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.llm import quality

from .data import DOCS, clashing, documents, words


def docs(spark):
    r, rows = random.Random(9), []
    for i in range(300):
        text = words(r.randrange(55, 400), i)
        if i % 4 == 0:
            text += "\n" + words(30, 1) + "\n" + words(30, 1) + "\n\n \n"
        if i % 15 == 0:
            text = " ".join(w + r.choice(["###", "$$$", "&&&"]) for w in text.split(" "))
        rows.append((1000 + i, text, r.choice(["en", "de"]), r.choice(["a", "b"]), 0))
    rows.append((5000, "again and again " * 100, "en", "a", 0))
    rows += [(6000 + i, words(r.randrange(55, 300), i + 900), "fr", r.choice("cdef"), 0) for i in range(70)]
    rows += [(8000 + i, words(r.randrange(55, 300), i + 800), "it", "c", 0) for i in range(7)]
    return documents(spark, rows)


def counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    g = Counter(zip(w, w[1:], w[2:]))
    places = {p for i in range(len(w) - 2) if g[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(places)


def test_counts_and_verdicts(spark):
    data = clashing(docs(spark), ["n_words", "d", "g", "f0"])
    rows = quality.assess(data).collect()
    assert len(rows) == data.count()
    for r in rows:
        n, c, s, d, k = counts(r["text"])
        assert tuple(r[f"_q_{x}"] for x in quality.STATISTICS) == (n, c, s, d, k)
        assert r["_q_base_failed"] == (n < 50 or 100 * k > 50 * n)
        assert r["n_words"] == "mine" and not (r["_q_base_failed"] and r["_q_kept"])


def concentrated(x):
    """The same estimate with arrays: squared distances of the rows of x, by any rows' estimate."""
    spread = np.array(quality.SPREADS) * quality.UNIT
    m = np.median(x, axis=0)
    z = (x - m) / np.maximum(1.4826 * np.median(abs(x - m), axis=0), spread)
    best = None
    for d in ((z ** 2).sum(axis=1), abs(z).sum(axis=1), abs(z).max(axis=1), (z ** 2 / (1 + z ** 2)).sum(axis=1)):
        before = None
        for _ in range(quality.MAX_STEPS):
            b = np.floor(64 * np.log1p(d))
            h = x[b <= np.median(b)]
            mean, cov = h.mean(axis=0), quality.CONSISTENCY * np.atleast_2d(np.cov(h.T, bias=True))
            cov += np.diag(np.maximum(0, spread ** 2 - np.diag(cov)))
            y = x - mean
            d = np.einsum("ij,jk,ik->i", y, np.linalg.inv(cov), y)
            if before is not None and len(before) == len(h) and (before == h).all():
                break
            before = h
        size = np.linalg.slogdet(cov)[1]
        if best is None or size < best[0] - 1e-9:
            best = size, mean, np.linalg.inv(cov)
    return best[1:]


def vectors_of(rows):
    return np.array([[r[f"_q_f{i}"] for i in range(5)] for r in rows], float)


@pytest.mark.parametrize("most", [1000, 0])
def test_distances_against_arrays(spark, monkeypatch, most):
    """Own estimates of the large groups; of the language for small ones, of all for small languages."""
    monkeypatch.setattr(quality, "MOST_GROUPS", most)
    rows = [r for r in quality.assess(docs(spark)).collect() if not r["_q_base_failed"]]
    by, langs = {}, {}
    for r in rows:
        by.setdefault((r["lang"], r["source"]), []).append(r)
        langs.setdefault(r["lang"], []).append(r)
    levels = set()
    for (lang, _), group in by.items():
        fit = next(g for g in (group, langs[lang], rows) if len(g) >= quality.MIN_GROUP or g is rows)
        levels.add("own" if fit is group else "all" if fit is rows else "lang")
        mean, inverse = concentrated(vectors_of(fit))
        y = vectors_of(group) - mean
        want = np.einsum("ij,jk,ik->i", y, inverse, y)
        assert np.allclose(want, [r["_q_distance"] for r in group], rtol=1e-6, atol=1e-6)
    assert levels == {"own", "lang", "all"}


def prose(r, n, letters=5.0):
    """n words with mean length ``letters``, all different."""
    out = []
    for k in range(n):
        w = max(2, round(r.gauss(letters, 0.6)))
        out.append("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(w)) + ("" if w > 2 else str(k)))
    return " ".join(out)


def test_planted_outliers_go_and_clean_texts_stay(spark):
    r, rows = random.Random(5), []
    for i in range(400):  # a tight group; a few texts repeat a line or hold a symbol
        text = prose(r, round(r.gauss(300, 30)))
        if i % 23 == 0:
            text += "\n" + prose(r, 9) * 2 + "\nshort line\nshort line"
        rows.append((i, text + (" &" if i % 31 == 0 else ""), "en", "tight", 0))
    for i in range(400):  # longer texts have longer words here
        u = max(-2, min(2, r.gauss(0, 1)))
        rows.append((1000 + i, prose(r, round(300 * math.exp(0.4 * u)), 8 * math.exp(0.2 * u)), "en", "joint", 0))
    base = prose(r, 300)
    some = base.split(" ")
    planted = {
        "long": prose(r, 20_000), "letters": " ".join(chr(0x4E00 + k) for k in range(300)),
        "long words": prose(r, 300, 25), "symbols": " ".join(w + "##" for w in some), "lines": "\n".join(x for k in range(60) for x in (some[k], some[k])) + " " + base,
        "repeats": " ".join(some[:155] + some[:72] + some[155:228])}
    for k, (name, text) in enumerate(planted.items()):
        rows.append((5000 + k, text, "en", "tight", 0))
    rows += [(6000, prose(r, 700, 4.5), "en", "joint", 0), (6001, prose(r, 130, 11), "en", "joint", 0)]  # each value is usual, the pair is not
    got = {x["doc_id"]: x for x in quality.assess(spark.createDataFrame(rows, DOCS)).collect()}
    for k, name in enumerate(planted):
        assert not got[5000 + k]["_q_base_failed"] and not got[5000 + k]["_q_kept"], name
    assert not got[6000]["_q_kept"] and not got[6001]["_q_kept"]
    clean = [got[i]["_q_kept"] for i in [*range(400), *range(1000, 1400)]]
    assert sum(clean) / len(clean) >= 0.98


@pytest.mark.parametrize("empty", [False, True])
def test_query_and_sql(spark, tmp_path, empty):
    data = spark.createDataFrame([], DOCS) if empty else docs(spark)
    data.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = [tuple(r) for r in quality.op1_robust_outliers(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(con.sql(quality.OP1_SQL).fetchall(), key=repr)
    assert math.isfinite(len(got))


def test_the_driver_plans_steps_over_a_scan(spark, monkeypatch):
    given, estimates = [], quality.estimates
    monkeypatch.setattr(quality, "estimates", lambda vectors: given.append(vectors) or estimates(vectors))
    quality.assess(docs(spark))
    plan = given[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" not in plan  # which every step would plan, and broadcast, again


def test_names_are_added_in_few_projections(spark):
    sums = spark.createDataFrame([tuple(range(40, 40 + len(quality.TOTALS)))], ", ".join(f"{t} long" for t in quality.TOTALS))
    by_one = sums
    for e in quality.MEANS + quality.CHOLESKY:
        value, _, name = e.rpartition(" AS ")
        by_one = by_one.withColumn(name, F.expr(value))
    rows = quality._step_by_step(sums, quality.MEANS + quality.CHOLESKY)
    assert rows.first().asDict() == by_one.first().asDict()
    assert rows._jdf.queryExecution().analyzed().toString().count("Project [") < 15 < len(quality.CHOLESKY)
