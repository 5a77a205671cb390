import random

import numpy as np
import pytest

from strandweave.llm import forest_join

from .data import DOCS, clashing, documents, words


def near(spark):
    r, rows = random.Random(5), []
    for g in range(6):
        base = words(120, 60 + g, 2000).split()
        for i in range(20):
            text = list(base)
            for _ in range(r.randrange(0, 5)):
                text[r.randrange(len(text))] = f"z{r.randrange(10**6)}"
            rows.append((2000 + 100 * g + i, " ".join(text) + r.choice(["", " ", "\n"]), "en", "a", 0))
    rows += [(3000 + i, words(4, 99), "en", "a", 0) for i in range(3)] + [(3100 + i, words(100, 500 + i, 5000), "en", "a", 0) for i in range(40)]
    return documents(spark, rows)


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(r["text"]) for r in rows]
    distinct = sorted({s for s in sets if s}, key=repr)
    links = {s: [t for t in distinct if t != s and len(s & t) * 10 >= 8 * len(s | t)] for s in distinct}
    name = {s: i for i, s in enumerate(distinct)}
    changed = True
    while changed:
        changed = False
        for s in distinct:
            least = min([name[s]] + [name[t] for t in links[s]])
            changed |= least < name[s]
            name[s] = least
    ids = {}
    for r, s in zip(rows, sets):
        if s and r["doc_id"] is not None:
            ids[name[s]] = min(r["doc_id"], ids.get(name[s], 10**9))
    return [(r["doc_id"], ids.get(name[s]) if s else r["doc_id"], len(links[s]) if s else 0, sets.count(s) - 1 if s else 0)
            for r, s in zip(rows, sets)]


@pytest.mark.parametrize("block, large", [(128, 32), (4, 3)])
def test_against_brute_force(spark, tmp_path, monkeypatch, block, large):
    monkeypatch.setattr(forest_join, "LARGE", large)
    clashing(near(spark), ["set_key", "text_key"]).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(forest_join, "near_duplicates", lambda d, f=forest_join.near_duplicates: f(d, block=block))
    got = forest_join.op2_forest_join(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(spark.read.parquet(f"{tmp_path}/documents.parquet").collect()), key=repr)


def test_one_stays(spark):
    data = near(spark)
    kept = forest_join.one_of_each_class(data)
    assert kept.columns == data.columns
    rows = data.collect()
    ids = {c for r, (_, c, *_) in zip(rows, brute(rows)) if shingles(r["text"])}
    wordless = {}  # no class: only equal texts are copies, and null counts as empty
    for r in rows:
        if not shingles(r["text"]):
            wordless[r["text"] or ""] = min(r["doc_id"], wordless.get(r["text"] or "", r["doc_id"]))
    got = sorted(r["doc_id"] or 0 for r in kept.collect())
    assert got == sorted(c or 0 for c in [*ids, *wordless.values()])
    empty = spark.createDataFrame([], DOCS)
    assert forest_join.one_of_each_class(empty).count() == 0


def test_depth_and_recall():
    assert forest_join.matched_depth(0.8, 32, 12, 0.999) == 7
    assert 1 - (1 - 0.8 ** 7) ** 32 >= 0.999 > 1 - (1 - 0.8 ** 8) ** 32


def test_labels_meet_as_often_as_expected():
    r, signer, n, met = np.random.default_rng(1), forest_join.Signer(32, 7), 300, 0
    for _ in range(n):
        common, a, b = (forest_join._scrambled(r.integers(0, 1 << 63, k, dtype=np.uint64)) for k in (80, 10, 10))
        x, y = (signer.labels(np.unique(np.concatenate([common, p]))) for p in (a, b))
        met += bool((x == y).any())
    assert met >= 0.99 * n


def test_intersections():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 300, r.integers(1, 80))).astype(np.uint64) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    both = forest_join.intersections(sets, None)
    off = ~np.eye(40, dtype=bool)
    assert (both[off] == np.array(want)[off]).all()
    assert (forest_join.intersections(sets[:15], sets[15:]) == np.array(want)[:15, 15:]).all()


def test_paths_begin_alike():
    r = np.random.default_rng(7)
    sets = np.unique(r.integers(0, 1 << 63, 90, dtype=np.uint64))
    deep, loose = forest_join.Signer(8, 12), forest_join.Signer(8, 7)
    assert deep.paths(sets, 7).shape == (8, 6)
    assert (deep.paths(sets, 7)[:, 0] == loose.labels(sets)).all()


def test_each_pair_has_one_node():
    """Of all nodes that two paths share, exactly one owns the pair; none if they meet nowhere or at the full depth."""
    r, trees, levels = np.random.default_rng(3), 6, 4
    paths = []
    for _ in range(30):
        tokens = r.integers(1, 3, (trees, levels))
        label = np.array([[hash((t, *row[:k + 1])) | 1 for k in range(levels)] for t, row in enumerate(tokens.tolist())])
        label[r.random(trees) < 0.2] = 0
        paths.append(label.ravel())
    owners = np.zeros((30, 30), int)
    for tree in range(trees):
        for level in range(levels):
            owners += forest_join.owned(paths, paths, trees, tree, level)
    for i in range(30):
        for j in range(30):
            a, b = paths[i].reshape(trees, levels), paths[j].reshape(trees, levels)
            assert owners[i, j] == int(((a == b) & (a != 0)).any())


@pytest.mark.parametrize("block, large", [(128, 32), (3, 2)])
def test_loose_chains_and_short_prefixes(spark, tmp_path, monkeypatch, block, large):
    """Pairs just over the threshold meet at short prefixes only; chains of passages shared below it stay apart."""
    monkeypatch.setattr(forest_join, "LARGE", large)
    r, rows = random.Random(11), []
    for g in range(60):
        base = words(200, 900 + g, 10**6).split()
        at = 20 if g % 2 else 19  # of 196 shingles 21 or so are replaced on one side: similarity about 0.8 to 0.82
        rows += [(5000 + 10 * g, " ".join(base), "en", "a", 0), (5001 + 10 * g, " ".join(base[:-at] + words(at, 7000 + g, 10**6).split()), "en", "a", 0)]
    chain = words(3000, 77, 10**6).split()
    rows += [(9000 + i, " ".join(chain[60 * i:60 * i + 200]), "en", "a", 0) for i in range(40)]
    r.shuffle(rows)
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(forest_join, "near_duplicates", lambda d, f=forest_join.near_duplicates: f(d, block=block))
    got = forest_join.op2_forest_join(spark, str(tmp_path)).collect()
    want = brute(spark.read.parquet(f"{tmp_path}/documents.parquet").collect())
    assert sum(n > 0 for d, _, n, _ in want if d is not None and 5000 <= d < 9000) >= 60
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
