"""Near-duplicate join on word shingles: MinHash LSH forest, then exact verification.

A tree of the forest is a prefix trie over ``depth`` minimum hashes of every distinct shingle set. Prefixes are
shortened from the full depth to the first one at which pairs at the threshold meet with the wanted probability;
sets that are alone below every node of that length have no candidates, and their branches are not grown further.
The others get their whole paths, and a pair of them is verified exactly, at its longest common prefix:

- sets that meet at the full depth are almost always near copies, so the components that these leaves form are compared
  whole, each set being sent there once;
- a set that meets a component of many sets (``LARGE``) at a shorter prefix visits it once, in however many nodes they
  meet, and is compared with all of it; of two such components the sets of the smaller visit the larger;
- among the other sets, shorter prefixes are nodes where the trie branches. A node whose sets are all of one component
  is passed over. In the others a pair counts if its components differ and no tree joins it at a longer prefix (or an
  earlier tree at an equal one), so that each pair belongs to one node and loose chains are never compared as a whole.

All are done in blocks of bounded size: a block pair gives link counts and a spanning forest, never the list of
pairs, so a large group of near copies costs arithmetic but no rows. Exact copies are one set with many members and
are never expanded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memo, first_seen, stored, table, with_text_key
from .components import connected_components

SHINGLE, THRESHOLD, TREES, DEPTH, RECALL, BLOCK = 5, 0.8, 32, 12, 0.999, 256
#: Sets of a component from which on it is visited.
LARGE = 32
#: Shingles that a block holds on average at most, unless a single text has more.
BLOCK_SHINGLES = 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)


def matched_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """Length of the prefix: shortened from ``depth`` until pairs at the threshold meet with the wanted probability."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: Memo, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; a shorter text is one run; no words, none."""
    parts = (text or "").encode().split()  # splits at ASCII white space
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    n = max(1, len(h) - size + 1) if len(h) else 0
    runs = np.zeros(n, np.uint64)
    for k in range(min(size, len(h))):
        runs = _scrambled(runs * _MIX + h[k:k + n])
    return np.unique(runs)


class Signer:
    """Labels of the trie nodes under which a set lies; a shorter path is the beginning of a longer one."""

    def __init__(self, trees: int, depth: int):
        self.trees, self.depth = trees, depth
        draws = [np.random.default_rng((2, k)).integers(0, 1 << 32, (2, trees), dtype=np.uint32) for k in range(depth)]
        self.a, self.b = np.stack(draws, axis=-1).reshape(2, -1)
        self.a |= np.uint32(1)
        self.tree = _scrambled(np.arange(1, trees + 1, dtype=np.uint64))

    def paths(self, shingles: np.ndarray, shortest: int) -> np.ndarray:
        """Node labels as a row per tree and a column per prefix length from ``shortest`` on."""
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), 512):
            h = self.a[:, None] * x[None, at:at + 512]
            h += self.b[:, None]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            np.minimum(least, h.min(axis=1), out=least)
        label, labels = self.tree, []
        for k in range(self.depth):
            label = _scrambled(label * _MIX + least.reshape(self.trees, self.depth)[:, k])
            labels.append(label)
        return np.stack(labels[shortest - 1:], axis=1).view(np.int64)

    def labels(self, shingles: np.ndarray) -> np.ndarray:
        """The last node of each tree's path."""
        return self.paths(shingles, self.depth)[:, 0]


_MEMBERS = pa.schema([("text_key", pa.binary()), ("set_key", pa.binary()), ("labels", pa.list_(pa.int64()))])


def signatures(texts: DataFrame, trees: int, depth: int, shingle: int) -> DataFrame:
    """(text_key, set_key, labels) of texts with words; labels are null where the task has sent the set before.

    Texts may be repeated; a task signs those that it remembers only once.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, signer = Memo(_word_hash, 150_000), Signer(trees, depth)
        sent, seen = Memo(lambda _: False, 100_000), Memo(lambda _: False, 100_000)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if seen[key]:
                    continue
                seen[key] = True
                shingles = shingle_set(text, words, shingle)
                if len(shingles):
                    name = xxhash.xxh3_128_digest(shingles.tobytes())
                    rows.append((key, name, None if sent[name] else signer.labels(shingles)))
                    sent[name] = True
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_MEMBERS)],
                                             schema=_MEMBERS)

    return texts.select("text_key", "text").mapInArrow(sign, "text_key binary, set_key binary, labels array<long>")


def in_company(members: DataFrame) -> DataFrame:
    """(set_key, alive) of the sets that share a node of the shortest length with another set, and in which trees."""
    under = members.filter("labels is not null").select("set_key", F.posexplode("labels").alias("tree", "label"))
    node = ["tree", "label"]
    # stored, here and below, so that joins have two plain shuffles, of which a hot key's rows can be split
    shared = stored(under.groupBy(*node).agg(F.min("set_key").alias("first"), F.max("set_key").alias("last"))
                    .filter("first <> last").select(*node), "trie-nodes")
    return stored(under.join(shared, node).groupBy("set_key").agg(F.collect_set("tree").alias("alive")), "in-company")


def grown(texts: DataFrame, members: DataFrame, company: DataFrame, trees: int, shortest: int, depth: int,
          shingle: int) -> DataFrame:
    """(set_key, n, path, shingles) of the sets in company: their paths from the shortest prefix to the full depth.

    A path has the labels of all trees in a row, zeros in trees where the set is alone.
    """
    chosen = members.groupBy("set_key").agg(F.min("text_key").alias("text_key")).join(company, "set_key")
    rows = texts.select("text_key", "text").join(chosen, "text_key").select("set_key", "text", "alive")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, signer = Memo(_word_hash, 150_000), Signer(trees, depth)
        for batch in batches:
            sets = [shingle_set(t, words, shingle) for t in batch.column("text").to_pylist()]
            paths = [signer.paths(s, shortest) for s in sets]
            for path, alive in zip(paths, batch.column("alive").to_pylist(), strict=True):
                path[np.setdiff1d(np.arange(trees), alive)] = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_key"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([path.ravel() for path in paths], pa.list_(pa.int64())),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["set_key", "n", "path", "shingles"])

    return rows.mapInArrow(grow, "set_key binary, n long, path array<long>, shingles binary").dropDuplicates(["set_key"])


def nodes_of(sets: DataFrame, last: int) -> DataFrame:
    """The nodes on each set's paths, with the next one; level 0 is the shortest prefix, ``last`` the full depth."""
    at = F.col("at")
    return (sets.select("*", F.posexplode("path").alias("at", "label")).filter("label <> 0")
            .withColumns({"tree": F.floor(at / (last + 1)).cast("int"), "level": at % (last + 1), "child": F.get("path", at + 1)})
            .drop("path", "at"))


def leaf_clusters(sets: DataFrame, last: int) -> DataFrame:
    """(set_key, cluster): sets that meet at the full depth, directly or through others."""
    leaves = nodes_of(sets.select("set_key", "path"), last).filter(F.col("level") == last).select("set_key", "tree", "label")
    first = stored(leaves.groupBy("tree", "label").agg(F.min("set_key").alias("first"), F.max("set_key").alias("end"))
                   .filter("first <> end").drop("end"), "leaves")
    edges = leaves.join(first, ["tree", "label"]).filter("set_key <> first").select("set_key", "first").distinct()
    return connected_components(edges, "set_key", "first").withColumnsRenamed({"node": "set_key", "component": "cluster"})


def _blocks(block: int) -> F.Column:
    """Number of blocks of a group with rows (n): bounded in sets, and in shingles."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")


def _self_pairs(units: DataFrame) -> DataFrame:
    """Rows of the unordered pairs of blocks of each unit: a set takes part in as many as its unit has blocks."""
    cut = units.withColumn("b", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
    both = cut.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return both.select("group", "tree", "level", "unit", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"),
                       F.when(F.col("b") > F.col("o"), 1).otherwise(0).alias("side"), "set_key", "cluster")


def _visits(inner: DataFrame, members: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Rows of the pairs of a large component's blocks (side 0) and its visitors' (side 1)."""
    near = inner.filter("level = 0").select("tree", "label", "set_key", "cluster", "size")
    hosts = stored(near.filter(F.col("size") >= LARGE).select(
        "tree", "label", F.col("cluster").alias("host"), F.col("size").alias("host_size")).distinct(), "hosts")
    smaller = F.struct("size", "cluster") < F.struct(F.col("host_size").alias("size"), F.col("host").alias("cluster"))
    visitors = stored(near.join(hosts, ["tree", "label"]).filter(smaller).select("set_key", "cluster", "host").distinct()
                      .join(sets.select("set_key", "n"), "set_key"), "visitors")
    waves = stored(visitors.groupBy("host").agg(_blocks(block)).withColumnRenamed("blocks", "waves"), "waves")
    at = lambda count: F.pmod(F.xxhash64("set_key"), F.col(count)).cast("int")
    other = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    here = members.join(waves, F.col("cluster") == F.col("host")).withColumns({"i": at("blocks"), "j": other("waves"), "side": F.lit(0)})
    sizes = members.select(F.col("cluster").alias("host"), "blocks").distinct()
    come = (visitors.join(waves, "host").join(sizes, "host")
            .withColumns({"j": at("waves"), "i": other("blocks"), "side": F.lit(1)}))
    columns = [F.col("host").alias("group"), F.lit(-2).alias("tree"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("unit"),
               "i", "j", "side", "set_key", "cluster"]
    return here.select(*columns).unionByName(come.select(*columns))


def units_of(sets: DataFrame, clusters: DataFrame, last: int, block: int) -> DataFrame:
    """(group, tree, level, unit, i, j, side, set_key, cluster): the groups in which sets are compared.

    Tree -1: all pairs of a component of leaves; tree -2: visitors (side 1) against a large component (side 0). The
    others are nodes at which the trie branches and that hold sets of different small components; a set of no
    component is one by itself.
    """
    whole = stored(clusters.join(sets.select("set_key", "n"), "set_key").groupBy("cluster").agg(
        _blocks(block), F.count(F.lit(1)).alias("size")), "sizes")
    members = stored(clusters.join(whole, "cluster"), "leaf-members")
    leaves = members.select("set_key", "cluster", F.col("cluster").alias("group"), F.lit(0).cast("long").alias("unit"),
                            F.lit(-1).alias("tree"), F.lit(last).alias("level"), "blocks")
    named = sets.select("set_key", "n", "path").join(members.drop("blocks"), "set_key", "left").withColumns(
        {"cluster": F.coalesce("cluster", "set_key"), "size": F.coalesce("size", F.lit(1))})
    inner = stored(nodes_of(named, last).filter(F.col("level") < last), "inner-nodes")
    node = ["tree", "level", "label"]
    small = inner.filter(F.col("size") < LARGE)
    mixed = stored(small.groupBy(*node).agg(
        F.min("cluster").alias("c"), F.max("cluster").alias("d"), F.min("child").alias("e"), F.max("child").alias("f"),
        _blocks(block)).filter("c <> d and e <> f").select(*node, "blocks"), "branchings")
    branches = small.join(mixed, node).select(
        "set_key", "cluster", F.lit(b"").alias("group"), F.col("label").alias("unit"), "tree", "level", "blocks")
    return _self_pairs(leaves.unionByName(branches)).unionByName(
        _visits(inner, members.filter(F.col("size") >= LARGE), sets, block))


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each row of a symmetric boolean matrix."""
    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None, :], len(root)).min(axis=1)
        new = np.minimum(root, least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def intersections(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of all pairwise intersections, through the columns that at least two sets share."""
    sets = left + (right or [])
    flat = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    rows, column = rows[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    n, total = len(left), np.zeros((len(left), len(right) if right is not None else len(left)), np.float32)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):  # a band of columns at a time
        a, b = np.searchsorted(column, [at, at + 4096])
        grid = np.zeros((len(sets), 4096), np.float32)
        grid[rows[a:b], column[a:b] - at] = 1
        total += grid[:n] @ (grid if right is None else grid[n:]).T
    return total.astype(np.int64)


def owned(left: list[np.ndarray], right: list[np.ndarray], trees: int, tree: int, level: int) -> np.ndarray:
    """Pairs of paths whose longest common prefix is this one: of equally long ones, in the first tree."""
    a, b = (np.stack(p).reshape(len(p), trees, -1) for p in (left, right))
    common = np.zeros((len(a), len(b), trees), np.int8)
    for k in range(a.shape[2]):
        common += (a[:, None, :, k] == b[None, :, :, k]) & (a[:, None, :, k] != 0)
    return (common[:, :, tree] == level + 1) & (common.argmax(axis=2) == tree)


def verified(sets: DataFrame, units: DataFrame, threshold: float, trees: int) -> DataFrame:
    """(set_key, other, n_links): links of each set inside its block pairs, and one set it hangs together with."""
    percent = round(threshold * 1000)
    pairs = units.join(sets.select("set_key", "shingles", "path"), "set_key")
    pairs = pairs.withColumn("path", F.when(F.col("tree") >= 0, F.col("path")))  # the other comparisons do without

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        i, j, tree, level = (int(group[c].iloc[0]) for c in ("i", "j", "tree", "level"))
        group = group.sort_values("set_key", ignore_index=True)
        alone = i == j and tree != -2  # a block against itself
        one = group[group["side"] == 0]
        two = one if alone else group[group["side"] == 1]
        halves = [one] if alone else [one, two]
        names = [k for h in halves for k in h["set_key"]]
        linked = np.zeros((len(names), len(names)), bool)
        if len(one) and len(two):
            wanted = np.ones((len(one), len(two)), bool)
            if alone:
                np.fill_diagonal(wanted, False)
            if tree >= 0:
                wanted &= owned(list(one["path"]), list(two["path"]), trees, tree, level)
                wanted &= one["cluster"].to_numpy()[:, None] != two["cluster"].to_numpy()[None, :]
            rows, columns = wanted.any(axis=1).nonzero()[0], wanted.any(axis=0).nonzero()[0]
            left, right = ([np.frombuffer(s, np.uint64) for s in h["shingles"].iloc[at]]
                           for h, at in ((one, rows), (two, columns)))
            if len(rows):
                both = intersections(left, None if alone else right)
                size = [np.array([len(s) for s in d], np.int64) for d in (left, right)]
                near = (1000 * both >= percent * (size[0][:, None] + size[1][None, :] - both)) & wanted[np.ix_(rows, columns)]
                columns = columns if alone else columns + len(one)
                linked[np.ix_(rows, columns)] = near
                linked[np.ix_(columns, rows)] |= near.T
        links, root = linked.sum(axis=1), _roots(linked)
        some = links > 0
        return pd.DataFrame({"set_key": [k for k, s in zip(names, some) if s],
                             "other": [names[r] for r, s in zip(root, some) if s], "n_links": links[some].astype("int64")})

    return pairs.groupBy("group", "tree", "level", "unit", "i", "j").applyInPandas(
        verify, "set_key binary, other binary, n_links long")


def near_duplicates(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE,
                    trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(text_key, set_key, class_key, n_links) of every distinct text with words.

    ``n_links`` counts the other distinct shingle sets with a Jaccard similarity of at least ``threshold``; texts of
    one class are connected through such links or have equal sets. ``text_key`` is that of ``with_text_key``. Texts
    without words (null, empty) have no set and no row.
    """
    keyed = with_text_key(docs, text).select("text_key", F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = first_seen(keyed, "text_key", ["text"])
    used = matched_depth(threshold, trees, depth, recall)
    members = stored(signatures(keyed, trees, used, shingle), "members")
    sets = stored(grown(texts, members, in_company(members), trees, used, depth, shingle), "paths")
    last = depth - used
    clusters = stored(leaf_clusters(sets, last), "clusters")
    links = stored(verified(sets, units_of(sets, clusters, last, block), threshold, trees), "links")
    counts = links.groupBy("set_key").agg(F.sum("n_links").alias("n_links"))
    classes = connected_components(links, "set_key", "other").withColumnsRenamed({"node": "set_key", "component": "class_key"})
    found = counts.join(classes, "set_key")
    each = members.groupBy("text_key").agg(F.min("set_key").alias("set_key"))
    return (each.join(found, "set_key", "left")
            .select("text_key", "set_key", F.coalesce("class_key", "set_key").alias("class_key"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def op2_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class (named by its smallest doc_id), its links to other texts and its copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = stored(near_duplicates(docs), "near")
    rows = stored(with_text_key(docs).select("doc_id", "text_key").join(found, "text_key", "left"), "classed")
    classes = stored(rows.groupBy("class_key").agg(F.min("doc_id").alias("class_id")), "classes")
    sets = stored(rows.groupBy("set_key").agg(F.count(F.lit(1)).alias("n_same")), "sets")
    return (rows.join(classes, "class_key", "left").join(sets, "set_key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("n_same") - 1, F.lit(0)).cast("long").alias("n_copies")))


def one_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """The document with the smallest doc_id (null last) of each class; texts without words all stay but copies.

    Of rows alike in doc_id and text one stays. The choice is made on keys; the texts are shuffled once, to be
    joined with it.
    """
    keyed = with_text_key(docs, key="_text_key")
    found = stored(near_duplicates(docs, **options), "near").select(
        F.col("text_key").alias("_text_key"), F.col("class_key").alias("_class"))
    light = keyed.select("_text_key", "doc_id").join(found, "_text_key", "left")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("_text_key").alias("k"))
    best = light.groupBy(F.coalesce("_class", "_text_key").alias("c")).agg(F.min(order).alias("b"))
    row_key = lambda text, doc: F.unhex(F.md5(F.concat_ws("/", F.hex(text), doc.cast("string"))))
    kept = best.select(row_key(F.col("b.k"), F.col("b.d")).alias("_row_key"))
    joined = keyed.withColumn("_row_key", row_key(F.col("_text_key"), F.col("doc_id"))).join(kept, "_row_key")
    return joined.dropDuplicates(["_row_key"]).select(*docs.columns)
