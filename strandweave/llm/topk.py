"""Exact top-k inner products, term at a time, in blocks.

Vectors become integer rows. For a block of queries and a block of candidates, each term (component) in turn
scatters its weighted postings into a dense score array; the best k of each row are selected by partition and the
blocks' winners merged by a window over at most k rows per block and query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

#: Rows of a block: bounds the memory of one task at (QUERY_BLOCK x CANDIDATE_BLOCK) scores of 8 bytes.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096


#: Largest component on the grid: scores of up to 512 such components stay within 64 bits.
LARGEST = 1 << 26


def quantized(vectors: DataFrame, vec_id: str, vector: str, scale: int = 256) -> DataFrame:
    """(row, vec_id, weights array<long>): floor(scale * x) of each component as double; ``row`` tells rows apart.

    Rows whose id or vector is null, empty, or holds a null, infinite or NaN component take no part. Rows with one id
    are rows of their own. A component beyond ``LARGEST`` on the grid is an error, as scores could overflow.
    Store the result: ``row`` is as stable as the rows' places.
    """
    x = F.col(vector).cast("array<double>")
    good = F.col(vec_id).isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    on_grid = lambda v: F.when(F.abs(v * scale) <= LARGEST, F.floor(v * scale).cast("long")).otherwise(
        F.raise_error(F.lit("a component is too large for exact scores")).cast("long"))
    return vectors.filter(F.coalesce(good, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, on_grid).alias("weights"))


def accumulate(queries: list, candidates: list) -> np.ndarray:
    """Scores of all queries against all candidates; both are lists of integer arrays of any lengths."""
    terms: dict[int, tuple[list, list]] = {}
    for i, w in enumerate(candidates):
        for t in np.flatnonzero(w):
            rows, weights = terms.setdefault(int(t), ([], []))
            rows.append(i)
            weights.append(int(w[t]))
    postings = {t: (np.array(r), np.array(w, np.int64)) for t, (r, w) in terms.items()}
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for q, weights in enumerate(queries):
        row = scores[q]
        for t in np.flatnonzero(weights):
            if (p := postings.get(int(t))) is not None:
                if len(p[0]) == len(row):  # every candidate has the term
                    row += weights[t] * p[1]
                else:
                    row[p[0]] += weights[t] * p[1]
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, others: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best among those of ``others``, larger scores first, then smaller ids."""
    places = np.flatnonzero(others)
    if len(places) > k:
        s = scores[places]
        least = np.partition(s, len(s) - k)[len(s) - k]
        above, ties = places[s > least], places[s == least]
        ties = ties[np.argsort(ids[ties], kind="stable")][:k - len(above)]
        places = np.concatenate([above, ties])
    return places[np.lexsort((ids[places], -scores[places]))]


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): both inputs as from ``quantized``, stored; a query's own row is left out.

    Each row of ``queries`` has its own ranks, so ids that several rows share come several times. Fewer candidates than k give fewer rows; no candidates or queries give none. Queries are repeated for every
    candidate block and candidates for every query block, which is the stated set of queries against all rows.
    """
    spark = candidates.sparkSession
    n_q, n_c = queries.count(), candidates.count()
    blocks_q, blocks_c = max(1, math.ceil(n_q / QUERY_BLOCK)), max(1, math.ceil(n_c / CANDIDATE_BLOCK))

    def dealt(rows: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return (rows.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    # names of their own, as both sides may come from one table
    left = dealt(queries, "qb", blocks_q, "cb", blocks_c).select(
        "qb", "cb", *[F.col(c).alias(f"q_{c}") for c in ("row", "vec_id", "weights")]).groupBy("qb", "cb")
    right = dealt(candidates, "cb", blocks_c, "qb", blocks_q).groupBy("qb", "cb")

    def block(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        if not len(c) or not len(q):
            return empty
        ids, rows = c["vec_id"].to_numpy(np.int64), c["row"].to_numpy(np.int64)
        candidate_rows, found = list(c["weights"]), []
        for at in range(0, len(q), 256):
            part = q.iloc[at:at + 256]
            scores = accumulate(list(part["q_weights"]), candidate_rows)
            for own, of, row in zip(part["q_row"], part["q_vec_id"], scores, strict=True):
                places = _best(row, ids, rows != own, k)
                found.append(pd.DataFrame({"row": own, "query_id": of, "vec_id": ids[places], "score": row[places]}))
        return pd.concat([empty, *found]).astype("int64")

    best = left.cogroup(right).applyInPandas(block, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best for every vector whose id is divisible by 50, against all others."""
    rows = stored(quantized(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    return top_k(rows.filter(F.col("vec_id") % 50 == 0), rows, 5)


OP8_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: coalesce(z[1] * z[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
