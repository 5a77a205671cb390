"""Whitening of embeddings with distributed block matrices (Spark MLlib).

Vectors are put on an integer grid, centred, numbered, and dealt into the blocks of a ``BlockMatrix``. The transposed
matrix times the matrix is the scatter, the one small (dimensions x dimensions) thing that the driver sees; its
eigenvectors, each over the square root of its eigenvalue, are the whitening matrix, by which the block matrix is
multiplied to project the rows.

Numbers of rows are dealt from the checkpointed partitions, so no sort and no hot key is involved. The scatter is
multiplied with the rows split over many partial products (``numMidDimSplits``), so its one result block is no hot spot.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scaling import cut_lineage
from .common import stored, table

#: The grid: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Rows of a block, and blocks that meet in one partial product: bounds a task to about 8 MB for each 64 dimensions.
BLOCK_ROWS, BLOCKS_A_PRODUCT = 1024, 8
#: Eigenvalues below this share of the largest are taken as zero: their directions cannot be whitened.
LEAST_SHARE = 1e-12


def gridded(vectors: DataFrame, vector: str = "embedding", out: str = "x") -> DataFrame:
    """Adds ``out``, the long entries; rows whose vector is null or holds null or non-finite entries are dropped."""
    c = F.col(vector).cast("array<double>")
    good = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.filter(F.coalesce(good, F.lit(False))).withColumn(
        out, F.transform(c, lambda v: F.floor(v * SCALE).cast("long") + OFFSET))


def numbered(rows: DataFrame, name: str = "index") -> DataFrame:
    """Adds dense numbers from 0, as the rows lie in their checkpointed partitions; one row a partition is collected."""
    rows = cut_lineage(rows).withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id().bitwiseAND(
        F.lit((1 << 33) - 1))})
    counts = sorted(map(tuple, rows.groupBy("_part").agg(F.count(F.lit(1))).collect()))
    before = np.cumsum([0, *[n for _, n in counts]]).tolist()
    offsets = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)] or [(0, 0)], "_part int, _offset long")
    return (rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_row"))
            .drop("_part", "_row", "_offset"))


def block_matrix(rows: DataFrame, index: str, vector: str, n: int, width: int) -> BlockMatrix:
    """The rows (dense number, array of doubles) as a matrix in blocks of all columns."""
    pairs = MLUtils.convertVectorColumnsFromML(
        rows.select(F.col(index).alias("index"), array_to_vector(F.col(vector)).alias("vector")), "vector")
    return IndexedRowMatrix(pairs, n, width).toBlockMatrix(BLOCK_ROWS, width)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transposed matrix times the matrix, as a local array."""
    splits = max(1, -(-matrix.numRowBlocks // BLOCKS_A_PRODUCT))
    other = matrix._java_matrix_wrapper._java_model
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", other, splits)  # the splits have no Python argument
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def whitened(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component.

    ``deviation`` is the exact sum over dimensions of (n x - S)^2, S the sums of x; a value beyond 64 bits is an error.
    ``explained`` is the eigenvalue over their sum, ``identity_error`` the largest absolute entry of the covariance of
    the whitened rows minus the identity. Shorter vectors count as filled up with zeros. Directions without spread
    (constant dimensions, fewer rows than dimensions) have no whitened value and give no rows; if no direction has
    any, there are none at all. Repeated rows and ids are kept, null ids too; columns besides the two named are
    ignored. Reruns may differ in the last digits and in signs.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = stored(gridded(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")), "v", "x")
                  .select("vec_id", "x"), "gridded")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n or not width:
        return spark.createDataFrame([], schema)
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x"))))
    sums = rows.agg(*[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(width)]).first()
    total = F.array(*[F.lit(s).cast("long") for s in sums])
    # n x - S is exact; over n it is the centred entry to double precision
    apart = F.zip_with("x", total, lambda x, s: x * F.lit(n) - s)
    rows = numbered(rows.select("vec_id", apart.alias("a"))).select(
        "index", "vec_id", F.aggregate("a", F.lit(0).cast("long"), lambda t, y: t + y * y).alias("deviation"),
        F.transform("a", lambda y: y.cast("double") / F.lit(float(n))).alias("centred"))
    rows = stored(rows, "centred")
    matrix = block_matrix(rows, "index", "centred", n, width)
    covariance = scatter(matrix) / n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    order = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > LEAST_SHARE * max(values[-1], 0)]
    if not order:
        return spark.createDataFrame([], schema)
    explained = [float(v) for v in values[order] / np.trace(covariance)]
    turn = directions[:, order] / np.sqrt(values[order])
    k = len(order)
    small = BlockMatrix(spark.sparkContext.parallelize([((0, 0), Matrices.dense(width, k, turn.ravel(order="F").tolist()))], 1),
                        width, k)
    projected = callMLlibFunc("getIndexedRows", matrix.multiply(small).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    white = stored(projected.select("index", vector_to_array("vector").alias("w")), "whitened")
    middle = white.agg(*[F.avg(F.get("w", F.lit(i))).alias(f"m{i}") for i in range(k)]).first()
    level = white.withColumn("w", F.zip_with("w", F.array(*[F.lit(m) for m in middle]), lambda w, m: w - m))
    error = float(np.abs(scatter(block_matrix(level, "index", "w", n, k)) / n - np.eye(k)).max())
    shares = F.array(*[F.lit(v) for v in explained])
    return (rows.select("index", "vec_id", "deviation").join(white, "index")
            .select("vec_id", "deviation", F.posexplode("w").alias("p", "whitened"))
            .select("vec_id", (F.col("p") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(shares, F.col("p")).alias("explained"), F.lit(error).alias("identity_error")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on its first 32 whitened components."""
    return whitened(table(spark, sf_dir, "embeddings"))
