"""Helpers that keep large jobs evenly spread and safe against lost executors."""

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage, as the cluster names it."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


_folders: dict[str, str] = {}


def run_folder(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{app}-{uuid.uuid4().hex[:8]}"
    return _folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the run's folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def close(spark: SparkSession) -> None:
    """Removes what this application stored with ``stored`` and ``scratch_path``; results must be written before."""
    folder = _folders.pop(spark.sparkContext.applicationId, None)
    if folder is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """What is run meanwhile removes its shuffle files at its end; else they stay until the driver collects garbage."""
    before = spark.conf.get(_REMOVED, None)
    spark.conf.set(_REMOVED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_REMOVED) if before is None else spark.conf.set(_REMOVED, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage through a Parquet table in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only after counting; larger sides keep the shuffle join.

    ``df`` must be cheap to evaluate twice (a stored or checkpointed table).
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def sort_rows(df: DataFrame, *keys) -> DataFrame:
    """Global order as range partitions sorted inside.

    ``keys`` should end in something close to unique (a read name), so that a
    single hot position is still divided over many range partitions.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def dense_ordinal(df: DataFrame, *keys, name: str = "ordinal", start: int = 0) -> DataFrame:
    """Gap-free row number in global key order without a single-task window.

    The sorted rows are checkpointed, so partition contents stay the same if a
    task is run again; one row per partition is counted, and each row adds its
    partition's offset to its place inside the partition.
    """
    spark = df.sparkSession
    rows = cut_lineage(sort_rows(df, *keys))
    rows = rows.withColumns({
        "_part": F.spark_partition_id(),
        "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    })
    counts = sorted((r["_part"], r["n"]) for r in
                    rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], start
    for part, n in counts:
        offsets.append((part, total))
        total += n
    # one row per partition, so this side is bounded by the partition count
    table = spark.createDataFrame(offsets or [(0, start)], "_part int, _offset bigint")
    return (rows.join(F.broadcast(table), "_part")
            .withColumn(name, F.col("_offset") + F.col("_row"))
            .drop("_part", "_row", "_offset"))


def top_n_per_group(df: DataFrame, keys: list[str], order: list, n: int,
                    salt_on: list[str], salts: int = 64) -> DataFrame:
    """Exactly the first ``n`` rows of each group, in two rounds.

    Round one keeps the first ``n`` of every (group, salt) piece, so a group of
    any size is divided over ``salts`` tasks; round two sees at most
    ``n * salts`` rows of it.
    """
    rows = df.withColumn("_salt", F.pmod(F.hash(*salt_on), F.lit(salts)))
    inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(*order)
    rows = rows.withColumn("_rank", F.row_number().over(inner)).filter(F.col("_rank") <= n)
    rows = rows.withColumn("_rank", F.row_number().over(outer)).filter(F.col("_rank") <= n)
    return rows.drop("_salt", "_rank")


def lookup_join(df: DataFrame, small: DataFrame, keys: list[str], salt_on: list[str],
                how: str = "inner", max_rows: int = 1_000, salts: int = 64,
                max_bytes: int = 8 << 20) -> DataFrame:
    """Join a large table to one whose few keys are hot by nature (read groups).

    Measured first: up to ``max_rows`` rows of together at most ``max_bytes`` (as
    text) are broadcast. Beyond that the small side is repeated per salt and the
    large side draws its salt from a hash, so one hot key is divided over
    ``salts`` tasks.
    """
    width = F.octet_length(F.to_json(F.struct(*small.columns)))
    rows, size = small.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    if rows <= max_rows and size <= max_bytes:
        return df.join(F.broadcast(small), keys, how)
    left = df.withColumn("_salt", F.pmod(F.hash(*salt_on), F.lit(salts)))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def running_total(df: DataFrame, *keys, weight, name: str = "offset") -> DataFrame:
    """Total weight of all earlier rows in global key order.

    As ``dense_ordinal``: totals inside each stored range partition, plus one
    offset per partition.
    """
    spark = df.sparkSession
    rows = cut_lineage(sort_rows(df.withColumn("_w", weight.cast("bigint")), *keys))
    rows = rows.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    sums = sorted((r["_part"], r["s"]) for r in
                  rows.groupBy("_part").agg(F.sum("_w").alias("s")).collect())
    offsets, total = [], 0
    for part, s in sums:
        offsets.append((part, total))
        total += s
    table = spark.createDataFrame(offsets or [(0, 0)], "_part int, _offset bigint")
    before = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_sum", F.coalesce(F.sum("_w").over(before), F.lit(0)))
            .join(F.broadcast(table), "_part")
            .withColumn(name, F.col("_offset") + F.col("_sum"))
            .withColumn("total", F.lit(total).cast("bigint"))
            .drop("_part", "_row", "_offset", "_sum", "_w"))
