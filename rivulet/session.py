"""Session helpers: where shared scratch data lives, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_DEFAULT, BATCH_BYTES = "67108864b", "4m"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder. On a cluster a
    machine-local folder would lose data with its executor, so a missing setting is an error.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="rivulet-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled", partition_by: list[str] | None = None, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one result feeds several branches: the work is done once, survives lost executors, and
    the read back is a parquet scan with exact sizes, so Spark's own broadcast threshold can judge it.
    """
    path = scratch(df.sparkSession, label)
    writer = df.write.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_free(df: DataFrame, label: str) -> DataFrame:
    """Like :func:`settle`; shuffle files go as soon as the frame is written, not when the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, "false")
    conf.set(FREE_SHUFFLES, "true")
    try:
        return settle(df, label)
    finally:
        conf.set(FREE_SHUFFLES, before)


def settle_buckets(df: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Like :func:`settle`, in buckets of ``keys``: a join or grouping by them, and maybe more columns, moves no row of it.

    There are as many buckets as a shuffle has partitions, so rows that come partitioned by ``keys`` are written as they lie.
    """
    conf = df.sparkSession.conf
    initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    buckets = int(initial or conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", scratch(df.sparkSession, label))
    writer.saveAsTable(name, format="parquet")
    return df.sparkSession.table(name)


def stored_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold few MB, so that long texts do not swell what a task holds on both sides of the pipe.
    Only Spark's own default is replaced."""
    if spark.conf.get(ARROW_BYTES) == ARROW_DEFAULT:
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)


def tune(spark: SparkSession) -> None:
    """Session settings the plans count on: runtime re-planning, and splitting of a hot key's join
    partition even where a later step then has to shuffle once more. Small partitions keep all cores at work and
    bound what one task holds."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16MB")
    # a join may use a partitioning by some of its keys
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
