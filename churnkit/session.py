"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settable at run time, so they also apply to a session someone else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffles are cut finely and put together again by their measured size, so a task holds as much of a large table as of a small one and sorts it in
    # memory: rows that take 16 MB in a shuffle file take ten times that in a sort.
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.files.maxPartitionBytes": "32MB",
    # What a plan expects of a table comes from the size of its compressed files, which hold many times as many rows; only a side that has been shuffled, and
    # so measured, is broadcast up to the usual limit. By expectation go the smallest tables alone.
    "spark.sql.autoBroadcastJoinThreshold": "16KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.parquet.compression.codec": "zstd",
    # One-row-per-key ranking is cut down on the map side before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("churnkit")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``. Without one a single machine (tests) gets a scratch folder; a cluster
    raises, as its executors would each write to a disk of their own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir names no shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="churnkit-ckpt-"))
    return context.getCheckpointDir().rstrip("/")


_KEPT: list[str] = []


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back, where a result is used many times over; ``drop_kept`` removes it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    _KEPT.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_kept(spark: SparkSession) -> int:
    """Remove what ``kept`` wrote in this process, once no frame that reads it is used any more."""
    make, conf, count = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), len(_KEPT)
    while _KEPT:
        path = make(_KEPT.pop())
        path.getFileSystem(conf).delete(path, True)
    return count
