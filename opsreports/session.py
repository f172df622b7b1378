"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the run-time work: it merges small shuffle partitions,
# turns a join into a broadcast once a side is known to be small, and splits a
# skewed join partition even if that costs one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stream state on local disk instead of the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the run-time settings the operators count on; returns the session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="opsreports-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode with the setting absent.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    return _local_scratch()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once as parquet in the shared folder, for plans that read it several times.

    Filters and column choices reach the re-read, and it survives lost executors.
    """
    path = fresh_dir(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
