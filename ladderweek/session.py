"""Session settings the toolkit expects. On a cluster the submitted session wins; this is for tests and benches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("ladderweek")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shuffle_tasks(df: DataFrame) -> int:
    """The session's shuffle partitions, for rows that are dealt by number: small as they are, their work is not."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can see: the one the cluster names in spark.checkpoint.dir, else one in the warehouse.

    A warehouse on the driver's own disk will do for a local session only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    is_local = spark.conf.get("spark.master", "local").startswith("local") and "cluster" not in spark.conf.get("spark.master", "local")
    if not is_local and (warehouse.startswith("file:") or warehouse.startswith("/")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse + "/ladderweek-work"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table of this session; what is there goes when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    of_jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    of_jvm.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(of_jvm)
    return path
