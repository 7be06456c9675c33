"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE sizes shuffle partitions from the data, splits skewed joins and swaps in a
# broadcast join when a side turns out to be small, so nothing here depends on scale.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Row work here is heavy (patterns, hashing), so small stages stay parallel.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cuelake", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        # Local mode is one JVM: the driver's memory is all there is.
        extra.setdefault("spark.driver.memory", "8g")
        builder = builder.master(master).config("spark.ui.enabled", "false").config(
            "spark.ui.showConsoleProgress", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only in local mode without one (unit tests, a laptop) a folder of our own is made
    and remembered, so every later call of the session agrees on it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    chosen = spark.sparkContext.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    own = tempfile.mkdtemp(prefix="cuelake-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, never cleared here."""
    return f"{shared_dir(spark)}/cuelake/{name}-{uuid.uuid4().hex}"


def written(df, name: str):
    """Cut the lineage by a table in the shared folder; later readers can prune its columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Reliable checkpoint in the shared folder (survives lost executors)."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
