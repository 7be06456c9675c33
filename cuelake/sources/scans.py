"""Scan parallelism."""

from __future__ import annotations

from pyspark.sql import DataFrame

# A scan this small is not worth a shuffle to spread it.
SPREAD_BYTES = 1 << 20


def spread_scan(df: DataFrame, key: str) -> DataFrame:
    """Hash a scan over the cores when its files cannot be split that far.

    A Parquet file of one row group is one task however many cores wait. Inputs of
    cluster size have more splits than cores and are returned unchanged, unshuffled.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution()
    if int(plan.optimizedPlan().stats().sizeInBytes()) < SPREAD_BYTES:
        return df
    cores = spark.sparkContext.defaultParallelism
    return df if plan.toRdd().getNumPartitions() * 2 > cores else df.repartition(cores, key)
