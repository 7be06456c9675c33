"""Sinks: snapshots, idempotent appends, metrics documents, head tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cuelake.functions import keys as K
from cuelake.operators.skew import exclude_keys

HEAD_SCHEMA = "idx int, label string, coef array<double>, intercept double, temperature double"


def write_snapshot(examples: DataFrame, out: str) -> None:
    """Overwrite ``out`` with ``{text, intent}`` JSONL."""
    examples.select("text", "intent").write.mode("overwrite").json(out)


def append_new(rows: DataFrame, out: str, key: Column | None = None) -> None:
    """Append the (text, intent) rows whose ingest key is not in ``out`` yet.

    Running it again with the same rows adds nothing. Within one batch the rows are
    expected to be unique by key (the ingest operator returns them so). Every append
    reads and redacts all of ``out``; a store that grows belongs in ``keyed_store``.
    """
    spark = rows.sparkSession
    rows = rows.select("text", "intent")
    key = F.col("text") if key is None else key
    try:
        stored = spark.read.schema("text string, intent string").json(out)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        keyed = rows.withColumn("_key", K.digest(K.key_redacted(key)))
        seen = stored.select(K.digest(K.key_redacted(F.col("text"))).alias("_key"))
        rows = exclude_keys(keyed, seen, "_key").drop("_key")
    rows.write.mode("append").json(out)


def metrics_document(metrics: DataFrame) -> DataFrame:
    """One JSON document per (model, suite) from the long metrics table."""
    entry = F.struct(F.concat_ws(".", "metric", "class").alias("k"), F.col("value").alias("v"))
    per_group = metrics.groupBy("model", "suite").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("m"))
    return per_group.select("model", "suite", F.to_json("m").alias("document"))


def write_metrics(metrics: DataFrame, out: str) -> None:
    """Long table as Parquet, and the JSON documents beside it."""
    metrics.write.mode("overwrite").parquet(f"{out}/table")
    metrics_document(metrics).write.mode("overwrite").json(f"{out}/documents")


def save_head(head: DataFrame, out: str) -> None:
    head.select("idx", "label", "coef", "intercept", "temperature").write.mode("overwrite").parquet(out)


def load_head(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HEAD_SCHEMA).parquet(path)


def with_default(main: DataFrame, side: DataFrame, col: str, default) -> DataFrame:
    """Attach a 0- or 1-row side input's column; ``default`` when it has no row."""
    value = side.agg(F.coalesce(F.first(col, ignorenulls=True), F.lit(default)).alias(col))
    return main.join(F.broadcast(value))
