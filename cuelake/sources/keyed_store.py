"""A store of unique rows that appends look up by key, without reading what is stored.

The store is one Parquet table of digest and row, partitioned by the first hex digits of
the digest. An append reads the digest column of the partitions its own digests fall in
and nothing else, and rows and keys are committed by the same write, so a writer lost
half-way leaves either both or neither. One writer at a time is expected.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cuelake.functions import keys as K
from cuelake.operators.skew import BROADCAST_ROWS, small_enough
from cuelake.session import scratch_path

PREFIX_DIGITS = 2
SCHEMA = "digest binary, text string, intent string, prefix string"


def _prefix(digest: Column, digits: int) -> Column:
    return F.lower(F.substring(F.hex(digest), 1, digits))


def read_store(spark: SparkSession, path: str) -> DataFrame | None:
    """digest, text, intent and prefix of a store, None where there is none yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """``read_store``, without rows where there is no store."""
    store = read_store(spark, path)
    return spark.createDataFrame([], SCHEMA) if store is None else store


def _digits_of(store: DataFrame) -> int | None:
    """Digits of a store's prefixes, None while it is empty."""
    row = store.select(F.length("prefix")).limit(1).first()
    return row and row[0]


def known_digests(store: DataFrame, batch: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Digests of ``batch`` (digest, prefix) that the store holds.

    Only the batch's prefixes are read: their list is bounded by the number of prefixes.
    A short batch is sent to the store's partitions, else both sides are shuffled.
    """
    prefixes = sorted(r["prefix"] for r in batch.select("prefix").distinct().collect())
    stored = store.filter(F.col("prefix").isin(prefixes)).select("prefix", "digest")
    wanted = batch.select("prefix", "digest")
    wanted = F.broadcast(wanted) if small_enough(wanted, limit) else wanted
    return stored.join(wanted, ["prefix", "digest"], "left_semi").select("digest")


def known_keys(store: DataFrame, keys: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Those of ``keys`` (key) that the store holds, read as ``known_digests`` does."""
    digits = _digits_of(store)
    if digits is None:
        return keys.limit(0)
    digest = keys.select(F.col("key").alias("digest")).distinct()
    return known_digests(store, digest.withColumn("prefix", _prefix(F.col("digest"), digits)), limit).withColumnRenamed("digest", "key")


def append_keyed(rows: DataFrame, path: str, key: Column | None = None, digits: int = PREFIX_DIGITS) -> int:
    """Append the (text, intent) rows whose ingest key the store does not hold; how many.

    Rows without a text have no key and are left out. Of rows of a batch that share a
    key, the smallest (text, intent) is stored. Running
    it again with the same rows adds nothing. An existing store keeps its own number of
    digits. Each row is redacted once, whatever the store holds.
    """
    spark = rows.sparkSession
    store = read_store(spark, path)
    digits = (store is not None and _digits_of(store)) or digits
    text = F.col("text") if key is None else key
    keyed = rows.select(K.digest(K.key_redacted(text)).alias("digest"), F.struct("text", "intent").alias("row")).filter("digest IS NOT NULL")
    unique = keyed.groupBy("digest").agg(F.min("row").alias("row")).select("digest", "row.*", _prefix(F.col("digest"), digits).alias("prefix"))
    at = scratch_path(spark, "keyed-batch")
    unique.write.parquet(at)
    batch = spark.read.schema(SCHEMA).parquet(at)
    if store is not None:
        batch = batch.join(known_digests(store, batch), "digest", "left_anti")
    new = batch.select("digest", "text", "intent", "prefix")
    counted = new.count()
    if counted:
        # One file per prefix and append; ``compact_store`` joins them.
        new.repartition("prefix").write.mode("append").partitionBy("prefix").parquet(path)
    return counted


def compact_store(spark: SparkSession, path: str, out: str, rows_per_file: int = 1_000_000) -> None:
    """The store again at ``out``, in files of about ``rows_per_file`` rows per prefix."""
    store = read_store(spark, path)
    if store is None:
        raise ValueError(f"no store at {path}")
    sizes = store.groupBy("prefix").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    dealt = store.join(F.broadcast(sizes), "prefix").withColumn("_file", F.pmod(F.xxhash64("digest"), F.col("_files")))
    (dealt.repartition("prefix", "_file").sortWithinPartitions("prefix", "digest").drop("_files", "_file")
     .write.partitionBy("prefix").parquet(out))
