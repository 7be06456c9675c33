"""Streaming forms: redaction at capture, bounded dedup, leak filter, monitoring.

Every job takes a streaming DataFrame and returns one; ``run_available`` drains what
is there and stops, the way a scheduled catch-up run would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cuelake.functions import keys as K, labels as L, text as T
from cuelake.operators.skew import BROADCAST_ROWS, small_enough
from cuelake.sources.keyed_store import append_keyed


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Write all available input to Parquet and wait for it."""
    (stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start(out).awaitTermination())


def redact_stream(stream: DataFrame, text: str = "text") -> DataFrame:
    """Redact at capture: only the redacted text goes on, flagged as such."""
    # Redaction leaves nothing exactly where stripping the closing run does; testing that on
    # the raw text keeps the pushed-down filter from redacting every row twice.
    said = stream.filter(T.strip_terminal_punct(F.coalesce(text, F.lit(""))) != "")
    return said.withColumn(text, T.normalize_text(T.strip(F.col(text)))).withColumn("redacted", F.lit(True))


def dedup_stream(stream: DataFrame, ts: str, watermark: str = "1 day", text: str = "text",
                 salts: int = 32) -> DataFrame:
    """First arrival per ingest key; state older than the watermark is dropped.

    Two rounds: per (key, salt), then per key. A key that floods the stream is thinned to
    ``salts`` rows spread over as many state partitions before its single owner sees it.
    A key may come back after its state has expired; the idempotent append catches it.
    """
    keyed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withColumn(
        "key", K.digest(K.key_redacted(F.col(text)))).withColumn(
        "_salt", F.pmod(F.xxhash64(ts), F.lit(salts)))
    thinned = keyed.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(["key", "_salt"])
    return thinned.dropDuplicatesWithinWatermark(["key"]).drop("_salt")


def filter_leaks_stream(stream: DataFrame, evals: DataFrame, text: str = "text",
                        limit: int = BROADCAST_ROWS) -> DataFrame:
    """Drop rows whose ingest key is in the eval sets (stream-static anti-join)."""
    block = evals.select(K.digest(K.key_redacted(F.col("text"))).alias("_b")).distinct()
    side = F.broadcast(block) if small_enough(block, limit) else block
    keyed = stream.withColumn("_k", K.digest(K.key_redacted(F.col(text))))
    return keyed.join(side, F.col("_k") == F.col("_b"), "left_anti").drop("_k")


def monitor(predictions: DataFrame, ts: str, window: str, slide: str | None = None,
            watermark: str | None = None, intent: str = "intent", conf: str = "conf",
            ms: str = "ms", gate: float = L.GATE) -> DataFrame:
    """Per window and intent: rows, deferral rate, mean latency. Batch or streaming.

    With a watermark, append mode emits a window once the watermark has passed it.
    """
    rows = predictions.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark:
        rows = rows.withWatermark(ts, watermark)
    deferred = (L.gate_action(F.col(conf), F.col(intent), gate) == "defer").cast("double")
    grouped = rows.groupBy(F.window(ts, window, slide or window).alias("w"), F.col(intent).alias("intent"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.avg(deferred).alias("deferral_rate"),
                       F.avg(ms).alias("mean_ms")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "intent", "n", "deferral_rate", "mean_ms")


def window_shares(monitored: DataFrame) -> DataFrame:
    """Each intent's share of its window (a batch step over the small monitor table)."""
    totals = monitored.groupBy("window_start", "window_end").agg(F.sum("n").alias("_t"))
    return monitored.join(totals, ["window_start", "window_end"]).withColumn(
        "share", F.col("n") / F.col("_t")).drop("_t")


def append_accepted(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append to a keyed store: replaying the input, even without its checkpoint, adds nothing.

    A micro-batch is reduced to one row per ingest key and looked up in the store's
    partitions of its own keys, so its work does not grow with the texts stored.
    """
    (stream.select("text", "intent").writeStream.foreachBatch(lambda batch, _epoch: append_keyed(batch, out) and None)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
