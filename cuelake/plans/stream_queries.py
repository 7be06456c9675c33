"""Streaming jobs, run to the end of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuelake.functions import keys as K, labels as L
from cuelake.plans import roles as R
from cuelake.plans.registry import query
from cuelake.session import scratch_path
from cuelake.sources import keyed_store as KS
from cuelake.streaming import jobs as J

_D = f"WITH {R.DOCS_SQL}"


def stream(spark, sf, name):
    """The table's files; the pattern names one path, be it a file or a folder of files."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.[p]arquet")


def _drain(spark, df, name):
    out = scratch_path(spark, name)
    J.run_available(df, out, scratch_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(df.schema).parquet(out)


@query("i01_stream_redaction", f"""
SELECT doc_id, {R.norm_sql(R.strip_sql('text'))} AS text, true AS redacted FROM documents WHERE {R.norm_sql(R.strip_sql('text'))} <> ''""")
def stream_redaction(spark, sf):
    return _drain(spark, J.redact_stream(stream(spark, sf, "documents").select("doc_id", "text")), "captured")


@query("i02_stream_dedup", f"""
SELECT DISTINCT {R.key_sql("event_type || ' by ' || CAST(user_id AS VARCHAR)")} AS key FROM events""")
def stream_dedup(spark, sf):
    text = F.concat_ws(" by ", "event_type", F.col("user_id").cast("string"))
    rows = stream(spark, sf, "events").select("ts", text.alias("text"))
    deduped = J.dedup_stream(rows, "ts", "30 days").select(K.key_redacted(F.col("text")).alias("key"))
    return _drain(spark, deduped, "deduped")


@query("i03_stream_leak_filter", f"""{_D}
SELECT seq AS doc_id FROM docs WHERE {R.key_sql('text')} NOT IN (SELECT {R.key_sql('text')} FROM docs WHERE part = 'eval')""")
def stream_leak_filter(spark, sf):
    rows = stream(spark, sf, "documents").select("doc_id", "text")
    clean = J.filter_leaks_stream(rows, R.texts(spark, sf).filter("part = 'eval'")).select("doc_id")
    return _drain(spark, clean, "clean")


def _monitor_sql(size, slide, closed=False):
    n = size // slide
    only = f"WHERE w + INTERVAL {size} DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY" if closed else ""
    return f"""WITH {R.EVENT_PRED_SQL},
x AS (SELECT *, unnest(range({n})) AS back FROM ep),
y AS (SELECT intent, conf, ms, to_timestamp((epoch_us(ts) // (86400000000 * {slide}) - back) * 86400 * {slide}) AT TIME ZONE 'UTC' AS w FROM x)
SELECT strftime(w, '%Y-%m-%d') AS day, intent, count(*) AS n,
  round(avg(CASE WHEN conf < {L.GATE} OR intent = 'none' THEN 1.0 ELSE 0.0 END), 6) AS deferral_rate, round(avg(ms), 6) AS mean_ms
FROM y {only} GROUP BY 1, 2"""


def _by_day(m):
    return m.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "intent", "n",
                    F.round("deferral_rate", 6).alias("deferral_rate"), F.round("mean_ms", 6).alias("mean_ms"))


@query("i04_monitor_tumbling", _monitor_sql(1, 1))
def monitor_tumbling(spark, sf):
    return _by_day(J.monitor(R.event_predictions(spark, sf), "ts", "1 day"))


@query("i04_monitor_sliding", _monitor_sql(2, 1))
def monitor_sliding(spark, sf):
    return _by_day(J.monitor(R.event_predictions(spark, sf), "ts", "2 days", "1 day"))


@query("i04_monitor_stream", _monitor_sql(2, 1, closed=True))
def monitor_stream(spark, sf):
    """Append mode: windows the watermark has passed."""
    rows = R.as_event_predictions(stream(spark, sf, "events"))
    return _by_day(_drain(spark, J.monitor(rows, "ts", "2 days", "1 day", watermark="1 day"), "monitor"))


@query("i05_stream_append", f"""{_D} SELECT count(DISTINCT {R.key_sql('text')}) AS n, count(DISTINCT {R.key_sql('text')}) AS keys FROM docs""")
def stream_append(spark, sf):
    """The whole input twice, the second time without its checkpoint."""
    out = scratch_path(spark, "accepted")
    rows = stream(spark, sf, "documents").select("text", F.col("lang").alias("intent"))
    for run in ("first", "replay"):
        J.append_accepted(rows, out, scratch_path(spark, f"accepted-{run}"))
    stored = KS.stored_rows(spark, out)
    return stored.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(K.key_redacted(F.col("text"))).alias("keys"))
