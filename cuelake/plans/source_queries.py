"""Scans and sinks, on files Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuelake.functions import keys as K, labels as L, text as T
from cuelake.operators import metrics as M, score as S
from cuelake.plans import roles as R
from cuelake.plans.aggregate_queries import LABELS_SQL, ece_sql, report_sql
from cuelake.plans.registry import query
from cuelake.session import scratch_path
from cuelake.sources import keyed_store as KS, lines as LN, manifest as MF, objects as O, sinks as SK

_D = f"WITH {R.DOCS_SQL}"
_ENUM = ", ".join(f"'{x}'" for x in L.INTENTS)


def _summary(df, kind, intent):
    return df.groupBy(kind.alias("kind"), intent.alias("intent")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("seq").alias("positions"))


@query("a01_strict_scan", f"""{_D},
x AS (SELECT CASE WHEN client_label IS NULL THEN 'missing_key' WHEN client_label NOT IN ({_ENUM}) THEN 'unknown_intent' ELSE 'example' END AS kind, client_label FROM docs)
SELECT kind, CASE WHEN kind = 'example' THEN client_label ELSE '' END AS intent, count(*) AS n, count(*) AS positions FROM x GROUP BY ALL""")
def strict_scan(spark, sf):
    out = scratch_path(spark, "labeled")
    R.documents(spark, sf).select("text", F.col("client_label").alias("intent")).write.json(out)
    scan = LN.scan_labeled(spark, out)
    return _summary(scan.examples, F.lit("example"), F.col("intent")).unionByName(
        _summary(scan.violations, F.col("reason"), F.lit("")))


@query("a02_directory_scan", f"""{_D}
SELECT intent, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, count(*) AS positions FROM docs WHERE part = 'pool' GROUP BY intent""")
def directory_scan(spark, sf):
    """The pool's files count; files below a subfolder (raw samples) do not."""
    out = scratch_path(spark, "pool")
    docs = R.documents(spark, sf)
    docs.filter("part = 'pool'").select("text", "intent").write.json(out)
    docs.filter("part = 'log'").select("text").write.json(f"{out}/raw")
    rows = LN.load_labeled(spark, out, glob="*.json")
    return rows.groupBy("intent").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"),
                                      F.countDistinct("seq").alias("positions"))


@query("a03_lenient_scan", f"""{_D}
SELECT CASE WHEN lang IN ('de', 'es') THEN 'reject' ELSE 'sample' END AS kind, coalesce(CASE WHEN lang NOT IN ('de', 'es') THEN client_label END, '') AS label,
  count(*) AS n FROM docs GROUP BY ALL""")
def lenient_scan(spark, sf):
    body = F.to_json(F.struct("text", "client_label"))
    line = (F.when(F.col("lang") == "de", F.substring(body, 1, 12))
            .when(F.col("lang") == "es", F.concat(F.lit("["), body, F.lit("]"))).otherwise(body))
    out = scratch_path(spark, "log")
    R.documents(spark, sf).select(line).write.text(out)
    samples, rejects = LN.scan_samples(spark, out)
    kinds = samples.select(F.lit("sample").alias("kind"), F.coalesce("client_label", F.lit("")).alias("label"))
    both = kinds.unionByName(rejects.select(F.lit("reject").alias("kind"), F.lit("").alias("label")))
    return both.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n"))


@query("a04_compaction", """
WITH per AS (SELECT lang, source, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ALL)
SELECT 'written' AS status, lang, count(*) AS n, CAST(sum(chars) AS BIGINT) AS chars FROM per WHERE lang <> 'es' GROUP BY lang
UNION ALL SELECT 'skipped', '', count(*), 0 FROM per WHERE lang = 'es'""")
def compaction(spark, sf):
    """One object per language and source, cut short for one language; pulled, and the snapshot read again."""
    out, snapshot = scratch_path(spark, "objects"), scratch_path(spark, "pulled")
    per = R.table(spark, sf, "documents").groupBy("lang", "source").agg(F.sum("n_chars").cast("string").alias("text"))
    body = F.to_json(F.struct("text", F.col("lang").alias("client_label")))
    objects = per.select("lang", "source", F.when(F.col("lang") == "es", F.substring(body, 1, 6)).otherwise(body).alias("value"))
    objects.repartition("lang", "source").write.partitionBy("lang", "source").text(out)
    counts = O.pull(spark, out, snapshot, glob="*.txt")
    rows = spark.read.parquet(snapshot).groupBy(F.col("client_label").alias("lang")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("text").cast("long")).alias("chars"))
    skipped = counts.filter("status = 'skipped'").select("status", F.lit("").alias("lang"), "n", F.lit(0).cast("long").alias("chars"))
    return rows.select(F.lit("written").alias("status"), "lang", "n", "chars").unionByName(skipped)


@query("a05_prefix_pull", """
WITH o AS (SELECT strftime(ts, '%Y-%m-%d') AS date, event_type, max(event_id) AS top FROM events GROUP BY ALL),
m AS (SELECT max(substr(date, 1, 9)) AS start FROM o)
SELECT date, count(*) AS n, CAST(sum(top) AS BIGINT) AS tops FROM o, m WHERE starts_with(date, start) GROUP BY date""")
def prefix_pull(spark, sf):
    """One object per date and event type; those of the last ten-day stretch, by a prefix that ends inside the date."""
    out, snapshot = scratch_path(spark, "samples"), scratch_path(spark, "pulled")
    date = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd")
    per = R.table(spark, sf, "events").groupBy(date.alias("date"), "event_type").agg(F.max("event_id").cast("string").alias("text"))
    per = per.withColumn("device", F.col("event_type")).withColumnRenamed("event_type", "client_label")
    per.repartition("date", "device").write.partitionBy("date", "device").json(out)
    start = per.agg(F.max(F.substring("date", 1, 9))).first()[0]
    O.pull(spark, out, snapshot, prefix=f"date={start}")
    rows = spark.read.parquet(snapshot).groupBy(F.substring("date", 6, 10).alias("date"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("text").cast("long")).alias("tops"))


@query("a05_key_layout", """
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, count(DISTINCT user_id) AS devices, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1""")
def key_layout(spark, sf):
    ts = F.col("ts").cast("timestamp")
    path = F.concat_ws("/", F.lit("samples"), F.date_format(ts, "yyyy-MM-dd"), F.concat(F.lit("dev"), "user_id"),
                       F.concat(F.unix_micros(ts), F.lit("-"), "event_id", F.lit(".json")))
    parts = R.table(spark, sf, "events").select(O.key_parts(path).alias("k")).select("k.*")
    return parts.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("device").alias("devices"),
                                     F.sum(F.col("uuid").cast("long")).alias("ids"))


@query("a06_line_list", rf"""
WITH l AS (SELECT {R.strip_sql('unnest(string_split(text, chr(10)))')} AS line FROM conversations)
SELECT line, count(*) AS n FROM l WHERE line <> '' AND line NOT LIKE '#%' GROUP BY line""")
def line_list(spark, sf):
    out = scratch_path(spark, "list")
    commented = F.concat(F.lit("  # turn "), F.col("turn").cast("string"), F.lit("\n\n"), F.col("text"))
    R.table(spark, sf, "conversations").select(commented).write.text(out)
    return LN.read_line_list(spark, out).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("a07_side_input_default", """
SELECT lang, count(*) AS n, 1.0::DOUBLE AS temperature, (SELECT CAST(max(item_id) AS DOUBLE) FROM benchmark) AS top_item
FROM documents GROUP BY lang""")
def side_input_default(spark, sf):
    """One side input has no row and takes its default, the other is present."""
    per_lang = R.table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    absent = R.table(spark, sf, "labels").filter("quality > 1").select(F.col("quality").cast("double").alias("temperature"))
    present = R.table(spark, sf, "benchmark").agg(F.max("item_id").cast("double").alias("top_item"))
    return SK.with_default(SK.with_default(per_lang, absent, "temperature", 1.0), present, "top_item", -1.0)


@query("a08_snapshot_sink", f"{_D} SELECT intent, count(*) AS n FROM docs WHERE part = 'eval' GROUP BY intent")
def snapshot_sink(spark, sf):
    """The second snapshot replaces the first."""
    out = scratch_path(spark, "snapshot")
    for name in ("pool", "eval"):
        SK.write_snapshot(R.part(spark, sf, name), out)
    return LN.load_labeled(spark, out).groupBy("intent").agg(F.count(F.lit(1)).alias("n"))


@query("a09_idempotent_append", f"{_D} SELECT count(DISTINCT {R.key_sql('text')}) AS n, count(DISTINCT {R.key_sql('text')}) AS keys FROM docs")
def idempotent_append(spark, sf):
    """Pool first, then everything twice: every key is stored once."""
    out = scratch_path(spark, "collected")
    docs = R.documents(spark, sf).withColumn("text", T.normalize_text(F.col("text")))
    for rows in (docs.filter("part = 'pool'"), docs, docs):
        KS.append_keyed(rows, out)
    stored = KS.stored_rows(spark, out)
    return stored.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(K.key_redacted(F.col("text"))).alias("keys"))


@query("a10_metrics_sink", f"""{R.SCORED_SQL}, {LABELS_SQL}, {report_sql('preds', 'suite')}, {ece_sql()}
SELECT suite, metric, class, round(value, 6) AS value FROM (
  SELECT suite, 'ece' AS metric, '' AS class, ece AS value FROM ece
  UNION ALL SELECT suite, 'f1', label, f1 FROM rep UNION ALL SELECT suite, 'support', label, support FROM rep)""")
def metrics_sink(spark, sf):
    """Written and read back, table and JSON documents; the documents must hold every entry."""
    out = scratch_path(spark, "metrics")
    pred = R.predictions(spark, sf).withColumn("model", F.lit("centroid"))
    SK.write_metrics(M.evaluation_report(pred, R.ALL_LABELS), out)
    docs = spark.read.schema("model string, suite string, document string").json(f"{out}/documents")
    entries = docs.select("suite", F.explode(F.from_json("document", "map<string,double>")).alias("name", "value"))
    parts = F.split("name", r"\.", 2)
    rows = entries.select("suite", parts[0].alias("metric"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("class"),
                          F.round("value", 6).alias("value"))
    return rows.filter(F.col("metric").isin("ece", "f1", "support"))


@query("a11_head_table", f"""{R.SCORED_SQL}
SELECT suite, pred, count(*) AS n, round(avg(conf), 6) AS conf FROM preds GROUP BY ALL""")
def head_table(spark, sf):
    out = scratch_path(spark, "head")
    SK.save_head(R.head(spark, sf), out)
    pred = S.predict(S.with_logits(R.embeddings(spark, sf), SK.load_head(spark, out)), decimals=R.DECIMALS)
    return pred.groupBy("suite", "pred").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("conf"), 6).alias("conf"))


@query("a12_manifest", """
WITH per AS (SELECT source, lang, CAST(count(*) AS VARCHAR) || ':' || CAST(sum(n_chars) AS VARCHAR) || chr(10) AS body FROM documents GROUP BY ALL)
SELECT source, lang, md5(body) AS md5, CAST(length(body) AS BIGINT) AS size,
  CASE lang WHEN 'de' THEN 'extra' WHEN 'fr' THEN 'changed' ELSE 'ok' END AS status FROM per
UNION ALL SELECT source, 'xx', '', 0, 'missing' FROM (SELECT DISTINCT source FROM documents)""")
def manifest(spark, sf):
    """One file per source and language; one language unlisted, one listed wrongly, one gone."""
    out = scratch_path(spark, "files")
    per = R.table(spark, sf, "documents").groupBy("source", "lang").agg(F.concat_ws(
        ":", F.count(F.lit(1)).cast("string"), F.sum("n_chars").cast("string")).alias("value"))
    per.repartition("source", "lang").write.partitionBy("source", "lang").text(out)
    actual = MF.build_manifest(spark, out, glob="*.txt")
    lang = F.regexp_extract("path", "lang=([a-z]+)", 1)
    listed = actual.filter(lang != "de").select("path", F.when(lang == "fr", "0").otherwise(F.col("md5")).alias("md5"), "size")
    gone = per.select("source").distinct().select(
        F.concat(F.lit("source="), "source", F.lit("/lang=xx/part.txt")).alias("path"), F.lit("0").alias("md5"), F.lit(0).cast("long").alias("size"))
    checked = MF.verify_manifest(actual, listed.unionByName(gone)).join(actual, "path", "left")
    return checked.select(F.regexp_extract("path", "source=([a-z0-9]+)", 1).alias("source"), lang.alias("lang"),
                          F.coalesce("md5", F.lit("")).alias("md5"), F.coalesce("size", F.lit(0)).alias("size"), "status")
