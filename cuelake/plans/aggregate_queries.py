"""Counts, classification metrics, calibration, latency, tf-idf, drift, promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuelake.functions import labels as L, vectors as V
from cuelake.operators import augment as A, calibrate as C, compare as P, curate as U, ingest as I, metrics as M, score as S, tfidf as X
from cuelake.plans import roles as R
from cuelake.plans.join_queries import COARSE_SQL, NLL_SQL
from cuelake.plans.registry import query
from cuelake.sources import objects as O

_D = f"WITH {R.DOCS_SQL}"
DIM_SQL = f"dim AS (SELECT unnest({R.list_sql(L.INTENTS)}) AS intent, unnest(range({len(L.INTENTS)})) AS ord)"
LABELS_SQL = f"lab AS (SELECT unnest({R.list_sql(R.ALL_LABELS)}) AS label)"


def r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("d01_intent_counts", f"""{_D}, {DIM_SQL}
SELECT part, dim.intent, CAST(count(docs.seq) AS BIGINT) AS n
FROM dim CROSS JOIN (SELECT DISTINCT part FROM docs) p LEFT JOIN docs USING (intent, part) GROUP BY ALL""")
def intent_counts(spark, sf):
    docs = R.documents(spark, sf)
    out = None
    for p in ("eval", "pool", "log"):
        one = U.intent_counts(docs.filter(F.col("part") == p)).select(F.lit(p).alias("part"), "intent", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("d02_shortfall", f"""{_D}, {DIM_SQL}, c AS (
  SELECT dim.intent, count(docs.seq) AS n FROM dim LEFT JOIN (SELECT * FROM docs WHERE part = 'eval') docs USING (intent) GROUP BY 1)
SELECT intent, CAST(30 - n AS BIGINT) AS needed FROM c WHERE n < 30""")
def shortfall(spark, sf):
    return U.shortfall(R.part(spark, sf, "eval"))


@query("d03_accuracy", f"""{R.SCORED_SQL}
SELECT suite, count(*) AS n, round(avg(CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM preds GROUP BY suite""")
def accuracy(spark, sf):
    return r6(M.accuracy(R.predictions(spark, sf), ["suite"]), "accuracy")


@query("d04_confusion", f"""{R.SCORED_SQL}, {LABELS_SQL}
SELECT a.label AS gold, b.label AS pred, CAST(count(p.vec_id) AS BIGINT) AS n
FROM lab a CROSS JOIN lab b LEFT JOIN preds p ON p.gold = a.label AND p.pred = b.label GROUP BY ALL""")
def confusion(spark, sf):
    return M.confusion(R.predictions(spark, sf), R.ALL_LABELS)


@query("d04_confusion_matrix", f"""{R.SCORED_SQL}, {LABELS_SQL}
SELECT a.label AS gold, {', '.join(f"CAST(count(CASE WHEN p.pred = '{x}' THEN 1 END) AS BIGINT) AS pred_{x}" for x in R.ALL_LABELS)}
FROM lab a LEFT JOIN preds p ON p.gold = a.label GROUP BY a.label""")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(R.predictions(spark, sf), R.ALL_LABELS)


def report_sql(preds: str = "preds", by: str = "") -> str:
    g = f"{by}, " if by else ""
    join = f"p.{by} = l.{by} AND " if by else ""
    lab = f"(SELECT DISTINCT {by}, label FROM {preds} CROSS JOIN lab)" if by else "lab"
    lg = f"l.{by}, " if by else ""
    return f"""
cnt AS (SELECT {lg}l.label, count(CASE WHEN p.gold = l.label AND p.pred = l.label THEN 1 END) AS tp,
    count(CASE WHEN p.gold <> l.label AND p.pred = l.label THEN 1 END) AS fp,
    count(CASE WHEN p.gold = l.label AND p.pred <> l.label THEN 1 END) AS fn
  FROM {lab} l LEFT JOIN {preds} p ON {join}(p.gold = l.label OR p.pred = l.label) GROUP BY ALL),
rep AS (SELECT {g}label, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1, CAST(tp + fn AS BIGINT) AS support FROM cnt)"""


@query("d05_class_report", f"""{R.SCORED_SQL}, {LABELS_SQL}, {report_sql()}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep""")
def class_report(spark, sf):
    return r6(M.class_report(R.predictions(spark, sf), R.ALL_LABELS), "precision", "recall", "f1")


@query("d05_report_averages", f"""{R.SCORED_SQL}, {LABELS_SQL}, {report_sql()}
SELECT round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
  round(sum(precision * support) / sum(support), 6) AS weighted_precision, round(sum(recall * support) / sum(support), 6) AS weighted_recall,
  round(sum(f1 * support) / sum(support), 6) AS weighted_f1, CAST(sum(support) AS BIGINT) AS support FROM rep""")
def report_averages(spark, sf):
    out = M.report_averages(M.class_report(R.predictions(spark, sf), R.ALL_LABELS))
    return r6(out, *[c for c in out.columns if c != "support"])


@query("d05_wilson_intervals", f"""{R.SCORED_SQL}, {LABELS_SQL}, {report_sql()},
w AS (SELECT label, tp / nullif(tp + fn, 0) AS p, nullif(tp + fn, 0)::DOUBLE AS n FROM cnt)
SELECT label, round((p + 3.8416 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS recall_low,
  round((p + 3.8416 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS recall_high FROM w""")
def wilson_intervals(spark, sf):
    out = M.class_report(R.predictions(spark, sf), R.ALL_LABELS, intervals=True)
    return out.select("label", F.round("recall_ci.low", 6).alias("recall_low"), F.round("recall_ci.high", 6).alias("recall_high"))


def ece_sql(preds: str = "preds", by: str = "suite") -> str:
    return f"""
eb AS (SELECT {by}, floor_bin AS bin, count(*) AS n, sum(CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END) AS ok, sum(conf) AS c
  FROM (SELECT *, len(list_filter(range(1, 11), lambda i: conf >= i * 0.1::DOUBLE)) AS floor_bin FROM {preds}) GROUP BY ALL),
ece AS (SELECT {by}, sum(CASE WHEN bin < 10 THEN abs(ok - c) ELSE 0 END) / sum(n) AS ece, CAST(sum(n) AS BIGINT) AS n FROM eb GROUP BY {by})"""


@query("d06_ece", f"{R.SCORED_SQL}, {ece_sql()} SELECT suite, round(ece, 6) AS ece, n FROM ece")
def ece(spark, sf):
    return r6(M.ece(R.predictions(spark, sf), ["suite"]), "ece")


@query("d06_ece_bins", f"""{R.SCORED_SQL}, {ece_sql()}
SELECT suite, CAST(bin AS INTEGER) AS bin, n, round(ok / n, 6) AS acc, round(c / n, 6) AS conf FROM eb WHERE bin < 10""")
def ece_bins(spark, sf):
    return r6(M.ece_bins(R.predictions(spark, sf), ["suite"]), "acc", "conf")


@query("d07_mean_nll", f"{NLL_SQL} SELECT round(avg(v), 6) AS nll, count(*) AS n FROM nll WHERE t = 1.0")
def mean_nll(spark, sf):
    known = C.with_gold_index(R.predictions(spark, sf).filter("suite = 'indist'"))
    return r6(M.mean_nll(known.withColumn("p_gold", F.get("probs", F.col("gold_idx")))), "nll")


@query("d08_mean_confidence", f"""{R.SCORED_SQL}, {R.preds_sql('warm', 'head', 2.0)}
SELECT a.suite, round(avg(a.conf), 6) AS mean_before, round(avg(b.conf), 6) AS mean_after
FROM preds a JOIN warm b USING (vec_id) GROUP BY a.suite""")
def mean_confidence(spark, sf):
    both = R.scored(spark, sf).select("suite", F.array_max(V.softmax(F.col("logits"))).alias("before"),
                                      F.array_max(V.softmax(V.scale(F.col("logits"), 2.0))).alias("after"))
    return r6(M.mean_confidence(both, ["before", "after"], ["suite"]), "mean_before", "mean_after")


def _threshold_sql(preds):
    return f"""
SELECT tau, CAST(count(CASE WHEN conf < tau THEN 1 END) AS BIGINT) AS n_deferred,
  round(avg(CASE WHEN conf < tau THEN 1.0 ELSE 0.0 END), 6) AS deferred_share,
  round(avg(CASE WHEN conf >= tau THEN CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END END), 6) AS kept_accuracy,
  round(avg(CASE WHEN conf < tau THEN CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END END), 6) AS deferred_accuracy
FROM {preds} CROSS JOIN (SELECT unnest([0.55::DOUBLE, 0.6::DOUBLE, 0.65::DOUBLE, 0.7::DOUBLE]) AS tau) GROUP BY tau"""


@query("d09_threshold_table", f"""{R.SCORED_SQL}, {R.preds_sql('cold', 'head', 0.6)}
SELECT 'raw' AS view, * FROM ({_threshold_sql('preds')}) UNION ALL SELECT 'scaled' AS view, * FROM ({_threshold_sql('cold')})""")
def threshold_table(spark, sf):
    cols = ["deferred_share", "kept_accuracy", "deferred_accuracy"]
    raw = M.threshold_table(R.predictions(spark, sf)).withColumn("view", F.lit("raw"))
    scaled = M.threshold_table(R.predictions(spark, sf, 0.6)).withColumn("view", F.lit("scaled"))
    return r6(raw.unionByName(scaled), *cols)


@query("d10_deferral_curve", f"""{R.SCORED_SQL}, cuts AS (SELECT unnest(range(101)) AS i)
SELECT suite, CAST(i AS INTEGER) AS cut, CAST(count(CASE WHEN conf < 0.5::DOUBLE + i * 0.005::DOUBLE THEN 1 END) AS BIGINT) AS n_deferred,
  round(avg(CASE WHEN conf < 0.5::DOUBLE + i * 0.005::DOUBLE THEN 100.0 ELSE 0.0 END), 6) AS pct_deferred
FROM preds CROSS JOIN cuts GROUP BY suite, i""")
def deferral_curve(spark, sf):
    return r6(M.deferral_curve(R.predictions(spark, sf)), "pct_deferred").drop("threshold")


@query("d11_gate_stats", f"""{R.SCORED_SQL}
SELECT {L.GATE}::DOUBLE AS threshold, round(avg(CASE WHEN suite = 'indist' THEN CASE WHEN conf >= {L.GATE} THEN 1.0 ELSE 0.0 END END), 3) AS in_distribution_kept_share,
  round(avg(CASE WHEN suite = 'ood' THEN CASE WHEN conf < {L.GATE} THEN 1.0 ELSE 0.0 END END), 3) AS ood_deferred_share,
  round(avg(CASE WHEN suite = 'indist' AND conf >= {L.GATE} THEN CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END END), 3) AS kept_accuracy
FROM preds""")
def gate_stats(spark, sf):
    pred = R.predictions(spark, sf)
    return M.gate_stats(pred.filter("suite = 'indist'"), pred.filter("suite = 'ood'"))


@query("d12_confidence_histogram", f"""{R.SCORED_SQL},
b AS (SELECT suite, least(len(list_filter(range(1, 21), lambda i: conf >= i * 0.05::DOUBLE)), 19) AS bin FROM preds),
t AS (SELECT suite, count(*) AS total FROM preds GROUP BY suite), g AS (SELECT suite, total, unnest(range(20)) AS bin FROM t)
SELECT g.suite, CAST(g.bin AS INTEGER) AS bin, count(b.bin) AS n, round(count(b.bin) / (any_value(total) * 0.05), 6) AS density
FROM g LEFT JOIN b ON g.suite = b.suite AND g.bin = b.bin GROUP BY g.suite, g.bin""")
def confidence_histogram(spark, sf):
    return r6(M.histogram(R.predictions(spark, sf)), "density")


@query("d13_latency", """
WITH s AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS r,
  count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, any_value(n) AS n, max(CASE WHEN r = n // 2 THEN value END) AS p50_rank,
  max(CASE WHEN r = CAST(floor(round(n * 0.95, 9)) AS BIGINT) THEN value END) AS p95_rank,
  round(quantile_cont(value, 0.5), 6) AS p50_linear, round(quantile_cont(value, 0.95), 6) AS p95_linear FROM s GROUP BY event_type""")
def latency(spark, sf):
    return r6(M.latency(R.table(spark, sf, "events"), "value", ["event_type"]), "p50_linear", "p95_linear")


@query("d13_latency_overall", """
WITH s AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS r, count(*) OVER () AS n FROM events)
SELECT any_value(n) AS n, max(CASE WHEN r = n // 2 THEN value END) AS p50_rank,
  max(CASE WHEN r = CAST(floor(round(n * 0.95, 9)) AS BIGINT) THEN value END) AS p95_rank,
  round(quantile_cont(value, 0.5), 6) AS p50_linear, round(quantile_cont(value, 0.95), 6) AS p95_linear FROM s""")
def latency_overall(spark, sf):
    return r6(M.latency(R.table(spark, sf, "events"), "value"), "p50_linear", "p95_linear")


INGEST_SQL = f"""{_D},
log AS (SELECT seq, text, client_label, {R.strip_sql("coalesce(text, '')")} AS raw, {R.key_sql(R.strip_sql("coalesce(text, '')"))} AS key,
  coalesce(client_label, '') = '' OR client_label IN ({', '.join(f"'{x}'" for x in L.INTENTS)}) AS usable FROM docs WHERE part = 'log'),
ev AS (SELECT DISTINCT {R.key_sql('text')} AS key FROM docs WHERE part = 'eval'),
f AS (SELECT key, min(seq) AS first_ok FROM (
  SELECT key, seq FROM log WHERE raw <> '' AND usable
  UNION ALL SELECT {R.key_sql('text')}, -1 FROM docs WHERE part = 'pool') GROUP BY key),
judged AS (SELECT log.*, CASE WHEN raw = '' THEN 'empty' WHEN ev.key IS NOT NULL THEN 'leak' WHEN seq > f.first_ok THEN 'dup'
    WHEN NOT usable THEN 'bad' WHEN coalesce(client_label, '') <> '' THEN 'client_label' ELSE 'teacher_label' END AS status
  FROM log LEFT JOIN ev USING (key) LEFT JOIN f USING (key))"""

COUNTS_SQL = f"""{INGEST_SQL}
SELECT s.status, CAST(count(judged.seq) AS BIGINT) AS n
FROM (SELECT unnest({R.list_sql(I.STATUSES)}) AS status) s LEFT JOIN judged USING (status) GROUP BY s.status"""


def ingest_inputs(spark, sf):
    return R.samples(spark, sf), R.part(spark, sf, "pool"), R.part(spark, sf, "eval")


def judged(spark, sf):
    return I.ingest_status(*ingest_inputs(spark, sf))


@query("d14_ingest_status_counts", COUNTS_SQL)
def ingest_status_counts(spark, sf):
    return I.status_counts(judged(spark, sf))


@query("d15_pull_and_class_counts", """
SELECT CASE WHEN json_type(text) = 'OBJECT' THEN 'written' ELSE 'skipped' END AS status, count(*) AS n
FROM (SELECT event_type, CASE WHEN event_type = 'error' THEN '[' || props || ']' ELSE props END AS text FROM events) GROUP BY ALL""")
def pull_and_class_counts(spark, sf):
    body = F.when(F.col("event_type") == "error", F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    objects = R.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("path"), body.alias("body"))
    return O.pull_counts(O.compact(objects))


@query("d16_duplicate_texts", "SELECT text, count(*) - 1 AS extra FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_texts(spark, sf):
    return U.duplicate_texts(R.table(spark, sf, "documents"))


@query("d17_class_weights", """
WITH c AS (SELECT label, count(*) AS n_c FROM embeddings GROUP BY label)
SELECT label, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight FROM c""")
def class_weights(spark, sf):
    return r6(M.class_weights(R.table(spark, sf, "embeddings"), "label"), "weight")


_TFIDF_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS toks FROM documents),
g AS (SELECT doc_id, unnest(list_concat(toks, list_transform(range(1, greatest(len(toks), 1)), lambda i: toks[i] || ' ' || toks[i + 1]))) AS term FROM t),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT doc_id, term, tf, df, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (term)),
x AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM w)"""


@query("d18_tfidf", f"""{_TFIDF_SQL}
SELECT doc_id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS grams, CAST(max(df) AS BIGINT) AS max_df,
  round(max(weight), 6) AS top_weight, round(sum(weight), 6) AS total_weight FROM x GROUP BY doc_id""")
def tfidf(spark, sf):
    rows = X.tfidf(R.table(spark, sf, "documents"), "doc_id")
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("tf").alias("grams"), F.max("df").alias("max_df"),
        F.round(F.max("weight"), 6).alias("top_weight"), F.round(F.sum("weight"), 6).alias("total_weight"))


@query("d18_document_frequency", f"{_TFIDF_SQL} SELECT term, df, round(ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1, 6) AS idf FROM df")
def document_frequency(spark, sf):
    docs = R.table(spark, sf, "documents")
    return r6(X.idf(X.document_frequency(X.term_counts(docs, "doc_id")), docs), "idf")


@query("d19_class_drift", """
WITH e AS (SELECT event_type, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'before' ELSE 'after' END AS period FROM events),
c AS (SELECT event_type, count(CASE WHEN period = 'before' THEN 1 END) AS b, count(CASE WHEN period = 'after' THEN 1 END) AS a FROM e GROUP BY 1),
s AS (SELECT event_type, (b + 0.5::DOUBLE) / (sum(b) OVER () + 0.5::DOUBLE * count(*) OVER ()) AS pb,
  (a + 0.5::DOUBLE) / (sum(a) OVER () + 0.5::DOUBLE * count(*) OVER ()) AS pa FROM c)
SELECT event_type, round(pb, 6) AS share_before, round(pa, 6) AS share_after, round((pa - pb) * ln(pa / pb), 9) AS psi FROM s""")
def class_drift(spark, sf):
    period = F.when(F.col("ts").cast("timestamp") < F.lit("2024-01-16").cast("timestamp"), "before").otherwise("after")
    rows = R.table(spark, sf, "events").withColumn("period", period)
    out = P.drift(rows, "event_type", "period", "before", "after")
    return r6(out, "share_before", "share_after").withColumn("psi", F.round("psi", 9))


@query("d20_promotion_gate", f"""{COARSE_SQL},
m AS (SELECT a.suite, avg(CASE WHEN b.pred = b.gold THEN 1.0 ELSE 0.0 END) AS cur, avg(CASE WHEN a.pred = a.gold THEN 1.0 ELSE 0.0 END) AS cand
  FROM preds a JOIN cpreds b USING (vec_id) GROUP BY a.suite)
SELECT suite, round(cur, 6) AS current_accuracy, round(cand, 6) AS candidate_accuracy, true AS same_ids, cand > cur AS promote FROM m""")
def promotion_gate(spark, sf):
    out = P.promote(R.coarse_predictions(spark, sf), R.predictions(spark, sf), "vec_id", "suite")
    return r6(out, "current_accuracy", "candidate_accuracy")
