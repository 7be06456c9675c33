"""Joins: overlap, exclusion, partners, gold and predictions, comparisons, containment."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuelake.functions import keys as K
from cuelake.functions.labels import CHAINABLE
from cuelake.operators import augment as A, calibrate as C, compare as P, curate as U
from cuelake.plans import roles as R
from cuelake.plans.registry import query

_D = f"WITH {R.DOCS_SQL}"


@query("c01_leaked_evals", f"""{_D}
SELECT seq, text FROM docs WHERE part = 'eval' AND {R.leak_sql('text')} IN
  (SELECT {R.leak_sql('text')} FROM docs WHERE part <> 'eval')""")
def leaked_evals(spark, sf):
    docs = R.texts(spark, sf)
    return U.leaked_evals(docs.filter("part = 'eval'"), docs.filter("part <> 'eval'")).select("seq", "text")


def _exclusion_sql(blocked, key):
    return f"""{_D} SELECT seq FROM docs WHERE part <> '{blocked}' AND {key('text')} NOT IN
  (SELECT {key('text')} FROM docs WHERE part = '{blocked}')"""


def _without(spark, sf, blocked, key):
    docs = R.texts(spark, sf)
    return U.without_keys_of(docs.filter(F.col("part") != blocked), docs.filter(F.col("part") == blocked), key).select("seq")


@query("c02_pool_exclusion", _exclusion_sql("pool", R.key_sql))
def pool_exclusion(spark, sf):
    return _without(spark, sf, "pool", K.key_redacted)


@query("c03_eval_exclusion", _exclusion_sql("eval", R.key_sql))
def eval_exclusion(spark, sf):
    return _without(spark, sf, "eval", K.key_redacted)


@query("c04_block_list", _exclusion_sql("eval", R.loose_sql))
def block_list(spark, sf):
    return _without(spark, sf, "eval", K.key_loose)


@query("c05_probe_exclusion", f"""
SELECT conv_id, turn FROM conversations WHERE {R.leak_sql('text')} NOT IN (SELECT {R.leak_sql('text')} FROM benchmark)""")
def probe_exclusion(spark, sf):
    conv = R.table(spark, sf, "conversations")
    return U.without_keys_of(conv, R.table(spark, sf, "benchmark")).select("conv_id", "turn")


_CHAINABLE = ", ".join(f"'{c}'" for c in CHAINABLE)


def partner_sql(source: str, bucket_rows: int, seed: int = 0) -> str:
    """CTE ``paired`` adding partner to source (seq, text, intent)."""
    return f"""
sizes AS (SELECT intent, ceil(count(*) / {bucket_rows}.0) AS b FROM {source} GROUP BY intent),
hashed AS (SELECT s.*, b, {R.hash_sql(seed, 'seq', "'partner'")} AS ph FROM {source} s JOIN sizes USING (intent)),
dealt AS (SELECT *, {R.idx_sql(R.u_sql('ph'), 'b')} AS bucket FROM hashed),
ring AS (SELECT *, coalesce(lead(text) OVER (PARTITION BY intent, bucket ORDER BY ph, seq),
    first_value(text) OVER (PARTITION BY intent, bucket ORDER BY ph, seq)) AS nxt FROM dealt),
paired AS (SELECT seq, text, intent, CASE WHEN nxt <> text THEN nxt END AS partner FROM ring)"""


def attempt_partner_sql(source: str, attempts: int, seed: int = 0) -> str:
    """CTEs ``dir`` (by place) and ``tried``: source (seq, text, intent) once per attempt, with n and partner."""
    return f"""
dir AS (SELECT intent, text, row_number() OVER (PARTITION BY intent ORDER BY {R.hash_sql(seed, 'seq', "'place'")}, seq) - 1 AS place FROM {source}),
sizes AS (SELECT intent, count(*) AS n FROM {source} GROUP BY intent),
numbered AS (SELECT s.*, n, unnest(range({attempts})) AS attempt FROM {source} s JOIN sizes USING (intent)),
drawn AS (SELECT *, {R.idx_sql(R.u_sql(R.hash_sql(seed, 'seq', 'attempt', "'partner'")), 'n')} AS at FROM numbered),
tried AS (SELECT t.*, CASE WHEN d.text <> t.text THEN d.text END AS partner FROM drawn t JOIN dir d ON d.intent = t.intent AND d.place = t.at)"""


@query("c06_partner_per_attempt", f"""WITH {R.UTTER_SQL}, {attempt_partner_sql('utter', A.ATTEMPTS)}
SELECT seq, CAST(attempt AS INTEGER) AS attempt, partner FROM tried""")
def partner_per_attempt(spark, sf):
    rows = R.utterances(spark, sf).select("seq", "text", "intent")
    tries = rows.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(A.ATTEMPTS - 1))))
    return A.attempt_partners(tries, A.directory(rows, "seq", 0), "seq", 0).select("seq", "attempt", "partner")


@query("c06_same_class_partner", f"WITH {R.UTTER_SQL}, {partner_sql('utter', 64)} SELECT seq, intent, partner FROM paired")
def same_class_partner(spark, sf):
    rows = R.utterances(spark, sf).select("seq", "text", "intent")
    return A.with_partner(rows, "seq", 0, bucket_rows=64).select("seq", "intent", "partner")


@query("c07_gold_join", f"""{R.SCORED_SQL}
SELECT e.vec_id, e.gold, p.pred FROM emb e JOIN preds p USING (vec_id)""")
def gold_join(spark, sf):
    pred = R.predictions(spark, sf).select("vec_id", "pred")
    return P.join_gold(R.embeddings(spark, sf).select("vec_id", "gold"), pred, "vec_id").select("vec_id", "gold", "pred")


COARSE_SQL = ",".join([R.SCORED_SQL, R.head_sql("chead", 1), R.preds_sql("cpreds", "chead")])


@query("c08_prediction_parity", f"""{COARSE_SQL}
SELECT count(*) AS n, CAST(sum(CASE WHEN a.pred = b.pred THEN 1 ELSE 0 END) AS BIGINT) AS matched,
  round(avg(CASE WHEN a.pred = b.pred THEN 1.0 ELSE 0.0 END), 6) AS match_rate
FROM preds a JOIN cpreds b USING (vec_id)""")
def prediction_parity(spark, sf):
    out = P.parity(R.predictions(spark, sf), R.coarse_predictions(spark, sf), "vec_id")
    return out.select("n", "matched", F.round("match_rate", 6).alias("match_rate"))


@query("c08_parity_mismatches", f"""{COARSE_SQL}
SELECT vec_id, a.pred AS pred_a, b.pred AS pred_b FROM preds a JOIN cpreds b USING (vec_id) WHERE a.pred <> b.pred""")
def parity_mismatches(spark, sf):
    return P.parity_rows(R.predictions(spark, sf), R.coarse_predictions(spark, sf), "vec_id")


@query("c09_thresholds_by_row", f"""{R.SCORED_SQL}
SELECT tau, CAST(sum(CASE WHEN conf < tau THEN 1 ELSE 0 END) AS BIGINT) AS n_deferred, count(*) AS n
FROM preds CROSS JOIN (SELECT unnest([0.55::DOUBLE, 0.6::DOUBLE, 0.65::DOUBLE, 0.7::DOUBLE]) AS tau) GROUP BY tau""")
def thresholds_by_row(spark, sf):
    from cuelake.operators import metrics as M
    out = M.threshold_table(R.predictions(spark, sf))
    n = F.round(F.col("n_deferred") / F.col("deferred_share")).cast("long")
    total = R.embeddings(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    return out.join(F.broadcast(total)).select("tau", "n_deferred", F.coalesce("n", n).alias("n"))


TEMPERATURES = [0.5, 0.75, 1.0, 1.5, 2.0, 4.0, 8.0, 20.0]
NLL_SQL = ",".join([R.SCORED_SQL, f"""
known AS (SELECT vec_id, z, CAST(gold AS INTEGER) + 1 AS g FROM preds WHERE suite = 'indist'),
grid AS (SELECT unnest({[float(t) for t in TEMPERATURES]}::DOUBLE[]) AS t),
nll AS (SELECT t, -ln(greatest(exp(z[g] / t - list_max(z) / t) /
    list_sum(list_transform(z, lambda x: exp(x / t - list_max(z) / t))), 1e-12)) AS v FROM known CROSS JOIN grid)"""])


@query("c10_temperature_grid", f"{NLL_SQL} SELECT t AS temperature, round(avg(v), 6) AS nll FROM nll GROUP BY t")
def temperature_grid(spark, sf):
    known = C.with_gold_index(R.scored(spark, sf).filter("suite = 'indist'"))
    return C.nll_grid(known, TEMPERATURES).select("temperature", F.round("nll", 6).alias("nll"))


_FP = "CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', {})), 1, 8)) AS BIGINT)) AS BIGINT)"


@query("c11_model_comparison", f"""WITH {R.DOCS_SQL},
cur AS (SELECT part AS suite, count(*) AS n, {_FP.format("CAST(seq AS VARCHAR), intent")} AS fp FROM docs GROUP BY part),
old AS (SELECT part AS suite, count(*) AS eval_n, {_FP.format("CAST(seq AS VARCHAR), client_label")} AS efp,
  avg(CASE WHEN client_label = intent THEN 1.0 ELSE 0.0 END) AS acc FROM docs WHERE client_label IS NOT NULL OR part = 'eval' GROUP BY part)
SELECT 'cached' AS model, suite, round(acc, 6) AS accuracy, eval_n, n, eval_n <> n AS stale, efp <> fp AS stale_content
FROM old JOIN cur USING (suite)""")
def model_comparison(spark, sf):
    docs = R.documents(spark, sf).withColumnRenamed("part", "suite")
    current = P.fingerprint(docs, ["suite"], ["seq", "intent"])
    seen = docs.filter("client_label is not null or suite = 'eval'")
    hit = F.coalesce((F.col("client_label") == F.col("intent")).cast("double"), F.lit(0.0))
    acc = seen.groupBy("suite").agg(F.avg(hit).alias("accuracy"))
    old = (P.fingerprint(seen, ["suite"], ["seq", "client_label"])
           .withColumnsRenamed({"n": "eval_n", "fingerprint": "eval_fingerprint"}).join(acc, "suite")
           .withColumn("model", F.lit("cached")))
    return P.compare_models(current, old).withColumn("accuracy", F.round("accuracy", 6))


_TOK = r"(' ' || trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' ')"


@query("c12_contained_passages", f"""
WITH d AS (SELECT doc_id, {_TOK.format('text')} AS s FROM documents),
b AS (SELECT item_id, {_TOK.format('text')} AS s FROM benchmark)
SELECT doc_id, item_id FROM d JOIN b ON contains(d.s, b.s)""")
def contained_passages(spark, sf):
    return U.contained_passages(R.table(spark, sf, "documents"), R.table(spark, sf, "benchmark"), "doc_id", "item_id")
