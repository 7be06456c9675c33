"""The composite jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuelake.functions import disfluency as D, labels as L
from cuelake.operators import (augment as A, calibrate as C, curate as U, fit as FT, floor as FX, ingest as I,
                               metrics as M, ood as G, pairs as PR, score as S)
from cuelake.plans import roles as R
from cuelake.plans.aggregate_queries import (COUNTS_SQL, DIM_SQL, INGEST_SQL, LABELS_SQL, ece_sql, ingest_inputs, judged,
                                             r6, report_sql)
from cuelake.plans.aggregate_queries import _TFIDF_SQL
from cuelake.plans.join_queries import COARSE_SQL, attempt_partner_sql
from cuelake.plans.registry import query
from cuelake.session import scratch_path
from cuelake.sources.keyed_store import stored_rows
from cuelake.plans.text_queries import _weak_sql, chain_sql, variant_sql

_D = f"WITH {R.DOCS_SQL}"


# --- ingest ----------------------------------------------------------------------------

@query("h01_ingest_dry_run", COUNTS_SQL)
def ingest_dry_run(spark, sf):
    return I.dry_run(*ingest_inputs(spark, sf))


_TEACHER_SQL = f"""
teacher AS (SELECT {R.key_sql('text')} AS key, min({R._LANG_SQL}) AS answer FROM docs WHERE client_label IS NULL AND lang <> 'es' GROUP BY 1)"""


@query("h01_ingest_new_rows", f"""{INGEST_SQL}, {_TEACHER_SQL}
SELECT seq, {R.norm_sql('raw')} AS text, CASE status WHEN 'client_label' THEN client_label ELSE answer END AS intent,
  CASE status WHEN 'client_label' THEN 'client' ELSE 'teacher' END AS origin
FROM judged LEFT JOIN teacher USING (key) WHERE status = 'client_label' OR (status = 'teacher_label' AND answer IS NOT NULL)""")
def ingest_new_rows(spark, sf):
    run = I.run_ingest(*ingest_inputs(spark, sf), R.teacher(spark, sf))
    return run.new_rows.withColumnRenamed("source", "origin")


@query("h01_ingest_job", f"""{INGEST_SQL}, {_TEACHER_SQL},
per AS ({COUNTS_SQL[len(INGEST_SQL):]}),
stored AS (SELECT count(DISTINCT key) AS stored FROM judged LEFT JOIN teacher USING (key)
  WHERE status = 'client_label' OR (status = 'teacher_label' AND answer IS NOT NULL))
SELECT status, n, stored FROM per, stored""")
def ingest_job(spark, sf):
    """The job run twice on one store: counts taken by the first run's write, and what the store holds after both."""
    out = scratch_path(spark, "ingested")
    first, second = (I.run_ingest(*ingest_inputs(spark, sf), R.teacher(spark, sf), out) for _ in range(2))
    held = stored_rows(spark, out).count() + second.appended
    rows = [(status, n, held) for status, n in first.counts.items()]
    return spark.createDataFrame(rows, "status string, n long, stored long")


@query("h11_teacher_queue", f"""{INGEST_SQL}, {_TEACHER_SQL}
SELECT {R.norm_sql('raw')} AS text FROM judged LEFT JOIN teacher USING (key) WHERE status = 'teacher_label' AND answer IS NULL""")
def teacher_queue(spark, sf):
    return I.teacher_queue(judged(spark, sf), R.teacher(spark, sf)).select("text")


# --- augmentation ----------------------------------------------------------------------

_CH = ", ".join(f"'{c}'" for c in L.CHAINABLE)
_AUG_SQL = f"""WITH RECURSIVE {R.UTTER_SQL},
ch AS (SELECT seq, text, intent FROM utter WHERE intent IN ({_CH})), {attempt_partner_sql('ch', A.ATTEMPTS)},
tries AS (SELECT seq, text, intent, attempt, partner, n > 1 AS has_partners FROM tried
  UNION ALL SELECT seq, text, intent, unnest(range({A.ATTEMPTS})), NULL, false FROM utter WHERE intent NOT IN ({_CH})),
dh AS (SELECT *, {', '.join(f"{R.hash_sql(0, 'seq', 'attempt', str(i))} AS h{i}" for i in range(4))} FROM tries),
{variant_sql('dh')}, {chain_sql('v7')},
cand AS (SELECT seq, attempt, intent, text, CASE WHEN has_partners AND {R.u_sql('h0', 0)} < {D.P_CHAIN} THEN chained ELSE single END AS variant FROM c3),
keyed AS (SELECT *, {R.loose_sql('variant')} AS key, {R.loose_sql('text')} AS own FROM cand WHERE variant IS NOT NULL),
ok AS MATERIALIZED (SELECT seq, key, min(attempt) AS attempt FROM keyed WHERE key <> '' AND key <> own
  AND key NOT IN (SELECT {R.loose_sql('text')} FROM benchmark) GROUP BY seq, key),
alive AS (SELECT 0 AS round, seq, attempt, key FROM ok UNION ALL
  (WITH p AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY attempt) <= {A.PER_ROW} AS asks FROM alive),
    o AS (SELECT key, min(seq) AS owner FROM p WHERE asks GROUP BY key),
    lost AS (SELECT p.seq, p.key FROM p JOIN o USING (key) WHERE asks AND p.seq <> owner)
  SELECT p.round + 1, p.seq, p.attempt, p.key FROM p ANTI JOIN lost USING (seq, key) WHERE EXISTS (SELECT 1 FROM lost))),
last AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY attempt) AS m FROM alive WHERE round = (SELECT max(round) FROM alive)),
kept AS (SELECT cand.*, m FROM last JOIN cand USING (seq, attempt))"""


def _augmented(spark, sf):
    return A.augment(R.utterances(spark, sf), R.table(spark, sf, "benchmark"))


@query("g02_variant_cap", f"{_AUG_SQL} SELECT seq, CAST(attempt AS INTEGER) AS attempt FROM kept WHERE m <= {A.PER_ROW}")
def variant_cap(spark, sf):
    return _augmented(spark, sf).select("seq", "attempt")


@query("h02_augment", f"{_AUG_SQL} SELECT seq, variant AS text, intent FROM kept WHERE m <= {A.PER_ROW}")
def augment(spark, sf):
    return _augmented(spark, sf).select("seq", "text", "intent")


@query("h02_augment_counts", f"""{_AUG_SQL}
SELECT r.intent, CAST(count(k.seq) AS BIGINT) AS n FROM (SELECT unnest({R.list_sql(L.REAL_INTENTS)}) AS intent) r
LEFT JOIN (SELECT * FROM kept WHERE m <= {A.PER_ROW}) k USING (intent) GROUP BY r.intent""")
def augment_counts(spark, sf):
    return A.counts_by_intent(_augmented(spark, sf))


# --- out-of-distribution rows ----------------------------------------------------------

def _d(*salt):
    return R.hash_sql(11, "event_id", *salt)


def _ch(u, alphabet):
    return f"substr('{alphabet}', {R.idx_sql(u, len(alphabet))} + 1, 1)"


def _span(u, low, high):
    return f"({R.idx_sql(u, high - low + 1)} + {low})"


def _ood_sql():
    u = R.u_sql
    def h(*salt):
        return _d(*[f"'{x}'" for x in salt])
    def word(w):
        head, first, second = h("word", w), h("syllable", w, 1), h("syllable", w, 2)
        syl = [f"{_ch(u(x, i), G.CONSONANTS)} || {_ch(u(x, i + 1), G.VOWELS)}" for x, i in ((first, 0), (first, 2), (second, 0))]
        n = _span(u(head, 0), 1, 3)
        return (f"{syl[0]} || CASE WHEN {n} >= 2 THEN {syl[1]} ELSE '' END || CASE WHEN {n} >= 3 THEN {syl[2]} ELSE '' END || "
                f"CASE WHEN {u(head, 1)} < {G.P_CODA} THEN {_ch(u(head, 2), G.CONSONANTS)} ELSE '' END")
    n_words, n_chars, n_nums = _span(u(h("gibberish"), 0), 2, 6), _span(u(h("salad"), 0), 8, 24), _span(u(h("numbers"), 0), 2, 5)
    words = ", ".join(f"CASE WHEN {n_words} >= {w} THEN {word(w)} END" for w in range(1, 7))
    chars = " || ".join(_ch(u(h("char", b), i), G.SALAD) for b in range(6) for i in range(4))
    nums = ", ".join(f"CASE WHEN {n_nums} > {at} THEN CAST({_span(u(x, i), 0, 9999)} AS VARCHAR) END" for at, (x, i) in enumerate(
        [(h("numbers"), 1), (h("numbers"), 2), (h("numbers"), 3), (h("more"), 0), (h("more"), 1)]))
    at = f"{u(h('family'), 0)} * {float(sum(G.FAMILY_WEIGHTS.values()))}::DOUBLE"
    fixed = R.list_sql(G.FIXED_TEXTS)
    return f"""
WITH f AS (SELECT event_id, CASE WHEN {at} < 150 THEN 'gibberish' WHEN {at} < 230 THEN 'salad' ELSE 'numbers' END AS family FROM events),
made AS (SELECT event_id AS id, family, CASE family WHEN 'gibberish' THEN concat_ws(' ', {words})
  WHEN 'salad' THEN trim(substr({chars}, 1, {n_chars})) ELSE concat_ws(' ', {nums}) END AS text FROM f),
every AS (SELECT * FROM made UNION ALL SELECT -i AS id, 'fixed', {fixed}[i] FROM (SELECT unnest(range(1, {len(G.FIXED_TEXTS) + 1})) AS i)),
one AS (SELECT text, min(id) AS id, arg_min(family, id) AS family FROM every WHERE trim(text) <> '' GROUP BY text),
clean AS (SELECT * FROM one WHERE {R.leak_sql('text')} NOT IN (SELECT {R.leak_sql('text')} FROM benchmark)),
r AS (SELECT *, row_number() OVER (ORDER BY {R.hash_sql(11, 'id')}, id) AS r, count(*) OVER () AS n FROM clean)
SELECT id, family, text, 'none' AS intent, CASE WHEN r <= floor(n * 0.2) THEN 'eval' ELSE 'train' END AS part FROM r"""


@query("h03_ood_generation", _ood_sql())
def ood_generation(spark, sf):
    """One generated row per event id, plus the hand-written texts."""
    return G.make_ood(R.table(spark, sf, "events"), "event_id", R.table(spark, sf, "benchmark"))


# --- health ----------------------------------------------------------------------------

@query("h04_dataset_health", f"""{_D}, {DIM_SQL},
train AS (SELECT text, coalesce(client_label, intent) AS intent FROM docs WHERE part <> 'eval'), ev AS (SELECT * FROM docs WHERE part = 'eval'),
c AS (SELECT dim.intent, (SELECT count(*) FROM train t WHERE t.intent = dim.intent) AS nt, (SELECT count(*) FROM ev e WHERE e.intent = dim.intent) AS ne FROM dim),
leaks AS (SELECT {R.leak_sql('text')} AS k FROM ev WHERE {R.leak_sql('text')} IN (SELECT {R.leak_sql('text')} FROM train))
SELECT "check", key, CAST(value AS BIGINT) AS value FROM (
  SELECT 'train_count' AS "check", intent AS key, nt AS value FROM c UNION ALL SELECT 'eval_count', intent, ne FROM c
  UNION ALL SELECT 'eval_needed', intent, 30 - ne FROM c WHERE ne < 30
  UNION ALL SELECT 'leaked_evals', '', count(*) FROM leaks UNION ALL SELECT 'shared_keys', '', count(DISTINCT k) FROM leaks
  UNION ALL SELECT 'duplicate_rows', '', count(*) - count(DISTINCT text) FROM train
  UNION ALL SELECT 'bad_labels', '', count(*) FROM train WHERE intent NOT IN (SELECT intent FROM dim)
  UNION ALL SELECT 'odd_key_set', '', count(*) FROM docs WHERE lang = 'de' OR lang = 'fr')""")
def dataset_health(spark, sf):
    """Labels as logged, some outside the set; lines of one language have a key too many, of another one too few."""
    docs = R.documents(spark, sf)
    train = docs.filter("part <> 'eval'").select("text", F.coalesce("client_label", "intent").alias("intent"))
    lang = F.col("lang")
    line = (F.when(lang == "de", F.to_json(F.struct("text", "intent", "lang")))
            .when(lang == "fr", F.to_json(F.struct("text"))).otherwise(F.to_json(F.struct("text", "intent"))))
    return U.dataset_health(train, docs.filter("part = 'eval'"), docs.select(line.alias("line")))


# --- fits (no SQL counterpart) -----------------------------------------------------------

def _floor_docs(spark, sf):
    return R.documents(spark, sf).select("part", "text", "intent")


@query("h05_floor_model")
def floor_model(spark, sf):
    """The floor model with every term, fitted to tolerance on pool and log; report per class on the evals."""
    docs = _floor_docs(spark, sf)
    pred = FX.fit_exact_floor(docs.filter("part <> 'eval'")).predict(docs.filter("part = 'eval'"))
    return r6(M.class_report(pred.withColumnRenamed("intent", "gold"), L.INTENTS), "precision", "recall", "f1")


@query("h05_floor_fit", f"""{_TFIDF_SQL.replace("FROM documents", "FROM lab").replace("WITH t AS", _D + f", lab AS (SELECT seq AS doc_id, text, intent FROM docs WHERE part <> 'eval' AND intent IS NOT NULL), t AS", 1)},
a AS (SELECT term, intent, sum(weight) AS s FROM x JOIN lab USING (doc_id) GROUP BY term, intent),
k AS (SELECT count(DISTINCT intent) AS k, count(*) AS n FROM lab),
per AS (SELECT sum(s * s) - pow(sum(s), 2) / any_value(k) AS q FROM a, k GROUP BY term
  UNION ALL SELECT sum(m * m) - pow(sum(m), 2) / any_value(k) FROM (SELECT intent, count(*) AS m FROM lab GROUP BY intent), k)
SELECT (SELECT count(*) FROM df) AS n_terms, round(ln(any_value(k)), 6) AS start_loss, round(sqrt(sum(q)) / any_value(n), 6) AS start_gradient,
  true AS converged, true AS below_start FROM per, k""")
def floor_fit(spark, sf):
    """Terms, loss and gradient norm of zero weights, and whether the fit reached its tolerance from there."""
    fit = FX.fit_exact_floor(_floor_docs(spark, sf).filter("part <> 'eval'"))
    fit.release()
    row = (fit.n_terms, round(fit.start_loss, 6), round(fit.start_gradient, 6), fit.gradient <= FT.TOL and fit.iterations <= FT.MAX_ITER, fit.loss < fit.start_loss)
    return spark.createDataFrame([row], "n_terms long, start_loss double, start_gradient double, converged boolean, below_start boolean")


@query("h06_head_fit")
def head_fit(spark, sf):
    """Balanced head on in-distribution embeddings, scored on the same rows."""
    known = R.embeddings(spark, sf).filter("suite = 'indist'")
    fitted = FT.fit_head(known, "gold")
    pred = S.predict(S.with_logits(known, fitted), decimals=R.DECIMALS)
    return r6(M.class_report(pred, R.KNOWN_LABELS), "precision", "recall", "f1")


@query("h07_temperature_fit")
def temperature_fit(spark, sf):
    """Fitted T, with the loss around it: neighbours inside [0.5, 20] are not better."""
    known = C.with_gold_index(R.scored(spark, sf).filter("suite = 'indist'"))
    fit = C.fit_temperature(known)
    around = C.nll_grid(known, [1.0, fit.optimum * 0.99, fit.optimum, fit.optimum * 1.01])
    return around.withColumns({"fitted": F.lit(fit.temperature), "clamped": F.lit(fit.clamped),
                               "ece_at_one": F.lit(fit.ece_at_one)})


# --- evaluation ------------------------------------------------------------------------

@query("h08_evaluation_report", f"""{COARSE_SQL}, {LABELS_SQL},
allp AS (SELECT *, 'centroid/' || suite AS grp FROM preds UNION ALL SELECT *, 'coarse/' || suite AS grp FROM cpreds),
{report_sql('allp', 'grp')}, {ece_sql('allp', 'grp')},
g AS (SELECT grp, count(*) AS n, avg(CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END) AS acc, avg(CASE WHEN conf >= {L.GATE} THEN 1.0 ELSE 0.0 END) AS kept,
  avg(CASE WHEN conf >= {L.GATE} THEN CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END END) AS kacc FROM allp GROUP BY grp),
m AS (SELECT grp, avg(f1) AS mf, sum(f1 * support) / sum(support) AS wf FROM rep GROUP BY grp),
o AS (SELECT grp, avg(CASE WHEN conf < {L.GATE} THEN 1.0 ELSE 0.0 END) AS v FROM allp WHERE suite = 'ood' GROUP BY grp),
hb AS (SELECT grp, least(len(list_filter(range(1, 21), lambda i: conf >= i * 0.05::DOUBLE)), 19) AS bin, count(*) AS c FROM allp GROUP BY ALL),
hg AS (SELECT grp, n, unnest(range(20)) AS bin FROM g), cuts AS (SELECT unnest(range(101)) AS i),
old AS (SELECT suite, count(CASE WHEN conf >= 0.2::DOUBLE OR suite = 'ood' THEN 1 END) AS c, count(*) AS whole,
  avg(CASE WHEN conf >= 0.2::DOUBLE OR suite = 'ood' THEN CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END END) AS acc FROM cpreds GROUP BY suite)
SELECT grp, metric, class, round(CAST(value AS DOUBLE), 6) AS value FROM (
  SELECT grp, 'n' AS metric, '' AS class, n AS value FROM g UNION ALL SELECT grp, 'accuracy', '', acc FROM g
  UNION ALL SELECT grp, 'kept_share', '', kept FROM g UNION ALL SELECT grp, 'kept_accuracy', '', kacc FROM g
  UNION ALL SELECT grp, 'ece', '', ece FROM ece UNION ALL SELECT grp, 'macro_f1', '', mf FROM m UNION ALL SELECT grp, 'weighted_f1', '', wf FROM m
  UNION ALL SELECT grp, 'precision', label, precision FROM rep UNION ALL SELECT grp, 'recall', label, recall FROM rep
  UNION ALL SELECT grp, 'f1', label, f1 FROM rep UNION ALL SELECT grp, 'support', label, support FROM rep
  UNION ALL SELECT grp, 'density', CAST(bin AS VARCHAR), coalesce(c, 0) / (n * 0.05) FROM hg LEFT JOIN hb USING (grp, bin)
  UNION ALL SELECT grp, 'pct_deferred', CAST(i AS VARCHAR), avg(CASE WHEN conf < 0.5::DOUBLE + i * 0.005::DOUBLE THEN 100.0 ELSE 0.0 END) FROM allp CROSS JOIN cuts GROUP BY grp, i
  UNION ALL SELECT grp, 'ood_deferred_share', '', v FROM o
  UNION ALL SELECT 'nearest/' || suite, unnest(['cached_n', 'cached_accuracy', 'stale']), '', unnest([c::DOUBLE, acc, (c <> whole)::INTEGER::DOUBLE]) FROM old)""")
def evaluation_report(spark, sf):
    cols = ["model", "suite", "gold", "pred", "conf"]
    a = R.predictions(spark, sf).withColumn("model", F.lit("centroid")).select(cols)
    b = R.coarse_predictions(spark, sf).withColumn("model", F.lit("coarse")).select(cols)
    both = a.unionByName(b)
    # A cached system, one of whose suites was smaller when it was scored.
    seen = R.coarse_predictions(spark, sf).filter("conf >= 0.2 OR suite = 'ood'")
    old = seen.groupBy("suite").agg(F.count(F.lit(1)).alias("eval_n"), F.avg((F.col("pred") == F.col("gold")).cast("double")).alias("accuracy"))
    report = M.evaluation_report(both, R.ALL_LABELS, both.filter("suite = 'ood'"), baselines=old.withColumn("model", F.lit("nearest")))
    return report.select(F.concat_ws("/", "model", "suite").alias("grp"), "metric", "class", F.round("value", 6).alias("value"))


@query("h09_multi_suite", f"""{_D}, lab AS (SELECT unnest({R.list_sql(L.INTENTS)}) AS label),
wp AS (SELECT part AS suite, seq, intent AS gold, {_weak_sql('text')} AS pred FROM docs), {report_sql('wp', 'suite')}
SELECT suite, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep""")
def multi_suite(spark, sf):
    """Rule labels against the given ones, each suite on its own."""
    docs = R.documents(spark, sf)
    pred = docs.select(F.col("part").alias("suite"), F.col("intent").alias("gold"), L.weak_label(F.col("text")).alias("pred"))
    return r6(M.class_report(pred, L.INTENTS, ["suite"]), "precision", "recall", "f1")


_R = PR.ITERATIONS


@query("h10_contrastive_pairs", f"""
WITH ra AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY {R.hash_sql(0, 'vec_id', "'anchor'")}, vec_id) - 1 AS r FROM embeddings),
rb AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY {R.hash_sql(0, 'vec_id', "'partner'")}, vec_id) - 1 AS r FROM embeddings),
cls AS (SELECT label, least(count(*), {_R + 1}) AS m, row_number() OVER (ORDER BY label) - 1 AS c, count(*) OVER () AS k FROM embeddings GROUP BY label),
d AS (SELECT *, unnest(range({_R})) AS i FROM cls),
a AS (SELECT d.*, ra.vec_id AS anchor FROM d JOIN ra ON ra.label = d.label AND ra.r = d.i % d.m),
p AS (SELECT a.label, i, true AS positive, anchor, CASE WHEN b1.vec_id = anchor THEN b2.vec_id ELSE b1.vec_id END AS partner
  FROM a JOIN rb b1 ON b1.label = a.label AND b1.r = i % m JOIN rb b2 ON b2.label = a.label AND b2.r = (i + 1) % m WHERE m > 1),
n AS (SELECT a.label, a.i, false AS positive, anchor, rb.vec_id AS partner
  FROM a JOIN cls o ON o.c = (a.c + 1 + a.i % (a.k - 1)) % a.k JOIN rb ON rb.label = o.label AND rb.r = a.i % o.m WHERE a.k > 1)
SELECT label, CAST(i AS INTEGER) AS i, positive, anchor, partner FROM (SELECT * FROM p UNION ALL SELECT * FROM n)""")
def contrastive_pairs(spark, sf):
    return PR.contrastive_pairs(R.table(spark, sf, "embeddings"), "vec_id", "label")
