"""Scalar functions and predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from cuelake.functions import disfluency as D, keys as K, labels as L, text as T, vectors as V
from cuelake.functions.draws import draw_hash, uniform
from cuelake.operators import score as S
from cuelake.plans import roles as R
from cuelake.plans.registry import query


def _text_query(name, fn, sql_expr):
    """A text function applied to every document."""
    @query(name, f"SELECT doc_id, {sql_expr} AS out FROM documents")
    def run(spark, sf):
        return R.table(spark, sf, "documents").select("doc_id", fn(F.col("text")).alias("out"))
    return run


_text_query("b01_lowercase", T.lowercase, "lower(text)")
_text_query("b02_strip_terminal_punct", T.strip_terminal_punct, r"regexp_replace(text, '[\s.!?]+$', '')")
_text_query("b03_mask_secret_tail", T.mask_secret_tail,
            rf"regexp_replace(text, '{R.SECRET_SQL}', '\1 <SECRET>', 'g')")
_text_query("b04_mask_email", T.mask_email,
            r"regexp_replace(text, '(?i)[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}', '<EMAIL>', 'g')")
_text_query("b05_mask_digits", T.mask_digits, r"regexp_replace(text, '\b\d{4,}\b', '<NUM>', 'g')")
_text_query("b06_normalize_text", T.normalize_text, R.norm_sql("text"))
_text_query("b07_key_redacted", K.key_redacted, R.key_sql("text"))
_text_query("b08_key_leak", K.key_leak, R.leak_sql("text"))
_text_query("b09_key_loose", K.key_loose, R.loose_sql("text"))
_text_query("b10_drop_apostrophes", T.drop_apostrophes, "replace(text, '''', '')")
_text_query("b11_drop_closing_punct", T.drop_closing_punct,
            r"regexp_replace(regexp_replace(text, '[.?!]+$', ''), '\s+$', '')")
_text_query("b12_collapse_whitespace", T.collapse_whitespace, R.collapse_sql("text"))


@query("b19_blank_text", rf"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN {R.strip_sql('line')} = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_blank
FROM lines GROUP BY doc_id""")
def blank_text(spark, sf):
    lines = F.split("text", "\n")
    return R.table(spark, sf, "documents").select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(lines, T.is_blank)).cast("long").alias("n_blank"))


# --- disfluencies: draws replicated in SQL ---------------------------------------------

def _words_sql(x):
    return f"list_filter(string_split({R.collapse_sql(x)}, ' '), lambda w: w <> '')"


def _insert_sql(ws, at, word):
    return f"array_to_string(list_concat({ws}[1:{at}], [{word}], {ws}[{at} + 1:]), ' ')"


def _pick_sql(u, options):
    return f"{R.list_sql(options)}[{R.idx_sql(u, len(options))} + 1]"


def _filler_sql(x, u_pos, u_word):
    ws = _words_sql(x)
    at = f"({R.idx_sql(u_pos, f'(len({ws}) - 1)')} + 1)"
    return f"CASE WHEN len({ws}) < 2 THEN {x} ELSE {_insert_sql(ws, at, _pick_sql(u_word, D.FILLERS))} END"


def _stutter_sql(x, u_fire, u_pos):
    ws = _words_sql(x)
    at = R.idx_sql(u_pos, f"len({ws})")
    return (f"CASE WHEN {u_fire} >= {D.P_STUTTER} OR len({ws}) < 2 THEN {x} "
            f"ELSE {_insert_sql(ws, at, f'{ws}[{at} + 1]')} END")


def _closing_sql(x):
    return rf"regexp_replace(regexp_replace({x}, '[.?!]+$', ''), '\s+$', '')"


def _hashes(n=3, seed=5):
    return [draw_hash(seed, F.col("seq"), i) for i in range(n)]


def _drawn(spark, sf, n=3):
    rows = R.utterances(spark, sf)
    return rows.withColumns({f"h{i + 1}": h for i, h in enumerate(_hashes(n))})


_DRAWN_SQL = f"""WITH {R.UTTER_SQL},
d AS (SELECT *, {', '.join(f"{R.hash_sql(5, 'seq', str(i))} AS h{i + 1}" for i in range(3))} FROM utter)"""


def variant_sql(source: str, steps_from: str = "text") -> str:
    """CTEs v1..v7 applying the variant steps to ``source`` (columns h1..h3)."""
    u = R.u_sql
    return f"""
v1 AS (SELECT *, CASE WHEN {u('h1', 0)} < {D.P_FILLER} THEN {_filler_sql(steps_from, u('h1', 1), u('h1', 2))} ELSE {steps_from} END AS s1 FROM {source}),
v2 AS (SELECT *, {_stutter_sql('s1', u('h1', 3), u('h2', 0))} AS s2 FROM v1),
v3 AS (SELECT *, CASE WHEN {u('h2', 1)} < {D.P_APOSTROPHES} THEN replace(s2, '''', '') ELSE s2 END AS s3 FROM v2),
v4 AS (SELECT *, CASE WHEN {u('h2', 2)} < {D.P_HEDGE} THEN {_pick_sql(u('h2', 3), D.HEDGES)} || ' ' || s3 ELSE s3 END AS s4 FROM v3),
v5 AS (SELECT *, CASE WHEN {u('h3', 0)} < {D.P_TAIL} THEN s4 || ' ' || {_pick_sql(u('h3', 1), D.TAILS)} ELSE s4 END AS s5 FROM v4),
v6 AS (SELECT *, CASE WHEN {u('h3', 2)} < {D.P_PUNCT} THEN {_closing_sql('s5')} ELSE s5 END AS s6 FROM v5),
v7 AS (SELECT *, {R.collapse_sql('s6')} AS single FROM v6)"""


def chain_sql(source: str) -> str:
    """CTEs c1..c3 joining ``text`` and ``partner`` of ``source`` (columns h1, h2)."""
    u = R.u_sql
    def side(x, draw):
        return _closing_sql(f"CASE WHEN {draw} < {D.P_CHAIN_APOSTROPHES} THEN replace({x}, '''', '') ELSE {x} END")
    return f"""
c1 AS (SELECT *, {side('text', u('h1', 0))} || '{D.CHAIN_LINK}' || {side('partner', u('h1', 1))} AS j1 FROM {source}),
c2 AS (SELECT *, CASE WHEN {u('h1', 2)} < {D.P_CHAIN_FILLER} THEN {_filler_sql('j1', u('h1', 3), u('h2', 0))} ELSE j1 END AS j2 FROM c1),
c3 AS (SELECT *, CASE WHEN partner IS NOT NULL AND intent IN ({', '.join(f"'{c}'" for c in L.CHAINABLE)}) THEN {R.collapse_sql('j2')} END AS chained FROM c2)"""


@query("b13_insert_filler", f"{_DRAWN_SQL} SELECT seq, {_filler_sql('text', R.u_sql('h1', 1), R.u_sql('h1', 2))} AS out FROM d")
def insert_filler(spark, sf):
    h = F.col("h1")
    return _drawn(spark, sf).select("seq", D.insert_filler(
        F.col("text"), T.words(F.col("text")), uniform(h, 1), uniform(h, 2)).alias("out"))


@query("b14_stutter", f"{_DRAWN_SQL} SELECT seq, {_stutter_sql('text', R.u_sql('h1', 3), R.u_sql('h2', 0))} AS out FROM d")
def stutter(spark, sf):
    return _drawn(spark, sf).select("seq", D.stutter(
        F.col("text"), T.words(F.col("text")), uniform(F.col("h1"), 3), uniform(F.col("h2"), 0)).alias("out"))


@query("b15_prepend_hedge", f"{_DRAWN_SQL} SELECT seq, {_pick_sql(R.u_sql('h2', 3), D.HEDGES)} || ' ' || text AS out FROM d")
def prepend_hedge(spark, sf):
    return _drawn(spark, sf).select("seq", D.prepend_hedge(F.col("text"), uniform(F.col("h2"), 3)).alias("out"))


@query("b16_append_tail", f"{_DRAWN_SQL} SELECT seq, text || ' ' || {_pick_sql(R.u_sql('h3', 1), D.TAILS)} AS out FROM d")
def append_tail(spark, sf):
    return _drawn(spark, sf).select("seq", D.append_tail(F.col("text"), uniform(F.col("h3"), 1)).alias("out"))


@query("b17_make_variant", f"{_DRAWN_SQL}, {variant_sql('d')} SELECT seq, single AS out FROM v7")
def make_variant(spark, sf):
    return _drawn(spark, sf).select("seq", D.variant(
        F.col("text"), F.col("h1"), F.col("h2"), F.col("h3")).alias("out"))


@query("b18_make_chain", f"""{_DRAWN_SQL},
p AS (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS partner FROM d), {chain_sql('p')}
SELECT seq, chained AS out FROM c3""")
def make_chain(spark, sf):
    nxt = F.lead("text").over(W.partitionBy("conv_id").orderBy("turn"))
    rows = _drawn(spark, sf).withColumn("partner", nxt)
    return rows.select("seq", D.chain(F.col("text"), F.col("partner"), F.col("intent"),
                                      F.col("h1"), F.col("h2")).alias("out"))


@query("b20_ngram_tokens", r"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS toks FROM documents),
g AS (SELECT doc_id, toks, list_transform(range(1, greatest(len(toks), 1)), lambda i: toks[i] || ' ' || toks[i + 1]) AS bi FROM t)
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_uni, CAST(len(bi) AS BIGINT) AS n_bi,
  md5(array_to_string(list_concat(toks, bi), '|')) AS grams FROM g""")
def ngram_tokens(spark, sf):
    toks = R.table(spark, sf, "documents").withColumn("toks", T.tokens(F.col("text"))).withColumn(
        "bi", T.pair_up(F.col("toks")))
    return toks.select("doc_id", F.size("toks").cast("long").alias("n_uni"), F.size("bi").cast("long").alias("n_bi"),
                       F.md5(F.array_join(F.concat("toks", "bi"), "|").cast("binary")).alias("grams"))


# --- labels and predicates -------------------------------------------------------------

_ENUM = ", ".join(f"'{x}'" for x in L.INTENTS)


@query("b21_label_violations", f"""WITH {R.DOCS_SQL}
SELECT seq, client_label FROM docs WHERE client_label IS NOT NULL AND client_label NOT IN ({_ENUM})""")
def label_violations(spark, sf):
    rows = R.documents(spark, sf).filter(F.col("client_label").isNotNull())
    return rows.filter(~L.is_valid(F.col("client_label"))).select("seq", "client_label")


@query("b22_exact_key_set", """
SELECT event_id, list_sort(json_keys(props)) = ['k'] AS only_k, list_sort(json_keys(props)) = ['k', 'v'] AS k_and_v
FROM events""")
def exact_key_set(spark, sf):
    props = F.col("props")
    return R.table(spark, sf, "events").select(
        "event_id", L.has_exact_keys(props, ["k"]).alias("only_k"), L.has_exact_keys(props, ["v", "k"]).alias("k_and_v"))


@query("b23_label_resolution", f"""WITH {R.DOCS_SQL},
t AS (SELECT *, CASE WHEN lang <> 'es' THEN {R._LANG_SQL} END AS answer FROM docs),
r AS (SELECT seq, client_label, answer, CASE
    WHEN coalesce(client_label, '') <> '' THEN CASE WHEN client_label IN ({_ENUM}) THEN 'client' ELSE 'bad' END
    WHEN answer IS NOT NULL THEN 'teacher' ELSE 'needs_teacher' END AS origin FROM t)
SELECT seq, origin, CASE origin WHEN 'client' THEN client_label WHEN 'teacher' THEN answer END AS intent FROM r""")
def label_resolution(spark, sf):
    answer = F.when(F.col("lang") != "es", R._by_lang())
    r = L.resolve_label(F.col("client_label"), answer)
    return R.documents(spark, sf).select("seq", r.alias("r")).select(
        "seq", F.col("r.source").alias("origin"), "r.intent")


@query("b24_tie_break", f"""WITH {R.DOCS_SQL},
c AS (SELECT seq, [intent, coalesce(client_label, 'unsure'), CASE WHEN length(text) > 2000 THEN 'agent' ELSE 'unsure' END] AS cands FROM docs)
SELECT seq, coalesce(list_filter({R.list_sql(L.TIE_ORDER)}, lambda x: list_contains(cands, x))[1], 'chat') AS intent FROM c""")
def tie_break(spark, sf):
    cands = F.array(F.col("intent"), F.coalesce("client_label", F.lit("unsure")),
                    F.when(F.length("text") > 2000, "agent").otherwise("unsure"))
    return R.documents(spark, sf).select("seq", L.break_tie(cands).alias("intent"))


def _weak_sql(x):
    hits = {lbl: " OR ".join(f"regexp_matches(lower({x}), '{p.replace(chr(39), chr(39) * 2)}')"
                             for l2, p in L.WEAK_RULES if l2 == lbl) for lbl, _ in L.WEAK_RULES}
    return (f"CASE WHEN {hits['agent']} THEN 'agent' WHEN {hits['memory']} THEN 'memory' "
            f"WHEN {hits['integration']} THEN 'integration' "
            f"WHEN ({hits['find_action']}) AND NOT ({hits['chat']}) THEN 'find_action' ELSE 'chat' END")


@query("b25_weak_label", f"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, {_weak_sql('line')} AS intent, count(*) AS n FROM lines GROUP BY ALL""")
def weak_label(spark, sf):
    lines = R.table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id", L.weak_label(F.col("line")).alias("intent")).agg(F.count(F.lit(1)).alias("n"))


@query("b26_confidence_gate", f"""{R.SCORED_SQL}
SELECT vec_id, pred, CASE WHEN conf < {L.GATE} OR pred = 'none' THEN 'defer' ELSE 'keep' END AS action FROM preds""")
def confidence_gate(spark, sf):
    return R.predictions(spark, sf).select("vec_id", "pred", L.gate_action(F.col("conf"), F.col("pred")).alias("action"))


@query("b27_correction_signal", """
WITH c AS (SELECT event_type AS predicted_intent, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
x AS (SELECT predicted_intent, CASE WHEN k < 50 THEN NULL WHEN k < 70 THEN 'view' ELSE predicted_intent END AS corrected_intent FROM c)
SELECT predicted_intent, corrected_intent, count(*) AS n FROM x WHERE corrected_intent IS NOT NULL GROUP BY ALL""")
def correction_signal(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = R.table(spark, sf, "events").select(F.col("event_type").alias("predicted_intent"), F.when(
        k < 50, F.lit(None)).when(k < 70, "view").otherwise(F.col("event_type")).alias("corrected_intent"))
    truth = rows.filter(F.col("corrected_intent").isNotNull())
    return truth.groupBy("predicted_intent", "corrected_intent").agg(F.count(F.lit(1)).alias("n"))


# --- scoring ---------------------------------------------------------------------------

@query("b28_l2_normalize", """
WITH s AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * 3) AS v FROM embeddings),
n AS (SELECT vec_id, list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-12)) AS v FROM s)
SELECT vec_id, round(v[1], 6) AS x1, round(list_sum(v), 6) AS total FROM n""")
def l2_normalize(spark, sf):
    tripled = F.transform(V.as_double(F.col("embedding")), lambda x: x * 3)
    rows = R.table(spark, sf, "embeddings").select("vec_id", V.l2_normalize(tripled).alias("v"))
    return rows.select("vec_id", F.round(F.get("v", F.lit(0)), 6).alias("x1"), F.round(V._sum(F.col("v")), 6).alias("total"))


def _cells(rows, arr, name):
    return rows.select("vec_id", F.posexplode(arr).alias("idx", "x")).select(
        "vec_id", "idx", F.round("x", 6).alias(name))


def _cells_sql(arr, name):
    return f"""{R.SCORED_SQL}
SELECT vec_id, CAST(i - 1 AS INTEGER) AS idx, round({arr}, 6) AS {name}
FROM (SELECT *, unnest(range(1, len(z) + 1)) AS i FROM preds)"""


@query("b29_logits", _cells_sql("z[i]", "logit"))
def logits(spark, sf):
    return _cells(R.scored(spark, sf), F.col("logits"), "logit")


@query("b30_temperature_scale", _cells_sql("z[i] / 2.5", "logit"))
def temperature_scale(spark, sf):
    return _cells(R.scored(spark, sf), V.scale(F.col("logits"), 2.5), "logit")


@query("b31_softmax", _cells_sql("p[i]", "prob"))
def softmax(spark, sf):
    return _cells(R.scored(spark, sf), V.softmax(F.col("logits")), "prob")


@query("b32_argmax", f"{R.SCORED_SQL} SELECT vec_id, pred, round(conf, 6) AS conf FROM preds")
def argmax(spark, sf):
    return R.predictions(spark, sf).select("vec_id", "pred", F.round("conf", 6).alias("conf"))


@query("b33_distribution", f"""{R.SCORED_SQL},
x AS (SELECT vec_id, i, p[i] AS prob FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM preds))
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, i) - 1 AS INTEGER) AS place,
  CAST(i - 1 AS VARCHAR) AS label, round(prob, 4) AS prob FROM x""")
def distribution(spark, sf):
    rows = S.route(R.predictions(spark, sf))
    return rows.select("vec_id", F.posexplode("distribution").alias("place", "d")).select(
        "vec_id", "place", "d.label", "d.prob")


@query("b34_batch_route", f"""{R.SCORED_SQL},
x AS (SELECT vec_id, i, p[i] AS prob FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM preds)),
o AS (SELECT vec_id, string_agg(CAST(i - 1 AS VARCHAR), '>' ORDER BY prob DESC, i) AS ranking FROM x GROUP BY vec_id)
SELECT vec_id, pred AS intent, round(conf, 4) AS confidence, ranking,
  CASE WHEN conf < {L.GATE} OR pred = 'none' THEN 'defer' ELSE 'keep' END AS action
FROM preds JOIN o USING (vec_id)""")
def batch_route(spark, sf):
    rows = S.route(R.predictions(spark, sf))
    ranking = F.array_join(F.transform("distribution", lambda d: d["label"]), ">")
    return rows.select("vec_id", "intent", F.round("confidence", 4).alias("confidence"),
                       ranking.alias("ranking"), "action")


_CENT_SQL = f"""WITH {R.EMB_SQL},
cent AS (SELECT label, list(m ORDER BY i) AS c FROM (
  SELECT label, i, avg(v[i]) AS m FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM emb) GROUP BY label, i)
  GROUP BY label)"""


@query("b35_nearest_label", f"""{_CENT_SQL},
s AS (SELECT vec_id, c.label, list_dot_product(v, c.c) / sqrt(list_dot_product(v, v)) / sqrt(list_dot_product(c.c, c.c)) AS sim
      FROM emb CROSS JOIN cent c)
SELECT vec_id, CAST(arg_max(label, sim) AS VARCHAR) AS nearest, round(max(sim), 6) AS similarity FROM s GROUP BY vec_id""")
def nearest_label(spark, sf):
    rows = S.nearest_label(R.embeddings(spark, sf), "label")
    return rows.select("vec_id", "nearest", F.round("similarity", 6).alias("similarity"))


@query("b35_cosine_spread", f"""WITH {R.EMB_SQL},
size AS (SELECT ceil(count(*) / 4096.0) AS b FROM emb),
h AS (SELECT vec_id, v, {R.hash_sql(0, 'vec_id', "'pair'")} AS h, b FROM emb CROSS JOIN size),
n AS (SELECT v, lead(v) OVER (PARTITION BY {R.idx_sql(R.u_sql('h'), 'b')} ORDER BY h, vec_id) AS w FROM h),
c AS (SELECT list_dot_product(v, w) / sqrt(list_dot_product(v, v)) / sqrt(list_dot_product(w, w)) AS cos FROM n WHERE w IS NOT NULL)
SELECT count(*) AS pairs, round(min(cos), 6) AS min_cos, round(avg(cos), 6) AS avg_cos, round(max(cos), 6) AS max_cos,
  round(stddev_pop(cos), 6) AS sd_cos FROM c""")
def cosine_spread(spark, sf):
    s = S.cosine_spread(R.embeddings(spark, sf), "vec_id")
    return s.select("pairs", *[F.round(c, 6).alias(c) for c in ("min_cos", "avg_cos", "max_cos", "sd_cos")])


_PAIRS_SQL = f"""WITH {R.EMB_SQL},
u AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM emb),
p AS (SELECT a.label AS label, b.label AS other, a.vec_id < b.vec_id AS once, list_dot_product(a.v, b.v) AS cos
  FROM u a JOIN u b ON a.vec_id <> b.vec_id)"""


@query("b35_cosine_moments", f"""{_PAIRS_SQL}
SELECT (SELECT count(*) FROM emb) AS n, count(*) AS pairs, round(avg(cos), 6) AS avg_cos, round(stddev_pop(cos), 6) AS sd_cos FROM p WHERE once""")
def cosine_moments(spark, sf):
    """Mean and deviation of the cosines of all pairs; the SQL lists them all."""
    out = S.cosine_moments(R.embeddings(spark, sf))
    return out.select("n", F.col("pairs").cast("long").alias("pairs"), F.round("avg_cos", 6).alias("avg_cos"), F.round("sd_cos", 6).alias("sd_cos"))


@query("b35_class_cohesion", f"""{_PAIRS_SQL}
SELECT label, any_value(k.n) AS n, round(avg(CASE WHEN label = other THEN cos END), 6) AS within_cos,
  round(avg(CASE WHEN label <> other THEN cos END), 6) AS between_cos
FROM p JOIN (SELECT label, count(*) AS n FROM emb GROUP BY label) k USING (label) GROUP BY label""")
def class_cohesion(spark, sf):
    out = S.class_cohesion(R.embeddings(spark, sf), "label")
    return out.select("label", "n", F.round("within_cos", 6).alias("within_cos"), F.round("between_cos", 6).alias("between_cos"))
