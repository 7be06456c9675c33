"""The driver tables in the roles the operators expect, in Spark and in SQL.

Every row of a table plays exactly one part. Documents come in three collections told
apart by their ``source``: frozen evals, the training pool, and the log of samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cuelake.functions import keys as K
from cuelake.functions.draws import draw_hash, uniform
from cuelake.operators import score as S
from cuelake.sources.scans import spread_scan

EVAL_SOURCES = ["src0", "src1"]
POOL_SOURCES = ["src2", "src3", "src4", "src5", "src6"]
LANG_INTENT = {"en": "chat", "de": "memory", "fr": "agent", "es": "integration"}
BAD_LABEL = "unknown_tag"
GAIN = 20.0
OOD_FROM = 8
DECIMALS = 9
# Text tables, whose per-row work is heavy, and the key they spread on if unsplittable.
SCAN_KEYS = {"documents": "doc_id", "conversations": "conv_id", "events": "event_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_scan(df, SCAN_KEYS[name]) if name in SCAN_KEYS else df


def _by_lang() -> Column:
    out = None
    for lang, intent in LANG_INTENT.items():
        cond = F.col("lang") == lang
        out = F.when(cond, intent) if out is None else out.when(cond, intent)
    return out


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, text, lang, source, part: what needs no labels joins none."""
    docs = table(spark, sf_dir, "documents")
    part = (F.when(F.col("source").isin(EVAL_SOURCES), "eval")
            .when(F.col("source").isin(POOL_SOURCES), "pool").otherwise("log"))
    return docs.select(F.col("doc_id").alias("seq"), "text", "lang", "source", part.alias("part"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, text, lang, source, part, intent (always given), client_label (often NULL)."""
    given = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "seq")
    joined = texts(spark, sf_dir).join(given, "seq", "left")
    intent = (F.when(F.col("toxic") == 1, "none").when(F.col("quality") == 0, "find_action")
              .otherwise(_by_lang()))
    label = (F.when(F.col("quality").isNull(), F.lit(None))
             .when((F.col("quality") == 0) & (F.col("toxic") == 1), BAD_LABEL).otherwise(intent))
    return joined.select("seq", "text", "lang", "source", "part", intent.alias("intent"), label.alias("client_label"))


def part(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return documents(spark, sf_dir).filter(F.col("part") == name)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part(spark, sf_dir, "log").select("seq", "text", "client_label")


def teacher(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the label teacher, by ingest key; one language is still unanswered."""
    docs = documents(spark, sf_dir).filter("client_label is null and lang <> 'es'")
    return docs.groupBy(K.digest(K.key_redacted(F.col("text"))).alias("key")).agg(
        F.min(_by_lang()).alias("intent"))


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, text, intent of every conversation turn."""
    conv = table(spark, sf_dir, "conversations")
    intent = F.when(F.col("role") == "user", "chat").when(F.col("role") == "assistant", "agent").otherwise("integration")
    return conv.select((F.col("conv_id") * 100000 + F.col("turn")).alias("seq"), "conv_id", "turn",
                       "text", intent.alias("intent"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    ood = F.col("label") >= OOD_FROM
    return emb.select("vec_id", "embedding", "label",
                      F.when(ood, "none").otherwise(F.col("label").cast("string")).alias("gold"),
                      F.when(ood, "ood").otherwise("indist").alias("suite"))


def head(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = embeddings(spark, sf_dir).filter(F.col("label") < OOD_FROM)
    return S.centroid_head(known, "label", gain=GAIN, decimals=DECIMALS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_logits(embeddings(spark, sf_dir), head(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str, temperature: float = 1.0) -> DataFrame:
    return S.predict(scored(spark, sf_dir), temperature, DECIMALS)


def coarse_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows under the head with weights rounded to two decimals."""
    coarse = S.with_logits(embeddings(spark, sf_dir), S.quantize_head(head(spark, sf_dir), 1))
    return S.predict(coarse, 1.0, DECIMALS)


KNOWN_LABELS = [str(i) for i in range(OOD_FROM)]
ALL_LABELS = KNOWN_LABELS + ["none"]


def as_event_predictions(events: DataFrame) -> DataFrame:
    """The event log as logged predictions: ts, intent, conf, ms."""
    conf = F.round(uniform(draw_hash(3, F.col("event_id")), 0), DECIMALS)
    return events.select("event_id", "ts", F.col("event_type").alias("intent"), conf.alias("conf"),
                         F.col("value").alias("ms"))


def event_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_predictions(table(spark, sf_dir, "events"))


# --- the same roles in SQL ------------------------------------------------------------

SECRET_SQL = (r"(?im)\b(password|passcode|pin|ssn|secret|token|api\s*key|api\s*secret|"
              r"credit card|card number)\b.*$")


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def norm_sql(x: str) -> str:
    x = rf"regexp_replace(lower({x}), '[\s.!?]+$', '')"
    x = rf"regexp_replace({x}, '{SECRET_SQL}', '\1 <SECRET>', 'g')"
    x = rf"regexp_replace({x}, '(?i)[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{{2,}}', '<EMAIL>', 'g')"
    return rf"regexp_replace({x}, '\b\d{{4,}}\b', '<NUM>', 'g')"


def key_sql(x: str) -> str:
    return strip_sql(f"lower({norm_sql(x)})")


def leak_sql(x: str) -> str:
    return strip_sql(f"lower({x})")


def loose_sql(x: str) -> str:
    bare = f"replace({leak_sql(x)}, '''', '')"
    return f"trim(regexp_replace(regexp_replace({bare}, '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


def collapse_sql(x: str) -> str:
    return strip_sql(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def hash_sql(seed, *parts: str) -> str:
    return "md5(concat_ws('|', '" + str(seed) + "', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "))"


def u_sql(h: str, slot: int = 0) -> str:
    return f"(CAST(('0x' || substr({h}, {8 * slot + 1}, 8)) AS UBIGINT)::DOUBLE / 4294967296.0::DOUBLE)"


def idx_sql(u: str, size) -> str:
    return f"CAST(floor({u} * {size}) AS INTEGER)"


def list_sql(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_LANG_SQL = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANG_INTENT.items()) + " END"

DOCS_SQL = f"""
docs AS (
  SELECT doc_id AS seq, text, lang, source,
    CASE WHEN source IN ({', '.join(f"'{s}'" for s in EVAL_SOURCES)}) THEN 'eval'
         WHEN source IN ({', '.join(f"'{s}'" for s in POOL_SOURCES)}) THEN 'pool' ELSE 'log' END AS part,
    CASE WHEN toxic = 1 THEN 'none' WHEN quality = 0 THEN 'find_action' ELSE {_LANG_SQL} END AS intent,
    CASE WHEN quality IS NULL THEN NULL WHEN quality = 0 AND toxic = 1 THEN '{BAD_LABEL}'
         WHEN toxic = 1 THEN 'none' WHEN quality = 0 THEN 'find_action' ELSE {_LANG_SQL} END AS client_label
  FROM documents LEFT JOIN labels USING (doc_id))"""

UTTER_SQL = """
utter AS (
  SELECT conv_id * 100000 + turn AS seq, conv_id, turn, text,
    CASE role WHEN 'user' THEN 'chat' WHEN 'assistant' THEN 'agent' ELSE 'integration' END AS intent
  FROM conversations)"""

EMB_SQL = f"""
emb AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
    CASE WHEN label >= {OOD_FROM} THEN 'none' ELSE CAST(label AS VARCHAR) END AS gold,
    CASE WHEN label >= {OOD_FROM} THEN 'ood' ELSE 'indist' END AS suite
  FROM embeddings)"""


def head_sql(name: str = "head", decimals: int | None = None) -> str:
    coef = f"round({GAIN} * x, {DECIMALS})"
    b = f"round(-{GAIN / 2} * list_dot_product(c, c), {DECIMALS})"
    if decimals is not None:
        coef, b = f"round({coef}, {decimals})", f"round({b}, {decimals})"
    return f"""
{name} AS (
  SELECT label, list_transform(c, lambda x: {coef}) AS coef, {b} AS b
  FROM (SELECT label, list(m ORDER BY i) AS c
        FROM (SELECT label, i, avg(v[i]) AS m
              FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM emb WHERE label < {OOD_FROM})
              GROUP BY label, i)
        GROUP BY label))"""


def preds_sql(name: str = "preds", head: str = "head", temperature: float = 1.0) -> str:
    return f"""
{name}_z AS (
  SELECT e.vec_id, e.gold, e.suite, list(list_dot_product(e.v, h.coef) + h.b ORDER BY h.label) AS z
  FROM emb e CROSS JOIN {head} h GROUP BY e.vec_id, e.gold, e.suite),
{name}_e AS (
  SELECT *, list_transform(z, lambda x: exp(x / {temperature} - list_max(z) / {temperature})) AS ex FROM {name}_z),
{name}_p AS (SELECT *, list_transform(ex, lambda x: x / list_sum(ex)) AS p FROM {name}_e),
{name} AS (
  SELECT vec_id, gold, suite, z, p, CAST(list_position(p, list_max(p)) - 1 AS VARCHAR) AS pred,
    round(list_max(p), {DECIMALS}) AS conf FROM {name}_p)"""


SCORED_SQL = "WITH " + ",".join([EMB_SQL, head_sql(), preds_sql()])

EVENT_PRED_SQL = f"""
ep AS (
  SELECT event_id, ts, event_type AS intent, round({u_sql(hash_sql(3, 'event_id'))}, {DECIMALS}) AS conf, value AS ms
  FROM events)"""
