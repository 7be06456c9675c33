"""Set operations, sorts, limits, ranks and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuelake.functions import keys as K, text as T
from cuelake.functions.draws import draw_hash
from cuelake.operators import curate as U, ingest as I, metrics as M, ranks as N
from cuelake.plans import roles as R
from cuelake.plans.aggregate_queries import INGEST_SQL, judged
from cuelake.plans.registry import query
from cuelake.session import scratch_path
from cuelake.sources import lines as LN

_D = f"WITH {R.DOCS_SQL}"


@query("e01_union_all", f"""{_D}
SELECT origin, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM (
  SELECT 'documents' AS origin, text FROM docs UNION ALL SELECT 'conversations', text FROM conversations
  UNION ALL SELECT 'benchmark', text FROM benchmark) GROUP BY origin""")
def union_all(spark, sf):
    parts = [R.table(spark, sf, t).select(F.lit(t).alias("origin"), "text")
             for t in ("documents", "conversations", "benchmark")]
    pool = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return pool.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("e02_distinct_content", "SELECT DISTINCT text FROM documents")
def distinct_content(spark, sf):
    keyed = R.table(spark, sf, "documents").select("text", K.digest(F.col("text")).alias("d"))
    return keyed.groupBy("d").agg(F.any_value("text").alias("text")).select("text")


@query("e03_shared_keys", f"""{_D}
SELECT {R.leak_sql('text')} AS key FROM docs WHERE part = 'eval' INTERSECT SELECT {R.leak_sql('text')} FROM docs WHERE part <> 'eval'""")
def shared_keys(spark, sf):
    docs = R.texts(spark, sf)
    return U.shared_keys(docs.filter("part = 'eval'"), docs.filter("part <> 'eval'"))


@query("e04_except_keys", f"""{_D}
SELECT {R.leak_sql('text')} AS key FROM docs WHERE part = 'log' EXCEPT SELECT {R.leak_sql('text')} FROM docs WHERE part <> 'log'""")
def except_keys(spark, sf):
    docs = R.texts(spark, sf)
    kept = U.without_keys_of(docs.filter("part = 'log'"), docs.filter("part <> 'log'"))
    keyed = kept.select(K.key_leak(F.col("text")).alias("key"))
    return keyed.groupBy(K.digest(F.col("key")).alias("d")).agg(F.any_value("key").alias("key")).select("key")


@query("f01_file_order", """
WITH l AS (SELECT source, doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS seq FROM documents)
SELECT doc_id, CAST(seq AS BIGINT) AS seq FROM l""")
def file_order(spark, sf):
    rows = R.table(spark, sf, "documents").select("source", F.col("doc_id").cast("string").alias("value"))
    lines = LN.number_lines(LN.read_lines(spark, f"{_by_source(spark, rows)}/source=*"))
    return lines.select(F.col("line").cast("long").alias("doc_id"), "seq")


def _by_source(spark, rows):
    """One text file per source directory, lines in id order."""
    out = scratch_path(spark, "lines")
    (rows.repartition("source").sortWithinPartitions("source", F.col("value").cast("long"))
     .write.partitionBy("source").text(out))
    return out


@query("f02_first_rows", f"{_D} SELECT seq, client_label FROM docs WHERE part = 'log' ORDER BY seq LIMIT 200")
def first_rows(spark, sf):
    rows = R.samples(spark, sf).select("seq", "client_label")
    return rows.orderBy("seq").limit(200)


@query("f03_low_confidence", f"""{R.SCORED_SQL}
SELECT vec_id, gold, pred, round(conf, 6) AS conf, CASE WHEN pred = gold THEN 'OK' ELSE 'WRONG' END AS mark FROM preds WHERE conf < 0.9""")
def low_confidence(spark, sf):
    return M.low_confidence(R.predictions(spark, sf), "vec_id").select(
        "vec_id", "gold", "pred", F.round("conf", 6).alias("conf"), "mark")


@query("f04_top_duplicates", """
SELECT text, count(*) - 1 AS extra FROM documents GROUP BY text HAVING count(*) > 1 ORDER BY extra DESC, text COLLATE "C" LIMIT 20"""
       .replace(' COLLATE "C"', ""))
def top_duplicates(spark, sf):
    return U.top_duplicates(R.table(spark, sf, "documents"))


@query("f05_deterministic_shuffle", f"""
SELECT event_id, row_number() OVER (ORDER BY {R.hash_sql(11, 'event_id')}, event_id) AS place FROM events""")
def deterministic_shuffle(spark, sf):
    """The shuffled order, with each row's place numbered partition by partition."""
    ordered = N.shuffled(R.table(spark, sf, "events").select("event_id"), "event_id", 11)
    out = scratch_path(spark, "shuffled")
    ordered.select(F.col("event_id").cast("string")).write.text(out)
    return LN.number_lines(LN.read_lines(spark, out)).select(
        F.col("line").cast("long").alias("event_id"), (F.col("seq") + 1).alias("place"))


@query("g01_first_wins_status", f"{INGEST_SQL} SELECT seq, status FROM judged")
def first_wins_status(spark, sf):
    return judged(spark, sf).select("seq", "status")


def split_sql(source: str, fraction: float, seed: int, label: str = "label", id_col: str = "vec_id") -> str:
    """CTE ``split`` adding chosen to source."""
    h = R.hash_sql(seed, id_col)
    return f"""
q1 AS (SELECT {label}, count(*) AS n FROM {source} GROUP BY {label}),
q2 AS (SELECT *, floor(round(n * {fraction}::DOUBLE, 9)) AS fl, round(n * {fraction}::DOUBLE, 9) - floor(round(n * {fraction}::DOUBLE, 9)) AS rem,
  ceil(round(sum(n) OVER () * {fraction}::DOUBLE, 9)) AS total FROM q1),
q3 AS (SELECT {label}, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, {label}) <= total - sum(fl) OVER () THEN 1 ELSE 0 END AS k FROM q2),
split AS (SELECT s.*, row_number() OVER (PARTITION BY {label} ORDER BY {h}, {id_col}) <= k AS chosen FROM {source} s JOIN q3 USING ({label}))"""


@query("g03_stratified_split", f"WITH {split_sql('embeddings', 0.2, 7)} SELECT vec_id, label, chosen FROM split")
def stratified_split(spark, sf):
    return N.stratified_split(R.table(spark, sf, "embeddings").select("vec_id", "label"), "vec_id", "label")


@query("g04_kth_values", """
WITH s AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS r,
  count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, any_value(n) AS n, max(CASE WHEN r = n // 4 THEN value END) AS q1, max(CASE WHEN r = n // 2 THEN value END) AS q2,
  max(CASE WHEN r = n - 1 THEN value END) AS top FROM s GROUP BY event_type""")
def kth_values(spark, sf):
    n = F.col("n")
    return N.kth_values(R.table(spark, sf, "events"), "value", ["event_type"], {
        "q1": (0.25, F.floor(n / 4)), "q2": (0.5, F.floor(n / 2)), "top": (1.0, n - 1)})


@query("g05_random_split", f"""
WITH r AS (SELECT event_id, row_number() OVER (ORDER BY {R.hash_sql(11, 'event_id')}, event_id) AS r, count(*) OVER () AS n FROM events)
SELECT event_id, r <= floor(n * 0.2) AS chosen FROM r""")
def random_split(spark, sf):
    return N.random_split(R.table(spark, sf, "events").select("event_id"), "event_id", 0.2, 11)


@query("g06_line_numbers", """
SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS line FROM documents""")
def line_numbers(spark, sf):
    rows = R.table(spark, sf, "documents").select("source", F.col("doc_id").cast("string").alias("value"))
    lines = LN.number_lines(LN.read_lines(spark, f"{_by_source(spark, rows)}/source=*"))
    source = F.regexp_extract("_src", r"source=([^/]+)/", 1)
    return lines.select(source.alias("source"), F.col("line").cast("long").alias("doc_id"), F.col("_line").alias("line"))
