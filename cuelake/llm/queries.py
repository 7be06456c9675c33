"""The operators on the driver's tables, one query each, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuelake.llm import (byte_bpe, cotraining, exact_dedup, fill_middle, host_rules, jaccard_join, language_crf, mixing, pieces, quotes,
                         secrets, spelling, substring_dedup)
from cuelake.llm.common import documents
from cuelake.plans.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


@query("op3_entropy_mix")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@query("op4_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), keep="largest").drop("row")


def _secrets_sql() -> str:
    """Every rule run over every text, with positions from the gaps between matches."""
    parts = []
    for k, rule in enumerate(secrets.RULES):
        p = "'" + rule.pattern.replace("'", "''") + "'"
        parts.append(f"SELECT doc_id, '{rule.kind}' AS kind, {k} AS ord, {rule.least} AS least, unnest(string_split_regex(t, {p})) AS gap, "
                     f"unnest(regexp_extract_all(t, {p}, 0)) AS hit, unnest(regexp_extract_all(t, {p}, {rule.group})) AS val, "
                     f"generate_subscripts(string_split_regex(t, {p}), 1) AS i FROM d")
    counts = ", ".join(f"count(kind) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES)
    joined = "coalesce(string_agg(kind || ':' || (stop - length(hit)) || ':' || stop, ',' ORDER BY stop - length(hit), ord)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
e AS (SELECT *, sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM m),
s AS (SELECT * FROM e WHERE hit IS NOT NULL AND length(val) >= least)
SELECT doc_id, {counts}, sha256({joined} FILTER (ord < {len(secrets.BASE_RULES)}), '')) AS base_sha256, {joined}, '') AS spans
FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id
"""


@query("op8_trigram_secrets", _secrets_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_spans(secrets.find_secrets(documents(spark, sf_dir)))


@query("op10_host_rules", r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest([x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> '']) AS word,
             generate_subscripts([x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''], 1) AS pos FROM d),
g AS (SELECT doc_id, pos, word, count(*) OVER k AS n8, string_agg(word, ' ') OVER k AS gram
      FROM w WINDOW k AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
r AS (SELECT *, n8 = 8 AND count(*) FILTER (n8 = 8) OVER (PARTITION BY doc_id, gram) > 1 AS twice FROM g),
c AS (SELECT doc_id, word, max(twice::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS inside FROM r),
s AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, sum(inside) AS n_repeat_words FROM c GROUP BY doc_id),
l AS (SELECT doc_id, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
m AS (SELECT d.doc_id, d.source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d JOIN l USING (doc_id) LEFT JOIN s USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
h AS (SELECT source, rule, count(*) AS n, sum(k) AS k FROM (
        SELECT source, unnest(['base', 'symbols', 'dup_lines']) AS rule,
               unnest([base_failed::INT, (10 * n_symbols > word_chars)::INT, (100 * n_dup_lines > 30 * n_lines)::INT]) AS k
        FROM f WHERE source IS NOT NULL) GROUP BY source, rule),
t AS (SELECT rule, sum(n) AS n, count(*) AS hosts, sum(k) / sum(n) AS mean FROM h GROUP BY rule),
v AS (SELECT rule, t.mean * (1 - t.mean) AS inside,
             sum(h.n * pow(h.k / h.n - t.mean, 2)) / any_value(t.n) - t.mean * (1 - t.mean) * any_value(t.hosts) / any_value(t.n) AS between_
      FROM h JOIN t USING (rule) GROUP BY rule, t.mean),
p AS (SELECT rule, CASE WHEN between_ > 0 THEN least(1e6, greatest(1.0, inside / between_ - 1)) ELSE 1e6 END AS weight FROM v),
bad AS (SELECT DISTINCT source FROM h JOIN t USING (rule) JOIN p USING (rule) WHERE (h.k + t.mean * weight) / (h.n + weight) >= 0.6)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(source NOT IN (SELECT source FROM bad), true) AS kept FROM f
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op2_language_crf")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_crf.train(docs.filter(~language_crf.held_out(docs)))
    found = language_crf.predict(docs, model)
    return found.select("doc_id", language_crf.held_out(found).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")


@query("op7_merge_dropout")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir), keep_ids=False).drop("ids")


@query("op6_cotrained_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = cotraining.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return cotraining.score(docs, model)


@query("op1_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir), n=3, pct=90, count_links=True)


@query("op5_column_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


@query("op9_quotation_linking")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.digest(quotes.link(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


@query("op11_segment_tree_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, keep_ids=False).drop("ids")


@query("op12_framed_fill_middle", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS x FROM documents),
l AS (SELECT doc_id, t, x, CASE WHEN t = '' THEN [] ELSE regexp_extract_all(t, '[^\n]*\n|[^\n]+') END AS lines FROM d),
h AS (SELECT doc_id, t, lines, len(lines)::BIGINT AS n, ('0x' || x[1:8])::BIGINT % (len(lines) + 1) AS a,
             ('0x' || x[9:16])::BIGINT % (len(lines) + 1) AS b, ('0x' || x[25:32])::BIGINT % 100 < 50 AS spm FROM l),
c AS (SELECT *, array_to_string(lines[1:least(a, b)], '') AS p, array_to_string(lines[least(a, b) + 1:greatest(a, b)], '') AS m,
             array_to_string(lines[greatest(a, b) + 1:], '') AS s,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN spm THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256, true AS lossless FROM c
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_middle(documents(spark, sf_dir), keep_output=False).drop("output")


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")
