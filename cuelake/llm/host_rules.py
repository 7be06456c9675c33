"""Quality rules with a verdict per host.

Each document gets rule measures from its whole text. Failures are added up per host,
every host's failure rate is shrunk towards the corpus by a beta prior fitted to the
hosts (method of moments), and hosts whose shrunk rate reaches a rule's limit take
their remaining documents with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cuelake.llm.common import NOT_SPACE, let, sha256_hex, stored, text_of, words  # noqa: F401
from cuelake.operators.skew import attach_per_key

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
# Rule -> (SQL condition of a failing document, shrunk host rate that rejects the host).
HOST_RULES = {
    "base": ("base_failed", 0.6),
    "symbols": ("10 * n_symbols > word_chars", 0.6),
    "dup_lines": ("100 * n_dup_lines > 30 * n_lines", 0.6),
}
# Bounds of the prior's weight in documents, for hosts that differ widely or not at all.
PRIOR_MIN, PRIOR_MAX = 1.0, 1e6


def _pair_hash(a: Column, lag: int) -> Column:
    """hash(a[i], a[i + lag]) for every i that has both."""
    n = F.size(a) - lag
    return F.zip_with(F.slice(a, 1, n), F.slice(a, 1 + lag, n), lambda x, y: F.xxhash64(x, y))


def _covered(keys: Column, width: int) -> Column:
    """Positions covered by windows whose key occurs more than once."""
    def ranked(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: F.coalesce(x["k"] == F.get(s, i - 1)["k"], F.lit(False))
                         | F.coalesce(x["k"] == F.get(s, i + 1)["k"], F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), spread)

    def spread(p: Column) -> Column:
        n = F.size(p) - 1
        gaps = F.zip_with(F.slice(p, 1, n), F.slice(p, 2, n), lambda a, b: F.least(b - a, F.lit(width)))
        return F.aggregate(gaps, F.lit(width), lambda acc, g: acc + g).cast("bigint")

    pairs = F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i")))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("bigint")).otherwise(
        let(F.sort_array(pairs), ranked))


def repeat_words(w: Column) -> Column:
    """Words inside a window of eight that occurs at least twice; 64-bit window keys."""
    eight = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(
        _pair_hash(h, 1), lambda p2: let(_pair_hash(p2, 2), lambda p4: _pair_hash(p4, 4))))
    return F.when(F.size(w) < WINDOW + 1, F.lit(0).cast("bigint")).otherwise(
        let(eight, lambda keys: _covered(keys, WINDOW)))


def measures(text: Column) -> Column:
    """Struct of the per-document measures; null text has no words."""
    def of_lines(lines: Column) -> list[Column]:
        return F.struct(F.size(lines).cast("bigint").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"))

    t = text_of(text)
    of_words = let(words(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(NOT_SPACE)))
    return F.struct(of_words.alias("w"), let(lines, of_lines).alias("l"),
                    F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"))


def shrunk_hosts(rows: DataFrame, rules: dict[str, tuple[str, float]]) -> DataFrame:
    """host, n, k_<rule>, rate_<rule> (shrunk) and host_ok, one row per non-null host."""
    hosts = stored(rows.filter("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.expr(f"CAST({c} AS BIGINT)")).alias(f"k_{r}") for r, (c, _) in rules.items()]), "hosts")
    # One row of a few numbers: totals, then the spread of host rates around the mean.
    total = hosts.agg(F.sum("n").alias("n"), F.count("*").alias("hosts"),
                      *[F.sum(f"k_{r}").alias(r) for r in rules]).first()
    n = total["n"] or 0
    mean = {r: (total[r] / n if n else 0.0) for r in rules}
    spread = hosts.agg(*[F.sum(F.col("n") * F.pow(F.col(f"k_{r}") / F.col("n") - mean[r], 2)).alias(r)
                         for r in rules]).first()
    for r in rules:
        inside = mean[r] * (1 - mean[r])
        between = spread[r] / n - inside * total["hosts"] / n if n else 0.0
        weight = min(PRIOR_MAX, max(PRIOR_MIN, inside / between - 1)) if between > 0 else PRIOR_MAX
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"k_{r}") + mean[r] * weight) / (F.col("n") + weight))
    ok = F.lit(True)
    for r, (_, limit) in rules.items():
        ok = ok & (F.col(f"rate_{r}") < limit)
    return hosts.withColumn("host_ok", ok)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                rules: dict[str, tuple[str, float]] | None = None) -> DataFrame:
    """One row per input row: doc_id, host, the measures, base_failed, host_ok, kept.

    Null text has no words and fails; a null host has no verdict and passes; repeated
    rows each get a row; an empty table gives an empty result; further columns of
    ``docs`` are ignored. Texts are read once, only numbers are shuffled; a host with
    most of the rows is pre-aggregated, then attached by broadcast of at most 1,000 hosts.
    """
    m = docs.select(docs[id_col].alias("doc_id"), docs[host_col].cast("string").alias("host"),
                    measures(docs[text_col]).alias("m"))
    rows = m.select("doc_id", "host", "m.w.*", "m.l.*", "m.n_symbols").withColumn(
        "base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words"))
    rows = stored(rows, "rules")
    verdicts = shrunk_hosts(rows, rules or HOST_RULES).select(F.col("host").alias("key"), "n", "host_ok")
    # A null host gets a key of its own, so that such rows spread and match nothing.
    keyed = rows.withColumn("key", F.coalesce("host", F.concat(F.lit("\u0000"), F.col("doc_id").cast("string"))))
    judged = attach_per_key(keyed, verdicts, "key", F.col("doc_id")).drop("key")
    return judged.withColumn("host_ok", F.coalesce("host_ok", F.lit(True))).withColumn(
        "kept", ~F.col("base_failed") & F.col("host_ok"))
