"""Comparing systems: parity, joins of gold and predictions, promotion, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_gold(gold: DataFrame, pred: DataFrame, id_col: str) -> DataFrame:
    """Gold and prediction by row id, never by position."""
    return gold.join(pred, id_col)


def parity_rows(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """(id, pred_a, pred_b) where two systems differ; a row one of them lacks differs."""
    x = a.select(F.col(id_col).alias("_ia"), F.col("pred").alias("pred_a"))
    y = b.select(F.col(id_col).alias("_ib"), F.col("pred").alias("pred_b"))
    joined = x.join(y, F.col("_ia") == F.col("_ib"), "full_outer")
    return joined.filter(~F.col("pred_a").eqNullSafe(F.col("pred_b"))).select(
        F.coalesce("_ia", "_ib").alias(id_col), "pred_a", "pred_b")


def parity(a: DataFrame, b: DataFrame, id_col: str, strict: bool = False) -> DataFrame:
    """One row: n, matched, match_rate. ``strict`` fails the job on any mismatch."""
    x = a.select(F.col(id_col).alias("_ia"), F.col("pred").alias("pa"))
    y = b.select(F.col(id_col).alias("_ib"), F.col("pred").alias("pb"))
    same = F.col("pa").eqNullSafe(F.col("pb"))
    joined = x.join(y, F.col("_ia") == F.col("_ib"), "full_outer")
    if strict:  # a filter, so that no choice of columns can skip it
        joined = joined.filter(F.when(same, True).otherwise(F.raise_error(F.concat(
            F.lit("prediction mismatch at id "), F.coalesce("_ia", "_ib").cast("string")))))
    return joined.agg(F.count(F.lit(1)).alias("n"), F.sum(same.cast("long")).alias("matched")).withColumn(
        "match_rate", F.try_divide("matched", "n"))


def compare_models(current: DataFrame, baselines: DataFrame) -> DataFrame:
    """Per suite, each cached baseline beside the current run, flagged when outdated.

    ``current`` has suite, n, fingerprint; ``baselines`` has model, suite, eval_n,
    accuracy, eval_fingerprint. ``stale`` is the row-count rule; ``stale_content``
    also sees an eval set that changed without changing size.
    """
    joined = baselines.join(current, "suite")
    return joined.select(
        "model", "suite", "accuracy", "eval_n", "n",
        (F.col("eval_n") != F.col("n")).alias("stale"),
        (~F.col("eval_fingerprint").eqNullSafe(F.col("fingerprint"))).alias("stale_content"))


def fingerprint(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Order-free content fingerprint: count and sum of 32-bit row hashes per group."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).cast("binary")), 1, 8),
               16, 10).cast("long")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("fingerprint"))


def promote(current: DataFrame, candidate: DataFrame, id_col: str, suite: str | None = None) -> DataFrame:
    """Both accuracies and whether the candidate strictly beats the current one: one row, or one per suite.

    Both must have scored the same rows, else nothing is promoted and ``same_ids`` is false.
    With ``suite``, figures of suites stay apart, and a row that the two systems place in
    different suites fails the job.
    """
    def side(df, mark):
        return df.select(F.col(id_col).alias(f"_i{mark}"), (F.col("pred") == F.col("gold")).cast("double").alias(f"c{mark}"),
                         *([] if suite is None else [F.col(suite).alias(f"_s{mark}")]))

    joined = side(current, "a").join(side(candidate, "b"), F.col("_ia") == F.col("_ib"), "full_outer")
    by = []
    if suite is not None:
        apart = F.col("_ia").isNotNull() & F.col("_ib").isNotNull() & ~F.col("_sa").eqNullSafe(F.col("_sb"))
        joined = joined.filter(F.when(~apart, True).otherwise(F.raise_error(F.concat(
            F.lit("suites differ at id "), F.col("_ia").cast("string"))))).withColumn(suite, F.coalesce("_sa", "_sb"))
        by = [suite]
    stats = joined.groupBy(*by).agg(
        F.avg("ca").alias("current_accuracy"), F.avg("cb").alias("candidate_accuracy"),
        F.coalesce(F.bool_and(F.col("_ia").isNotNull() & F.col("_ib").isNotNull()), F.lit(False)).alias("same_ids"))
    return stats.withColumn("promote", F.col("same_ids") & F.coalesce(
        F.col("candidate_accuracy") > F.col("current_accuracy"), F.lit(False)))


def class_shares(rows: DataFrame, label: str, period: str) -> DataFrame:
    return rows.groupBy(period, label).agg(F.count(F.lit(1)).alias("n"))


def drift(rows: DataFrame, label: str, period: str, before: str, after: str,
          smoothing: float = 0.5) -> DataFrame:
    """Per label: share before and after, and its term of the population stability index.

    Additive smoothing keeps a label that is new or gone finite.
    """
    counts = rows.filter(F.col(period).isin(before, after)).groupBy(label).agg(
        F.sum(F.when(F.col(period) == before, 1).otherwise(0)).alias("b"),
        F.sum(F.when(F.col(period) == after, 1).otherwise(0)).alias("a"))
    totals = counts.agg(F.sum("b").alias("tb"), F.sum("a").alias("ta"), F.count(F.lit(1)).alias("k"))
    s = F.lit(float(smoothing))
    pb = (F.col("b") + s) / (F.col("tb") + s * F.col("k"))
    pa = (F.col("a") + s) / (F.col("ta") + s * F.col("k"))
    return counts.join(F.broadcast(totals)).select(
        label, pb.alias("share_before"), pa.alias("share_after"), ((pa - pb) * F.log(pa / pb)).alias("psi"))
