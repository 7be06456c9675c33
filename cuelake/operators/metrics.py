"""Evaluation metrics over a predictions table (gold, pred, conf).

Every metric is one partial aggregation over the predictions; anything ordered or
windowed afterwards works on label-, bin- or threshold-sized tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cuelake.functions import labels as L
from cuelake.operators.ranks import kth_values
from cuelake.session import cut_lineage

# Binning and thresholds of the published report.
ECE_BINS = 10
HIST_BINS = 20
TAUS = [0.55, 0.60, 0.65, 0.70]
CURVE_POINTS = 101
CURVE_START, CURVE_STEP = 0.5, 0.005
LOW_CONFIDENCE = 0.90


def _n() -> Column:
    return F.count(F.lit(1))


def _correct() -> Column:
    return (F.col("pred") == F.col("gold")).cast("double")


def _values(df_like: DataFrame, name: str, values: list) -> DataFrame:
    spark = df_like.sparkSession
    kind = "double" if isinstance(values[0], float) else "int" if isinstance(values[0], int) else "string"
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def accuracy(pred: DataFrame, by: list[str] = []) -> DataFrame:
    return pred.groupBy(*by).agg(_n().alias("n"), F.avg(_correct()).alias("accuracy"))


def confusion(pred: DataFrame, labels: list[str]) -> DataFrame:
    """Long form (gold, pred, n), zero-filled over labels x labels."""
    counts = pred.groupBy("gold", "pred").agg(_n().alias("n"))
    grid = _values(pred, "gold", labels).withColumn(
        "pred", F.explode(F.array(*[F.lit(x) for x in labels])))
    return grid.join(counts, ["gold", "pred"], "left").select(
        "gold", "pred", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def confusion_matrix(pred: DataFrame, labels: list[str]) -> DataFrame:
    """Wide form: one row per gold label, one column ``pred_<label>`` each."""
    sums = [F.sum(F.when(F.col("pred") == x, F.col("n")).otherwise(0)).cast("long").alias(f"pred_{x}")
            for x in labels]
    return confusion(pred, labels).groupBy("gold").agg(*sums)


def wilson(hits: Column, n: Column, z: float = 1.96) -> Column:
    """Struct(low, high): Wilson score interval of a proportion."""
    p = F.try_divide(hits, n)
    centre = p + z * z / (2 * n)
    margin = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.struct(((centre - margin) / (1 + z * z / n)).alias("low"),
                    ((centre + margin) / (1 + z * z / n)).alias("high"))


def class_counts(pred: DataFrame, labels: list[str], by: list[str] = [],
                 weight: str | None = None) -> DataFrame:
    """tp, fp, fn per label (and group) from one aggregation over (gold, pred).

    ``weight`` names a count column when ``pred`` is already aggregated.
    """
    cells = pred.groupBy(*by, "gold", "pred").agg((F.sum(weight) if weight else _n()).alias("n"))
    sides = cells.select(*by, F.explode(F.array(
        F.struct(F.col("gold").alias("label"), F.when(F.col("gold") == F.col("pred"), F.col("n"))
                 .otherwise(0).alias("tp"), F.lit(0).cast("long").alias("fp"),
                 F.when(F.col("gold") != F.col("pred"), F.col("n")).otherwise(0).alias("fn")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("tp"),
                 F.when(F.col("gold") != F.col("pred"), F.col("n")).otherwise(0).alias("fp"),
                 F.lit(0).cast("long").alias("fn")))).alias("s")).select(*by, "s.*")
    sums = sides.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    if by:
        grid = cells.select(*by).distinct().withColumn("label", F.explode(F.array(*[F.lit(x) for x in labels])))
    else:
        grid = _values(pred, "label", labels)
    return grid.join(sums, [*by, "label"], "left").select(
        *by, "label", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("tp", "fp", "fn")])


def class_report(pred: DataFrame, labels: list[str], by: list[str] = [],
                 intervals: bool = False, weight: str | None = None) -> DataFrame:
    """precision, recall, f1, support per label; an undefined ratio is 0."""
    zero = F.lit(0.0)
    p = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), zero)
    r = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), zero)
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), zero)
    out = class_counts(pred, labels, by, weight)
    extra = [wilson(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision_ci"),
             wilson(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall_ci")] if intervals else []
    return out.select(*by, "label", p.alias("precision"), r.alias("recall"), f1.alias("f1"),
                      (F.col("tp") + F.col("fn")).alias("support"), *extra)


def report_averages(report: DataFrame, by: list[str] = []) -> DataFrame:
    """Macro (plain) and weighted (by support) averages over all supplied labels."""
    total = F.sum("support")
    def weighted(c):
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), total), F.lit(0.0))
    cols = ["precision", "recall", "f1"]
    return report.groupBy(*by).agg(
        *[F.avg(c).alias(f"macro_{c}") for c in cols],
        *[weighted(c).alias(f"weighted_{c}") for c in cols], total.alias("support"))


def bin_of(conf: Column, bins: int, width: float) -> Column:
    """Index i with i*width <= conf < (i+1)*width, using the same edges as a linspace."""
    edges = F.array(*[F.lit(i * width) for i in range(1, bins + 1)])
    return F.size(F.filter(edges, lambda e: conf >= e))


def _threshold_bucket(conf: Column, points: int, start: float, step: float) -> Column:
    """How many cut-offs are <= conf. Near-exact by arithmetic, then settled on the edges."""
    guess = F.greatest(F.lit(0), F.least(F.lit(points), F.floor((conf - start) / step).cast("int")))
    edge = lambda i: F.lit(start) + i * F.lit(step)
    up = [F.when((guess + d >= 0) & (guess + d < points) & (conf >= edge(guess + d)), 1).otherwise(0)
          for d in (-1, 0, 1)]
    base = F.greatest(guess - 1, F.lit(0))
    return (base + sum(up[1:], up[0])).cast("int")


def ece_bins(pred: DataFrame, by: list[str] = [], bins: int = ECE_BINS) -> DataFrame:
    """Per bin: n, mean accuracy, mean confidence. conf = 1.0 lies in no bin."""
    b = pred.withColumn("bin", bin_of(F.col("conf"), bins, 1.0 / bins))
    return b.filter((F.col("bin") < bins) & (F.col("conf") >= 0)).groupBy(*by, "bin").agg(
        _n().alias("n"), F.avg(_correct()).alias("acc"), F.avg("conf").alias("conf"))


def ece(pred: DataFrame, by: list[str] = [], bins: int = ECE_BINS) -> DataFrame:
    """Expected calibration error. Rows outside every bin still count in n."""
    b = pred.withColumn("bin", bin_of(F.col("conf"), bins, 1.0 / bins))
    per_bin = b.groupBy(*by, "bin").agg(_n().alias("n"), F.sum(_correct()).alias("ok"), F.sum("conf").alias("c"))
    gap = F.when((F.col("bin") < bins), F.abs(F.col("ok") - F.col("c"))).otherwise(0.0)
    return per_bin.groupBy(*by).agg((F.sum(gap) / F.sum("n")).alias("ece"), F.sum("n").alias("n"))


def mean_nll(scored: DataFrame, by: list[str] = []) -> DataFrame:
    """Mean negative log likelihood of ``p_gold``, clipped to [1e-12, 1]."""
    p = F.least(F.greatest("p_gold", F.lit(1e-12)), F.lit(1.0))
    return scored.groupBy(*by).agg(F.avg(-F.log(p)).alias("nll"), _n().alias("n"))


def mean_confidence(pred: DataFrame, columns: list[str], by: list[str] = []) -> DataFrame:
    return pred.groupBy(*by).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def threshold_table(pred: DataFrame, conf: str = "conf", taus: list[float] = TAUS) -> DataFrame:
    """Per tau: rows deferred (conf < tau), their share, accuracy kept and deferred.

    Rows are counted once by how many taus they reach; a tau's figures are sums over
    those few counts. An empty side's accuracy is NULL.
    """
    taus = sorted(taus)
    reach = sum((F.when(F.col(conf) >= t, 1).otherwise(0) for t in taus), F.lit(0))
    counts = pred.groupBy(reach.alias("reach")).agg(_n().alias("n"), F.sum(_correct()).alias("ok"))
    each_tau = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("tau"))
                                   for i, t in enumerate(taus)]))
    below = F.col("reach") <= F.col("i")
    per = counts.withColumn("t", each_tau).select("reach", "n", "ok", "t.*").groupBy("tau").agg(
        F.sum(F.when(below, F.col("n")).otherwise(0)).alias("n_deferred"), F.sum("n").alias("n"),
        F.sum(F.when(below, F.col("ok")).otherwise(0.0)).alias("ok_deferred"), F.sum("ok").alias("ok"))
    return per.select(
        "tau", "n_deferred", (F.col("n_deferred") / F.col("n")).alias("deferred_share"),
        F.try_divide(F.col("ok") - F.col("ok_deferred"), F.col("n") - F.col("n_deferred")).alias("kept_accuracy"),
        F.try_divide("ok_deferred", "n_deferred").alias("deferred_accuracy"))


def deferral_curve(pred: DataFrame, population: str = "suite", points: int = CURVE_POINTS,
                   start: float = CURVE_START, step: float = CURVE_STEP) -> DataFrame:
    """Share (%) of each population with conf below each of the cut-offs."""
    b = _threshold_bucket(F.col("conf"), points, start, step)
    counts = pred.groupBy(population, b.alias("b")).agg(_n().alias("c"))
    grid = (counts.select(population).distinct()
            .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(points)))))
    upto = W.partitionBy(population).orderBy("b").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(population)
    filled = grid.join(counts, [population, "b"], "left").withColumn("c", F.coalesce("c", F.lit(0)))
    return (filled.withColumn("below", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(whole))
            .filter(F.col("b") < points)
            .select(population, F.col("b").alias("cut"),
                    (F.lit(start) + F.col("b") * F.lit(step)).alias("threshold"),
                    F.col("below").cast("long").alias("n_deferred"),
                    (F.col("below") / F.col("n") * 100).alias("pct_deferred")))


def gate_stats(pred: DataFrame, ood: DataFrame, gate: float = L.GATE) -> DataFrame:
    """One row: kept share, OOD deferred share, accuracy of kept rows (NULL if none)."""
    kept = F.col("conf") >= gate
    a = pred.agg(F.round(F.avg(kept.cast("double")), 3).alias("in_distribution_kept_share"),
                 F.round(F.avg(F.when(kept, _correct())), 3).alias("kept_accuracy"))
    b = ood.agg(F.round(F.avg((F.col("conf") < gate).cast("double")), 3).alias("ood_deferred_share"))
    return a.join(F.broadcast(b)).select(
        F.lit(gate).alias("threshold"), "in_distribution_kept_share", "ood_deferred_share", "kept_accuracy")


def histogram(pred: DataFrame, population: str = "suite", bins: int = HIST_BINS) -> DataFrame:
    """Confidence density on [0, 1] per population; the last bin includes 1.0."""
    width = 1.0 / bins
    b = F.least(bin_of(F.col("conf"), bins, width), F.lit(bins - 1))
    counts = pred.groupBy(population, b.alias("bin")).agg(_n().alias("c"))
    grid = (counts.select(population).distinct()
            .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))))
    n = F.sum("c").over(W.partitionBy(population))
    return (grid.join(counts, [population, "bin"], "left").withColumn("c", F.coalesce("c", F.lit(0)))
            .withColumn("density", F.col("c") / (n * width))
            .select(population, "bin", F.col("c").cast("long").alias("n"), "density"))


def latency(rows: DataFrame, value: str = "ms", by: list[str] = []) -> DataFrame:
    """p50/p95 under both published rules.

    ``*_rank`` takes sorted[n // 2] and sorted[int(0.95 n)]; ``*_linear`` interpolates
    between the neighbours of (n - 1) p.
    """
    n = F.col("n")
    h50, h95 = (n - 1) * 0.5, F.round((n - 1) * 0.95, 9)
    at = kth_values(rows, value, by, {
        "p50_rank": (0.5, F.floor(n / 2)), "p95_rank": (0.95, F.least(F.floor(F.round(n * 0.95, 9)), n - 1)),
        "_a50": (0.5, F.floor(h50)), "_b50": (0.5, F.ceil(h50)),
        "_a95": (0.95, F.floor(h95)), "_b95": (0.95, F.ceil(h95))})
    def between(lo, hi, h):
        return F.col(lo) + (F.col(hi) - F.col(lo)) * (h - F.floor(h))
    return at.select(*by, "n", "p50_rank", "p95_rank", between("_a50", "_b50", h50).alias("p50_linear"),
                     between("_a95", "_b95", h95).alias("p95_linear"))


def low_confidence(pred: DataFrame, id_col: str, threshold: float = LOW_CONFIDENCE) -> DataFrame:
    """Rows below ``threshold`` with an OK/WRONG mark, in row order."""
    return (pred.filter(F.col("conf") < threshold)
            .withColumn("mark", F.when(F.col("pred") == F.col("gold"), "OK").otherwise("WRONG"))
            .orderBy(id_col))


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per label."""
    counts = rows.groupBy(label).agg(_n().alias("n_c"))
    every = W.partitionBy(F.lit(0))
    return counts.select(label, "n_c", (F.sum("n_c").over(every) / (
        F.count(F.lit(1)).over(every) * F.col("n_c"))).alias("weight"))


def evaluation_report(pred: DataFrame, labels: list[str], ood: DataFrame | None = None,
                      gate: float = L.GATE, baselines: DataFrame | None = None) -> DataFrame:
    """Long metrics table (model, suite, metric, class, value).

    ``pred`` has model, suite, gold, pred, conf; figures of different suites stay apart.
    ``density`` has the confidence histogram by bin, ``pct_deferred`` the deferral curve by cut-off.
    ``baselines`` (model, suite, eval_n, accuracy) are cached figures of other systems: they join the
    suites scored here as ``cached_n``, ``cached_accuracy`` and ``stale``, 1 where the suite has since
    changed its size.
    """
    by = ["model", "suite"]
    def long(df, metric, value, cls=None):
        return df.select(*by, F.lit(metric).alias("metric"),
                         (F.lit("") if cls is None else F.col(cls)).alias("class"),
                         F.col(value).cast("double").alias("value"))
    # One pass over the predictions; every figure below reads this label- and bin-sized table.
    cells = cut_lineage(
        pred.withColumns({"bin": bin_of(F.col("conf"), ECE_BINS, 1.0 / ECE_BINS), "kept": F.col("conf") >= gate,
                          "hist": F.least(bin_of(F.col("conf"), HIST_BINS, 1.0 / HIST_BINS), F.lit(HIST_BINS - 1)),
                          "cut": _threshold_bucket(F.col("conf"), CURVE_POINTS, CURVE_START, CURVE_STEP)})
        .groupBy(*by, "gold", "pred", "bin", "kept", "hist", "cut").agg(_n().alias("n"), F.sum("conf").alias("c")))
    hits = F.col("n") * _correct()
    overall = cells.groupBy(*by).agg(
        F.sum("n").alias("n"), (F.sum(hits) / F.sum("n")).alias("accuracy"),
        (F.sum(F.when(F.col("kept"), F.col("n")).otherwise(0)) / F.sum("n")).alias("kept_share"),
        F.try_divide(F.sum(F.when(F.col("kept"), hits)), F.sum(F.when(F.col("kept"), F.col("n")))).alias("kept_accuracy"))
    per_bin = cells.groupBy(*by, "bin").agg(F.sum("n").alias("n"), F.sum(hits).alias("ok"), F.sum("c").alias("c"))
    gap = F.when(F.col("bin") < ECE_BINS, F.abs(F.col("ok") - F.col("c"))).otherwise(0.0)
    error = per_bin.groupBy(*by).agg((F.sum(gap) / F.sum("n")).alias("ece"))
    report = class_report(cells, labels, by, weight="n")
    averages = report_averages(report, by)
    def by_slot(slot, slots):
        """Rows per slot, zeros included, with the rows up to it and of the whole suite."""
        counts = cells.groupBy(*by, slot).agg(F.sum("n").alias("c"))
        grid = overall.select(*by).withColumn(slot, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        upto = W.partitionBy(*by).orderBy(slot).rowsBetween(W.unboundedPreceding, 0)
        filled = grid.join(counts, [*by, slot], "left").withColumn("c", F.coalesce("c", F.lit(0)))
        return filled.withColumns({"upto": F.sum("c").over(upto), "whole": F.sum("c").over(W.partitionBy(*by)),
                                   "slot": F.col(slot).cast("string")})

    hist = by_slot("hist", HIST_BINS).withColumn("density", F.col("c") / (F.col("whole") * F.lit(1.0 / HIST_BINS)))
    curve = by_slot("cut", CURVE_POINTS + 1).filter(F.col("cut") < CURVE_POINTS).withColumn(
        "pct_deferred", F.col("upto") / F.col("whole") * 100)
    parts = [long(overall, m, m) for m in ("n", "accuracy", "kept_share", "kept_accuracy")]
    parts += [long(error, "ece", "ece"), long(hist, "density", "density", "slot"),
              long(curve, "pct_deferred", "pct_deferred", "slot")]
    parts += [long(report, m, m, "label") for m in ("precision", "recall", "f1", "support")]
    parts += [long(averages, m, m) for m in ("macro_f1", "weighted_f1")]
    if ood is not None:
        deferred = ood.groupBy(*by).agg(F.avg((F.col("conf") < gate).cast("double")).alias("v"))
        parts.append(long(deferred, "ood_deferred_share", "v"))
    if baselines is not None:
        now = overall.groupBy("suite").agg(F.max("n").alias("_now"))
        cached = baselines.join(F.broadcast(now), "suite").withColumn("stale", (F.col("eval_n") != F.col("_now")).cast("int"))
        parts += [long(cached, m, c) for m, c in (("cached_n", "eval_n"), ("cached_accuracy", "accuracy"), ("stale", "stale"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
