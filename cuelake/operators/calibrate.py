"""Temperature fitting by repeated grid passes over cached logits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from cuelake.functions import vectors as V
from cuelake.operators.metrics import ece

# Search bounds, tolerance, the calibration level that rules out T < 1,
# and the probability floor of the loss.
T_LOW, T_HIGH = 0.5, 20.0
T_TOLERANCE = 1e-6
WELL_CALIBRATED = 0.05
P_FLOOR = 1e-12
GRID_POINTS = 41


def row_nll(logits: Column, gold_idx: Column, temperature: Column) -> Column:
    """Negative log softmax probability of the gold class at one temperature, clipped."""
    z = V.scale(logits, temperature)
    nll = V.let(z, lambda s: V.log_sum_exp(s) - F.get(s, gold_idx))
    return F.least(F.greatest(nll, F.lit(0.0)), -F.log(F.lit(P_FLOOR)))


def nll_grid(scored: DataFrame, temperatures: list[float], by: list[str] = []) -> DataFrame:
    """(temperature, nll) for every temperature, in one pass.

    A row contributes one small vector of losses and the vectors are averaged map-side,
    so rows are not multiplied by the grid. ``scored`` has logits and gold_idx.
    """
    grid = F.array(*[F.lit(float(t)) for t in temperatures])
    losses = F.transform(grid, lambda t: row_nll(F.col("logits"), F.col("gold_idx"), t))
    mean = scored.groupBy(*by).agg(Summarizer.mean(array_to_vector(losses)).alias("m"))
    pairs = F.zip_with(grid, vector_to_array("m"), lambda t, v: F.struct(
        t.alias("temperature"), v.alias("nll")))
    return mean.select(*by, F.explode(pairs).alias("p")).select(*by, "p.temperature", "p.nll")


@dataclass
class TemperatureFit:
    temperature: float
    optimum: float
    nll: float
    nll_at_one: float
    ece_at_one: float
    clamped: bool


def with_gold_index(scored: DataFrame, gold: str = "gold") -> DataFrame:
    return scored.withColumn("gold_idx", (F.array_position("class_labels", F.col(gold)) - 1).cast("int"))


def fit_temperature(scored: DataFrame, low: float = T_LOW, high: float = T_HIGH,
                    tolerance: float = T_TOLERANCE, points: int = GRID_POINTS) -> TemperatureFit:
    """Minimise the mean loss over T in [low, high].

    Each pass evaluates a grid and the next one spans one step to either side of the best
    point, so the interval shrinks twentyfold per pass (about six passes). Only the grid's
    means reach the driver. T < 1 is refused (T = 1) when the model is already well
    calibrated at T = 1: sharpening would leave the confidence gate nothing to tell apart.
    """
    cached = scored.select("logits", "gold_idx", "class_labels", "gold").persist(StorageLevel.DISK_ONLY)
    try:
        a, b = low, high
        best, loss = low, float("inf")
        while True:
            step = (b - a) / (points - 1)
            grid = [a + i * step for i in range(points)]
            means = {r["temperature"]: r["nll"] for r in nll_grid(cached, grid).collect()}
            best = min(grid, key=lambda t: (means[t], t))
            loss = means[best]
            if step < tolerance:
                break
            a, b = max(low, best - step), min(high, best + step)
        at_one = nll_grid(cached, [1.0]).first()["nll"]
        probs = cached.withColumn("probs", V.softmax(F.col("logits")))
        pred = probs.select("gold", F.get("class_labels", V.argmax(F.col("probs"))).alias("pred"),
                            F.array_max("probs").alias("conf"))
        ece_one = ece(pred).first()["ece"]
    finally:
        cached.unpersist()
    clamp = best < 1.0 and ece_one < WELL_CALIBRATED
    return TemperatureFit(1.0 if clamp else best, best, loss, at_one, ece_one, clamp)
