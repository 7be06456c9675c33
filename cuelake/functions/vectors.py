"""Linear-head scoring on array columns.

Each step is a higher-order function over the row's own array, so a batch scores
without exploding a row or leaving the JVM. The head is one row: an array with
one struct per class, in class-index order.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``; a Column used twice inside a
    lambda would otherwise be recomputed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def as_double(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def l2_normalize(vec: Column, floor: float = 1e-12) -> Column:
    return let(vec, lambda v: let(F.greatest(F.sqrt(dot(v, v)), F.lit(floor)),
                                  lambda norm: F.transform(v, lambda x: x / norm)))


def logits(vec: Column, head: Column) -> Column:
    return F.transform(head, lambda h: dot(vec, h["coef"]) + h["intercept"])


def scale(values: Column, temperature: Column | float) -> Column:
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    return F.transform(values, lambda z: z / t)


def softmax(values: Column) -> Column:
    """Stable softmax: the largest value is subtracted first."""
    return let(values, lambda z: let(F.array_max(z), lambda top: let(
        F.transform(z, lambda x: F.exp(x - top)), lambda e: let(
            _sum(e), lambda total: F.transform(e, lambda x: x / total)))))


def log_sum_exp(values: Column) -> Column:
    return let(values, lambda z: let(F.array_max(z), lambda top: (
        top + F.log(_sum(F.transform(z, lambda x: F.exp(x - top)))))))


def argmax(values: Column) -> Column:
    """0-based index of the largest value; the lowest index on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def distribution(probs: Column, labels: Column) -> Column:
    """Array of (label, prob) by falling probability, class order on ties, 4 dp."""
    zipped = F.transform(probs, lambda p, i: F.struct((-p).alias("neg"), i.alias("idx")))
    return F.transform(F.array_sort(zipped), lambda s: F.struct(
        F.get(labels, s["idx"]).alias("label"), F.round(-s["neg"], 4).alias("prob")))
