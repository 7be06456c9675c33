"""Contrastive pairs: R same-class and R other-class pairs per class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from cuelake.functions.draws import draw_hash
from cuelake.operators.ranks import smallest_hashes

ITERATIONS = 40


def _ranked_draw(rows: DataFrame, id_col: str, label: str, seed: int, salt: str, k: int) -> DataFrame:
    """The ``k`` rows of each class with the smallest salted hashes, ranked from 0.

    At most k rows per class reach the ranking window.
    """
    hashed = rows.select(id_col, label).withColumn("_h", draw_hash(seed, F.col(id_col), salt))
    quotas = rows.select(label).distinct().withColumn("k", F.lit(k).cast("long"))
    top = smallest_hashes(hashed, [label], "_h", id_col, quotas).filter("chosen")
    order = W.partitionBy(label).orderBy("_h", id_col)
    return top.select(label, id_col, (F.row_number().over(order) - 1).alias("rank"),
                      F.count(F.lit(1)).over(W.partitionBy(label)).alias("m"))


def contrastive_pairs(rows: DataFrame, id_col: str, label: str, iterations: int = ITERATIONS,
                      seed: int = 0) -> DataFrame:
    """(label, i, positive, anchor, partner): 2 * iterations pairs per class present.

    Draw i uses the i-th row of two hashed orders of the class, wrapping round in classes
    smaller than ``iterations``; a positive partner equal to its anchor moves on by one,
    and a class of one row has no positive pairs. Negative partners come from the other
    classes in turn.
    """
    a = _ranked_draw(rows, id_col, label, seed, "anchor", iterations + 1)
    b = _ranked_draw(rows, id_col, label, seed, "partner", iterations + 1)
    classes = a.select(label, "m").distinct()
    order = W.partitionBy(F.lit(0)).orderBy(label)
    numbered = classes.select(label, "m", (F.row_number().over(order) - 1).alias("c"),
                              F.count(F.lit(1)).over(W.partitionBy(F.lit(0))).alias("k"))
    draws = numbered.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))))
    anchored = draws.withColumn("rank", F.pmod("i", "m")).join(
        a.select(label, "rank", F.col(id_col).alias("anchor")), [label, "rank"]).drop("rank")

    pick = b.select(F.col(label).alias("_l"), F.col("rank").alias("_r"), F.col(id_col).alias("partner"))
    same = F.col(label) == F.col("_l")
    first = anchored.join(pick, same & (F.pmod("i", "m") == F.col("_r"))).drop("_l", "_r")
    step = first.withColumn("_want", F.when(F.col("partner") == F.col("anchor"), F.pmod(F.col("i") + 1, "m"))
                            .otherwise(F.pmod("i", "m"))).drop("partner")
    positive = (step.filter("m > 1").join(pick, same & (F.col("_want") == F.col("_r")))
                .select(label, "i", F.lit(True).alias("positive"), "anchor", "partner"))

    other = numbered.select(F.col(label).alias("_ol"), F.col("c").alias("_oc"), F.col("m").alias("_om"))
    turn = F.pmod(F.col("c") + 1 + F.pmod(F.col("i"), F.col("k") - 1), "k")
    negative = (anchored.filter("k > 1").join(other, turn == F.col("_oc"))
                .join(pick, (F.col("_ol") == F.col("_l")) & (F.pmod("i", "_om") == F.col("_r")))
                .select(label, "i", F.lit(False).alias("positive"), "anchor", "partner"))
    return positive.unionByName(negative)
