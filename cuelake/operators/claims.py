"""First come, first served over two sides: rows take keys in turn, without taking turns.

Rows in order of their id each take their first ``per_row`` keys that no earlier row
has. Decided side by side, round by round: every row asks for its first ``per_row`` keys
not refused yet, every key refuses all but the smallest id asking, and refused keys are
struck from the row's list. A key once refused to a row stays refused, as the row that
has it is only ever replaced by an earlier one; so when nothing is refused any more,
everybody has what the turns would have given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from cuelake.operators.skew import attach_per_key, exclude_keys
from cuelake.session import written


@dataclass
class Claims:
    kept: DataFrame  # id, attempt, key
    rounds: int


def claim_in_turn(candidates: DataFrame, blocked: DataFrame | None, id_col: str, per_row: int) -> Claims:
    """``candidates`` has (id, attempt, key), keys being digests; NULL keys are unusable.

    ``blocked`` lists keys nobody gets. A row holds few candidates (its attempts), a key
    may have any number. Every round strikes at least one candidate; in practice a handful
    of rounds settles all.
    """
    own = candidates.filter("key IS NOT NULL").groupBy(id_col, "key").agg(F.min("attempt").alias("attempt"))
    alive = own if blocked is None else exclude_keys(own, blocked, "key", spread=F.col(id_col))
    alive, rounds = written(alive, "claims"), 0
    while True:
        rounds += 1
        turn = F.row_number().over(W.partitionBy(id_col).orderBy("attempt"))
        asked = alive.withColumn("_turn", turn).filter(F.col("_turn") <= per_row).drop("_turn")
        owners = asked.groupBy("key").agg(F.min(id_col).alias("_owner"), F.count(F.lit(1)).alias("n"))
        judged = written(attach_per_key(asked, owners, "key", F.col(id_col)), "claims-judged")
        lost = judged.filter(F.col(id_col) != F.col("_owner")).select(id_col, "key")
        if lost.isEmpty():
            return Claims(judged.select(id_col, "attempt", "key"), rounds)
        alive = written(alive.join(lost, [id_col, "key"], "left_anti"), "claims")
