"""Identifiers of rows for tables whose ids repeat with another text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cuelake.llm.common import sha256_hex, stored, text_of
from cuelake.llm.mixing import running_sum


def ranked_rows(docs: DataFrame, id_col: str, text_col: str, name: str, *more) -> tuple[DataFrame, DataFrame]:
    """Rows (rank, text, further columns) and the names (rank, id) of their ranks.

    A rank stands for one id with one text and keeps the order of the ids, texts of one
    id following each other by digest; rows of a null id have none.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("_id"), text_of(docs[text_col]).alias("text"), *more).withColumn("_sha", sha256_hex(F.col("text")))
    pairs = rows.filter("_id IS NOT NULL").select("_id", "_sha").distinct()
    ranks = stored(running_sum(pairs, ["_id", "_sha"], F.lit(1).cast("bigint"), "rank", f"{name}-order"), f"{name}-ranks")
    keyed = rows.join(ranks, ["_id", "_sha"], "left").drop("_id", "_sha")
    return keyed, ranks.select("rank", F.col("_id").alias("id"))
