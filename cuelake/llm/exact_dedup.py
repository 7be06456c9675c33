"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition first reduces its rows to one run: its distinct digests, sorted,
with the count and the identifier to retain. Runs then meet in binomial rounds: a round
clears the lowest ``merge_bits`` bits of the run number, so ``2 ** merge_bits`` runs are
merged multiway: cut into ranges of digests, put into one order and folded neighbour by
neighbour, retaining one identifier per digest. The last run knows every group;
groups of more than one row travel back down the same tree to the rows. No task ever
holds more rows of one digest than there are runs in a merge or rows in a partition,
so a group of copies of any size is never gathered in one place.

A merge is verified: digests only meet if SHA-256, byte length and a second hash of
the text all agree. Only digests move, texts are read once and never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from cuelake.llm.common import stored, text_of

KEY = ["digest", "n_bytes", "probe"]
# monotonically_increasing_id holds the partition above this bit.
ROW_BITS = 33
LOWEST = -(1 << 63)


def _preferred(keep: str) -> list:
    """Which of a digest's rows comes first: a null id after any other, then the lowest row number."""
    return [F.desc_nulls_last("keep_id") if keep == "largest" else F.asc_nulls_last("keep_id"), F.asc("keep_row")]


def _runs(rows: DataFrame, keep: str) -> DataFrame:
    """Sorted runs: one per input partition, each digest once (combined before anything moves)."""
    best, best_by = (F.max, F.max_by) if keep == "largest" else (F.min, F.min_by)
    rank = F.coalesce("keep_id", F.lit(LOWEST if keep == "largest" else -(LOWEST + 1)))
    return (rows.groupBy("run", *KEY)
            .agg(F.sum("n").alias("n"), best("keep_id").alias("keep_id"),
                 best_by("keep_row", rank).alias("keep_row"))
            .sortWithinPartitions("run", *KEY))


def _merge(rows: DataFrame, keep: str) -> DataFrame:
    """Runs that now carry one number become one sorted run.

    The runs are cut into ranges of digests, the pieces of a range are brought into one
    order, and one streaming pass folds equal neighbours. A run has a digest once, so
    neighbours are at most as many as the runs that meet; nothing is hashed or held.
    """
    first = _preferred(keep)
    same = Window.partitionBy("run", *KEY).orderBy(*first)
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = rows.repartitionByRange("run", "digest").sortWithinPartitions("run", *KEY, *first)
    return (ordered.withColumns({"_at": F.row_number().over(same), "n": F.sum("n").over(whole)})
            .filter("_at = 1").drop("_at"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "smallest", merge_bits: int = 4, name: str = "exact") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, row.

    ``row`` numbers the input rows. Null text counts as empty; a null id loses to any
    other; of rows repeating both id and text one is kept; an empty table gives an
    empty result; further columns of ``docs`` are ignored whatever their names.
    """
    text = text_of(docs[text_col])
    base = stored(docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("probe"),
        F.monotonically_increasing_id().alias("row"))
        .withColumn("run", F.shiftright("row", ROW_BITS)), f"{name}-digests")
    last = base.agg(F.max("run")).first()[0] or 0
    rounds = math.ceil(math.log2(last + 1) / merge_bits) if last else 0

    levels = [stored(_runs(base.select("run", *KEY, F.lit(1).cast("bigint").alias("n"),
                                       F.col("doc_id").alias("keep_id"),
                                       F.col("row").alias("keep_row")), keep), f"{name}-run0")]
    for k in range(rounds):
        up = levels[-1].withColumn("run", F.shiftright("run", merge_bits))
        levels.append(stored(_merge(up, keep), f"{name}-run{k + 1}"))

    groups = levels[-1].filter("n > 1")
    for level in reversed(levels[:-1]):
        child = level.select("run", F.shiftright("run", merge_bits).alias("up"), *KEY)
        groups = child.join(groups.withColumnRenamed("run", "up"), ["up", *KEY]).drop("up")
    found = base.join(groups, ["run", *KEY], "left")
    return found.select(
        "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("n").isNull() | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "row")
