"""Exact ranks, k-th values and splits without ordering all rows in one task.

Both helpers narrow first and order last: counts over buckets find where the cut
falls, and only the rows of the cut bucket are ever ranked by a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cuelake.functions.draws import draw_hash
from cuelake.operators.skew import small_enough
from cuelake.session import written

HEX_DIGITS = 5          # 16**5 buckets: a cut bucket holds about a millionth of a group
SKETCH_ACCURACY = 100_000
FEW_GROUPS = 10_000     # label-like grouping: per-group rows below this are broadcast


def _per_group(side: DataFrame, groups: list[str], rows: DataFrame) -> DataFrame:
    """Broadcast a one-row-per-group side if the groups are few, else leave it to the join."""
    if not groups or small_enough(rows.select(*groups).distinct(), FEW_GROUPS):
        return F.broadcast(side)
    return side


def smallest_hashes(rows: DataFrame, groups: list[str], hash_col: str, id_col: str,
                    quotas: DataFrame, digits: int = HEX_DIGITS, one_group: bool = False) -> DataFrame:
    """Add ``chosen``: whether the row is among its group's ``k`` smallest hashes.

    ``quotas`` has ``groups`` + ``k``. The hash is an md5 of a unique id, so buckets by
    its leading digits are even whatever the data holds. ``one_group`` says that all rows
    are of one group, which spares the pass that counts the groups.
    """
    bucketed = rows.withColumn("_b", F.conv(F.substring(hash_col, 1, digits), 16, 10).cast("int"))
    sizes = bucketed.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy(*groups).orderBy("_b").rowsBetween(W.unboundedPreceding, 0)
    cut = (sizes.withColumn("_cum", F.sum("_n").over(upto)).join(quotas, groups)
           .filter((F.col("_cum") >= F.col("k")) & (F.col("_cum") - F.col("_n") < F.col("k")))
           .select(*groups, F.col("_b").alias("_cut"),
                   (F.col("k") - (F.col("_cum") - F.col("_n"))).alias("_rest")))
    # No cut row: the quota is zero (nothing chosen) or exceeds the group (all chosen).
    limits = quotas.join(cut, groups, "left").select(
        *groups, F.coalesce("_cut", F.when(F.col("k") > 0, 16 ** digits).otherwise(-1)).alias("_cut"),
        F.coalesce("_rest", F.lit(0)).alias("_rest"))
    side = F.broadcast(limits) if one_group else _per_group(limits, groups, rows)
    placed = bucketed.join(side, groups, "left")
    settled = placed.filter("_cut is null or _b <> _cut").withColumn(
        "chosen", F.coalesce(F.col("_b") < F.col("_cut"), F.lit(False)))
    at_cut = placed.filter("_b = _cut").withColumn(
        "chosen", F.row_number().over(W.partitionBy(*groups).orderBy(hash_col, id_col)) <= F.col("_rest"))
    cols = [*rows.columns, "chosen"]
    return settled.select(*cols).unionByName(at_cut.select(*cols))


def stratified_quotas(rows: DataFrame, label: str, fraction: float) -> DataFrame:
    """Exact per-class sizes of a ``fraction`` sample by largest remainder.

    The total is ceil(n * fraction); classes get their floor, and the classes with the
    largest remainders (ties by label) get one more until the total is met.
    """
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    share = F.round(F.col("n") * F.lit(fraction), 9)
    every = W.partitionBy(F.lit(0))
    parts = (counts.withColumn("_floor", F.floor(share)).withColumn("_rem", share - F.floor(share))
             .withColumn("_total", F.ceil(F.round(F.sum("n").over(every) * F.lit(fraction), 9)))
             .withColumn("_missing", F.col("_total") - F.sum("_floor").over(every)))
    order = every.orderBy(F.desc("_rem"), label)
    extra = F.when(F.row_number().over(order) <= F.col("_missing"), 1).otherwise(0)
    return parts.select(label, (F.col("_floor") + extra).cast("long").alias("k"))


def stratified_split(rows: DataFrame, id_col: str, label: str, fraction: float = 0.2,
                     seed: int = 7) -> DataFrame:
    """Add ``chosen``: the row belongs to the held-out part. Exact sizes per class."""
    hashed = rows.withColumn("_h", draw_hash(seed, F.col(id_col)))
    quotas = stratified_quotas(rows, label, fraction)
    return smallest_hashes(hashed, [label], "_h", id_col, quotas).drop("_h")


def random_split(rows: DataFrame, id_col: str, fraction: float = 0.2, seed: int = 11) -> DataFrame:
    """Add ``chosen`` for exactly floor(n * fraction) rows."""
    hashed = rows.withColumn("_h", draw_hash(seed, F.col(id_col))).withColumn("_all", F.lit(0))
    quotas = hashed.groupBy("_all").agg(
        F.floor(F.round(F.count(F.lit(1)) * F.lit(fraction), 9)).cast("long").alias("k"))
    return smallest_hashes(hashed, ["_all"], "_h", id_col, quotas, one_group=True).drop("_h", "_all")


def shuffled(rows: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Deterministic shuffle: a range-partitioned sort by hash."""
    return (rows.withColumn("_h", draw_hash(seed, F.col(id_col)))
            .orderBy("_h", id_col).drop("_h"))


def positions(rows: DataFrame, group: str, order: list[str], out: str = "pos") -> DataFrame:
    """Add each row's 0-based place in its group, in a total order, without one task per group.

    Rows are cut into ranges of (group, order); a range knows how many rows of its group
    come before it, from one count per range and group.
    """
    ranged = written(rows.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(group, "_range").orderBy(*order)) - 1
    placed = ranged.withColumn("_inside", inside).join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    return placed.select(*rows.columns, (F.col("_inside") + F.col("_before")).cast("long").alias(out))


def kth_values(rows: DataFrame, value: str, groups: list[str],
               ranks: dict[str, tuple[float, Column]], accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Exact order statistics per group: ``n`` and one column per name.

    ``ranks`` maps a name to (p, 0-based rank), the rank being an expression over the
    group size ``n`` that lies within one row of p * n. A bounded quantile sketch brackets
    p within 2/accuracy, so about 4/accuracy of the rows are counted per distinct value
    and only those counts are ordered.
    """
    names = list(ranks)
    pad = 2.0 / accuracy
    bounds = [F.percentile_approx(value, min(max(p + d, 0.0), 1.0), accuracy).alias(f"_{side}_{m}")
              for m, (p, _) in ranks.items() for side, d in (("lo", -pad), ("hi", pad))]
    stats = rows.groupBy(*groups).agg(
        F.count(value).alias("n"), F.min(value).alias("_min"), F.max(value).alias("_max"), *bounds)
    # Widen by one rank on tiny groups, where a row is more than the padding.
    tiny = F.col("n") <= F.lit(accuracy)
    brackets = stats.select(*groups, F.explode(F.array(*[F.struct(
        F.lit(m).alias("name"), ranks[m][1].cast("long").alias("rank"),
        F.when(tiny, F.col("_min")).otherwise(F.col(f"_lo_{m}")).alias("lo"),
        F.when(tiny, F.col("_max")).otherwise(F.col(f"_hi_{m}")).alias("hi")) for m in names])).alias("w")
    ).select(*groups, "w.*")
    values = rows.select(*groups, F.col(value).alias("_v")).filter("_v is not null")
    side = _per_group(brackets, groups, rows)
    tagged = values.join(side, groups) if groups else values.join(side)
    at = F.when(F.col("_v") >= F.col("lo"), F.col("_v"))
    counted = (tagged.filter(F.col("_v") <= F.col("hi"))
               .groupBy(*groups, "name", "rank", at.alias("_at")).agg(F.count(F.lit(1)).alias("_n")))
    upto = W.partitionBy(*groups, "name").orderBy(F.col("_at").asc_nulls_first()).rowsBetween(
        W.unboundedPreceding, 0)
    hit = counted.withColumn("_cum", F.sum("_n").over(upto)).filter(
        F.col("_at").isNotNull() & (F.col("_cum") > F.col("rank"))
        & (F.col("_cum") - F.col("_n") <= F.col("rank")))
    wide = hit.groupBy(*groups).agg(F.count(F.lit(1)).alias("_found"), *[
        F.max(F.when(F.col("name") == m, F.col("_at"))).alias(m) for m in names])
    sizes = stats.select(*groups, "n")
    out = sizes.join(wide, groups, "left") if groups else sizes.join(F.broadcast(wide))
    complete = (F.col("n") == 0) | (F.col("_found") == len(names))
    checked = F.when(complete, F.col("n")).otherwise(F.raise_error(F.lit("rank outside its bracket")))
    return out.select(*groups, checked.alias("n"), *names)
