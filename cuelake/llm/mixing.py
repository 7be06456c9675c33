"""Mixing sources to target weights by entropy balancing.

Documents get rates as close as possible (Kullback-Leibler) to one each, bounded by
``cap``, such that every source's expected words meet its target. The dual is convex
with one multiplier per source, the rates are ``min(cap, exp(multiplier * size))``, and
Newton's method finds the multipliers. Sizes are first counted into (source, size)
cells, so an iteration aggregates cells, not documents; sums are exact decimals, so a
rerun gives the same rates whatever the order of the tasks.

Rates become copies by systematic rounding: documents in order of (source, size), and
a copy whenever the running sum of fractions passes the next whole number. Sorted by
size, that keeps a source within about one document of its target; of OFFSETS starting
points per source, the one nearest to the target is taken. The running sum is a range
partitioning plus offsets per partition, so no source is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cuelake.llm.common import stored, words
from cuelake.operators.skew import attach_per_key

WEIGHTS = (5, 2, 1)
CAP = 3
TOLERANCE = 1e-9
MAX_NEWTON = 100
# Fractions of a copy are whole multiples of this, so their sums are exact.
UNIT = 1 << 24
OFFSETS = 64


def running_sum(rows: DataFrame, order: list[str], value: Column, out: str, name: str) -> DataFrame:
    """Inclusive running sum over a total order of all rows, without one big window."""
    ranged = stored(rows.withColumn("_v", value).repartitionByRange(*order)
                    .withColumn("_part", F.spark_partition_id()), name)
    # One row per partition of the range exchange: bounded by the shuffle's size.
    before = (ranged.groupBy("_part").agg(F.sum("_v").alias("_sum"))
              .select("_part", F.coalesce(F.sum("_sum").over(
                  W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before")))
    inside = F.sum("_v").over(W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return (ranged.withColumn("_in", inside).join(F.broadcast(before), "_part")
            .withColumn(out, F.col("_in") + F.col("_before")).drop("_v", "_in", "_before", "_part"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(key, source, source_size, ...) plus target.

    Weights repeat over the sources by code point, null last. Shares above ``cap`` times
    the source stop there, and the rest is shared again until none is above.
    """
    ranked = running_sum(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], F.lit(1), "rank", "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    rows = stored(ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * cap), "weights")
    level, stopped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > F.col("limit")
        now = rows.agg(F.sum("source_size").alias("all"), F.sum(above.cast("int")).alias("stopped"),
                       F.sum(F.when(above, F.col("limit"))).alias("fixed"),
                       F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        if level is not None and now["stopped"] == stopped or not now["weight"]:
            break
        level, stopped = (now["all"] - (now["fixed"] or 0)) / now["weight"], now["stopped"]
    return rows.withColumn("target", F.least(F.col("weight") * (level or 0.0), F.col("limit").cast("double"))).drop("last", "rank")


def _rate(cap: int) -> Column:
    """The rate of a size; sources at their limit or without words are settled."""
    return (F.when(F.col("pinned"), F.lit(float(cap))).when(F.col("source_size") == 0, F.lit(1.0))
            .otherwise(F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("size") / F.col("largest")))))


def fit_multipliers(cells: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Newton's method on the dual, all sources side by side, each within its bracket.

    ``cells``: (key, size, n). Adds lam, pinned. Works on the logarithm of the words
    gathered, which is nearly linear in the multiplier.
    """
    state = stored(targets.select(
        "key", "source_size", "largest", "target",
        (F.col("target") >= F.col("limit") * (1 - 1e-12)).alias("pinned"),
        F.lit(0.0).alias("lam"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"),
        F.lit(1.0).alias("gap")), "dual")
    held = [F.first(c).alias(c) for c in ("source_size", "largest", "target", "pinned", "lam", "lo", "hi")]
    for k in range(MAX_NEWTON):
        at = cells.join(state, "key").withColumn("w", F.when(~F.col("pinned") & (F.col("source_size") > 0), _rate(cap)))
        words_at = F.col("n") * F.col("size") * F.col("w")
        slope = F.when(F.col("w") < cap, words_at * F.col("size") / F.col("largest")).when(F.col("w").isNotNull(), 0.0)
        # Every source has a cell, so the sums carry the state along; a settled one has none.
        new = at.groupBy("key").agg(*held, F.sum(words_at.cast("decimal(38,9)")).cast("double").alias("got"),
                                    F.sum(slope.cast("decimal(38,9)")).cast("double").alias("slope"))
        lo = F.when(F.col("got") <= F.col("target"), F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("got") >= F.col("target"), F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - (F.log("got") - F.log("target")) * F.col("got") / F.col("slope")
        half = (F.when(F.col("hi2") == float("inf"), F.abs("lam") * 2 + 1).when(F.col("lo2") == float("-inf"), -F.abs("lam") * 2 - 1)
                .otherwise((F.col("lo2") + F.col("hi2")) / 2))
        ok = (F.col("slope") > 0) & (F.col("got") > 0) & (newton > F.col("lo2")) & (newton < F.col("hi2"))
        gap = F.abs(F.col("got") - F.col("target")) / F.col("target")
        state = stored(new.withColumn("lo2", lo).withColumn("hi2", hi).withColumn("gap2", F.coalesce(gap, F.lit(0.0))).select(
            "key", "source_size", "largest", "target", "pinned",
            F.when(F.col("gap2") <= TOLERANCE, F.col("lam")).when(ok, newton).otherwise(half).alias("lam"),
            F.coalesce("lo2", "lo").alias("lo"), F.coalesce("hi2", "hi").alias("hi"), F.col("gap2").alias("gap")), f"dual{k}")
        if state.filter(F.col("gap") > TOLERANCE).isEmpty():
            return state
    raise RuntimeError(f"targets not met to {TOLERANCE} after {MAX_NEWTON} rounds")


def _whole(units: Column) -> Column:
    return F.shiftright(units, UNIT.bit_length() - 1)


def _copies(offset: Column) -> Column:
    """Copies of a row: its whole ones, and one if its fraction passes a whole number."""
    upto = F.col("_at") + offset
    return _whole(F.col("_units")) + _whole(upto) - _whole(upto - F.pmod(F.col("_units"), F.lit(UNIT)))


def _best_offsets(laid: DataFrame) -> DataFrame:
    """(key, n, _offset): of the starting points of a source, the first whose words come nearest to the target.

    Over the starting points, a row's fraction gives a copy from one of them (``on``) up to
    another (``off``), around the end. The words at all of them are running sums of these
    edges, and the nearest is an edge or the first: no starting point is a column of its own.
    """
    step = UNIT // OFFSETS
    at, part = F.pmod(F.col("_at"), F.lit(UNIT)), F.pmod(F.col("_units"), F.lit(UNIT))
    steps = lambda units: F.shiftright(units + (step - 1), step.bit_length() - 1)  # noqa: E731  rounded up
    off = steps(part - at)
    cells = laid.groupBy("key", steps(F.lit(UNIT) - at).alias("on"), F.when(off > 0, off).otherwise(off + OFFSETS).alias("off")).agg(
        F.sum(F.col("size") * _copies(F.lit(0))).alias("start"), F.sum("size").alias("size"), F.first("target").alias("t"), F.count("*").alias("n"))
    none = F.lit(0).cast("bigint")
    edge = lambda k, got, n: F.struct(k.alias("k"), got.alias("got"), n.alias("n"))
    edges = cells.select("key", "t", F.explode(F.array(
        edge(none, F.col("start"), F.col("n")), edge(F.col("on"), F.col("size"), none), edge(F.col("off"), -F.col("size"), none))).alias("e"))
    moves = edges.filter(F.col("e.k") < OFFSETS).groupBy("key", "e.k").agg(
        F.first("t").alias("t"), F.sum("e.got").alias("got"), F.sum("e.n").alias("n"))
    upto = F.sum("got").over(W.partitionBy("key").orderBy("k").rowsBetween(W.unboundedPreceding, 0))
    return moves.withColumn("miss", F.abs(upto - F.col("t"))).groupBy("key").agg(
        F.sum("n").alias("n"), (F.min_by("k", F.struct("miss", "k")) * step).alias("_offset"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, carry: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, rate, copies, taken.

    Null text has no words (rate 1, nothing taken); null sources form a source of their
    own, last; repeated rows and ids are rounded one by one; texts of any length count
    whole; rows of equal size are rounded in order of id and place; an empty table gives
    an empty result; further columns are ignored. ``copies`` is at most ``cap``.
    ``carry`` is a column of the input returned as ``carried``.
    """
    source = docs[source_col].cast("string")
    rows = stored(docs.select(
        docs[id_col].alias("doc_id"), source.alias("source"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("key"),
        F.size(words(docs[text_col])).cast("bigint").alias("size"), F.monotonically_increasing_id().alias("row"),
        *([] if carry is None else [carry.alias("carried")])), "sizes")
    cells = stored(rows.groupBy("key", "source", "size").agg(F.count("*").alias("n")), "cells")
    sizes = cells.groupBy("key", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"),
                                               F.max("size").alias("largest"), F.sum("n").alias("n"))
    targets = source_targets(sizes, weights, cap)
    fitted = fit_multipliers(cells.drop("source"), targets, cap)
    per_source = targets.select("key", "n").join(fitted.drop("lo", "hi", "gap"), "key")
    rated = (attach_per_key(rows, per_source, "key", F.col("row")).withColumn("rate", _rate(cap))
             .withColumn("_units", F.round(F.col("rate") * UNIT).cast("bigint")))
    laid = running_sum(rated, ["key", "size", "doc_id", "row"], F.pmod(F.col("_units"), F.lit(UNIT)), "_at", "laid")

    laid = stored(laid, "rounded")
    best = stored(_best_offsets(laid), "offsets")
    done = attach_per_key(laid, best, "key", F.col("row")).withColumn("copies", _copies(F.col("_offset")))
    return done.select("doc_id", "source", "size", "source_size", "target", "rate", "copies",
                       (F.col("size") * F.col("copies")).alias("taken"), *([] if carry is None else ["carried"]))
