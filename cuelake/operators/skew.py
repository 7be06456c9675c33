"""Key joins that hold when one key owns a large share of the rows.

The pattern everywhere: aggregate per key first (map-side partial aggregation
absorbs any hot key), then attach the per-key result to the rows. Attaching is the
step that would send a hot key's rows to one task, so the few heaviest keys are
attached by a broadcast of at most HOT_KEYS rows of fixed width, and only the rest
goes through the shuffle join. Rows already served by the broadcast get a spread
join key so they do not pile up either. No row is dropped on either path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# At most HOT_KEYS keys are broadcast, so any other key has < 1/HOT_KEYS of the rows.
HOT_KEYS = 1000
# A key below this many rows is no burden to one task.
HOT_ROWS = 100_000
# Digest lists up to this many rows (32 bytes each) are broadcast; longer ones shuffle.
BROADCAST_ROWS = 1_000_000


def spread_key(on: Column, kind: str) -> Column:
    """A key derived from ``on`` that no real key equals.

    Binary keys are digests of 32 bytes, this one has 9. String keys are word terms,
    which never start with a NUL character.
    """
    hashed = F.lpad(F.hex(F.xxhash64(on)), 18, "0")
    return F.unhex(hashed) if kind == "binary" else F.concat(F.lit("\u0000"), hashed)


def attach_per_key(rows: DataFrame, per_key: DataFrame, key: str, spread: Column,
                   weight: str = "n", hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Left-join ``per_key`` (one row per digest, with a row count) to ``rows``.

    ``spread`` is any column that varies within a key, such as the row id.
    """
    values = [c for c in per_key.columns if c not in (key, weight)]
    packed = F.struct(*values)
    hot = (per_key.filter(F.col(weight) >= hot_rows)
           .orderBy(F.desc(weight), F.col(key)).limit(hot_keys)
           .select(F.col(key).alias("_hot_key"), packed.alias("_hot")))
    cold = per_key.select(F.col(key).alias("_cold_key"), packed.alias("_cold"))
    probed = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    probed = probed.withColumn(
        "_join_key", F.when(F.col("_hot_key").isNull(), F.col(key)).otherwise(
            spread_key(spread, dict(rows.dtypes)[key])))
    joined = probed.join(cold, F.col("_join_key") == F.col("_cold_key"), "left")
    value = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[value[c].alias(c) for c in values])


def small_enough(keys: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``keys`` has at most ``limit`` rows; reads no more than that."""
    return keys.limit(limit + 1).count() <= limit


def _membership(rows: DataFrame, keys: DataFrame, key: str, limit: int, how: str,
                spread: Column) -> DataFrame:
    members = keys.select(key).distinct()
    if small_enough(members, limit):
        return rows.join(F.broadcast(members), key, how)
    both = (rows.select(key, F.lit(0).alias("_m"), F.lit(1).alias("_w"))
            .unionByName(members.select(key, F.lit(1).alias("_m"), F.lit(0).alias("_w"))))
    per_key = both.groupBy(key).agg(F.max("_m").alias("_member"), F.sum("_w").alias("n"))
    flagged = attach_per_key(rows, per_key, key, spread)
    wanted = 1 if how == "left_semi" else 0
    return flagged.filter(F.coalesce("_member", F.lit(0)) == wanted).drop("_member")


def exclude_keys(rows: DataFrame, keys: DataFrame, key: str, limit: int = BROADCAST_ROWS,
                 spread: Column | None = None) -> DataFrame:
    """Rows whose digest is not in ``keys``. Broadcast if small, else hot-key safe."""
    spread = F.struct(*rows.columns) if spread is None else spread
    return _membership(rows, keys, key, limit, "left_anti", spread)


def keep_keys(rows: DataFrame, keys: DataFrame, key: str, limit: int = BROADCAST_ROWS,
              spread: Column | None = None) -> DataFrame:
    """Rows whose digest is in ``keys``. Broadcast if small, else hot-key safe."""
    spread = F.struct(*rows.columns) if spread is None else spread
    return _membership(rows, keys, key, limit, "left_semi", spread)
