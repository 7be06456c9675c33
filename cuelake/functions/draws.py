"""Deterministic draws: md5 of (seed, row, salt) read as uniforms.

The same row gets the same draws under any partitioning, retry or engine. One
md5 holds four 32-bit uniforms, so a row needing twelve draws hashes three times.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SLOTS = 4


def draw_hash(seed: int | str, row: Column, *salt: Column | str | int) -> Column:
    parts = [F.lit(str(seed)), row.cast("string")]
    parts += [s.cast("string") if isinstance(s, Column) else F.lit(str(s)) for s in salt]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def uniform(hash_hex: Column, slot: int | Column = 0) -> Column:
    """Uniform in [0, 1) from one 8-digit slot of a draw hash."""
    start = slot * F.lit(8) + F.lit(1) if isinstance(slot, Column) else F.lit(8 * slot + 1)
    return F.conv(F.substr(hash_hex, start, F.lit(8)), 16, 10).cast("double") / F.lit(4294967296.0)


def pick_index(u: Column, size: Column | int) -> Column:
    """0-based index below ``size``."""
    size = size if isinstance(size, Column) else F.lit(size)
    return F.floor(u * size).cast("int")


def pick(u: Column, options: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), pick_index(u, len(options)) + 1)
