"""Helpers shared by the operators: words, scratch tables, digests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cuelake.functions.vectors import let  # noqa: F401  (operators import it from here)
from cuelake.session import scratch_path

# The characters that separate words, and one word.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
# Bytes of text a task works on at once; a longer text is worked on alone.
CHUNK_BYTES = 4_000_000


def text_of(text: Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """All words of the whole text in order."""
    return F.array_remove(F.split(text_of(text), SPACE), "")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the cluster's shared folder and read back.

    A written table survives lost executors and, unlike a checkpoint, lets later
    readers prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most CHUNK_BYTES in one column, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, start = np.concatenate([[0], np.cumsum(sizes)]), 0
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(upto, upto[start] + CHUNK_BYTES, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def fresh(columns: list[str], name: str) -> str:
    """``name``, or the first of ``_name``, ``__name``, ... that no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def row_key(docs: DataFrame) -> Column:
    """128 bits of all columns: equal rows have equal keys, whatever their ids."""
    cols = [docs[c] for c in docs.columns]
    return F.struct(F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit(1), *cols).alias("k2"))
