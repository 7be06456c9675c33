"""Dataset manifests: md5 and size per file, checked against what is there."""

from __future__ import annotations

import hashlib
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHUNK = 8 << 20
# Files up to this size are hashed as one value by the file reader, larger ones in chunks.
WHOLE = 64 << 20
_PLACE = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


def _open(path: str):
    """A stream on a file named as Spark names it."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"))
    authority, _, name = rest.removeprefix("//").partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{authority}/")
    return store.open_input_stream(f"{base.rstrip('/')}/{name}")


def _digest_in_chunks(chunk: int):
    """Adds md5 to (path, at, size); a task holds one chunk of one file at a time."""
    def digest(at: str) -> str:
        running = hashlib.md5()
        with _open(at) as stream:
            while block := stream.read(chunk):
                running.update(block)
        return running.hexdigest()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            md5 = pa.array([digest(at) for at in batch.column("at").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("path"), md5, batch.column("size")], ["path", "md5", "size"])

    return run


def _relative(root: str) -> Column:
    base = re.sub(_PLACE, "", root)
    base = (base if base != root or base.startswith("/") else os.path.abspath(root)).rstrip("/")
    return F.substr(F.regexp_replace("path", _PLACE, ""), F.lit(len(base) + 2))


def build_manifest(spark: SparkSession, root: str, glob: str | None = None, whole: int = WHOLE, chunk: int = CHUNK) -> DataFrame:
    """path (relative to ``root``), md5, size for every file below ``root``, of any size.

    A file's digest is sequential, so files are spread over tasks and never parts of one.
    Empty files are not listed: Spark's readers pass over them.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files, name = reader.load(root), _relative(root).alias("path")
    small = files.filter(F.col("length") <= whole).select(name, F.md5("content").alias("md5"), F.col("length").alias("size"))
    large = files.filter(F.col("length") > whole).select(name, F.col("path").alias("at"), F.col("length").alias("size"))
    return small.unionByName(large.mapInArrow(_digest_in_chunks(chunk), "path string, md5 string, size long"))


def verify_manifest(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """path, status in ``ok``, ``changed``, ``missing``, ``extra``."""
    a = actual.select(F.col("path").alias("ap"), F.col("md5").alias("am"), F.col("size").alias("asz"))
    e = expected.select(F.col("path").alias("ep"), F.col("md5").alias("em"), F.col("size").alias("esz"))
    same = (F.col("am") == F.col("em")) & (F.col("asz") == F.col("esz"))
    status = (F.when(F.col("ap").isNull(), "missing").when(F.col("ep").isNull(), "extra")
              .when(same, "ok").otherwise("changed"))
    return a.join(e, F.col("ap") == F.col("ep"), "full_outer").select(
        F.coalesce("ap", "ep").alias("path"), status.alias("status"))
