"""Small-object log: one JSON object per file, compacted into one table."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cuelake.session import cut_lineage
from cuelake.sources.lines import CORRUPT, parse_json, sample_schema

# Fixed value: the object key layout <date>/<device>/<ts>-<uuid>.json.
KEY_LAYOUT = r"([^/]+)/([^/]+)/([^/-]+)-([^/]+)\.json$"
_PARTS = ["date", "device", "ts", "uuid"]
# What becomes of an object.
STATUSES = ["written", "skipped"]
# Bytes of objects that one file of a pull holds, about.
TARGET_BYTES = 128 << 20


def key_parts(path: Column) -> Column:
    """Struct(date, device, ts, uuid); NULL when the path has another layout."""
    part = [F.regexp_extract(path, KEY_LAYOUT, i + 1).alias(n) for i, n in enumerate(_PARTS)]
    return F.when(path.rlike(KEY_LAYOUT), F.struct(*part))


def _below(spark: SparkSession, kind: str, root: str, prefix: str, glob: str | None, **options: str) -> DataFrame | None:
    """The files whose key below ``root`` starts with ``prefix``; None where there is none.

    A prefix may end inside a segment: it becomes a glob there, so that only the matching
    folders are listed.
    """
    reader = spark.read.format(kind).options(recursiveFileLookup="true", **options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    where = root.rstrip("/")
    if prefix.strip("/"):
        where += "/" + re.sub(r"([\\*?\[\]{}])", r"\\\1", prefix.strip("/")) + ("" if prefix.endswith("/") else "*")
    try:
        return reader.load(where)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or where == root.rstrip("/"):
            raise
        return None


def read_objects(spark: SparkSession, root: str, prefix: str = "",
                 glob: str | None = "*.json") -> DataFrame:
    """One row per object whose key starts with ``prefix``: path, body."""
    files = _below(spark, "text", root, prefix, glob, wholetext="true")
    if files is None:
        return spark.createDataFrame([], "path string, body string")
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def compact(objects: DataFrame, label_field: str = "client_label") -> DataFrame:
    """Parse each body; ``status`` is ``written`` or ``skipped``.

    A body that is valid JSON but no object is skipped too. One object is one
    sample: its path is the key, so the file listing has already deduplicated it.
    """
    parsed = objects.withColumn("r", parse_json(F.col("body"), sample_schema(label_field)))
    is_object = F.json_object_keys("body").isNotNull()
    ok = is_object & F.col(f"r.{CORRUPT}").isNull()
    return parsed.select(
        "path", key_parts(F.col("path")).alias("k"), "body", "r",
        F.when(ok, "written").otherwise("skipped").alias("status"),
    ).select("path", "k.*", F.col("r.text").alias("text"),
             F.col(f"r.{label_field}").alias("client_label"), "body", "status")


def files_per_date(spark: SparkSession, root: str, prefix: str = "", glob: str | None = "*.json",
                   target_bytes: int = TARGET_BYTES) -> DataFrame:
    """date ('' where the key has none), files: how many files hold its objects. Lists, reads no object."""
    found = _below(spark, "binaryFile", root, prefix, glob)
    if found is None:
        return spark.createDataFrame([], "date string, files long")
    date = F.coalesce(key_parts(F.col("path"))["date"], F.lit(""))
    return found.groupBy(date.alias("date")).agg(
        F.greatest(F.ceil(F.sum("length") / target_bytes), F.lit(1)).alias("files"))


def pull(spark: SparkSession, root: str, out: str, prefix: str = "", label_field: str = "client_label",
         glob: str | None = "*.json", target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Full snapshot: overwrite ``out`` (Parquet by date), return counts by status.

    Objects are dealt by the hash of their key over as many files as their date's bytes
    ask for, so a date has at most one file more than bytes / target and no task more than
    a file or two. Written and skipped objects are counted by the write itself: each object
    is read and parsed once.
    """
    per_date = cut_lineage(files_per_date(spark, root, prefix, glob, target_bytes))
    files = per_date.agg(F.sum("files")).first()[0] or 1
    seen = Observation()
    table = compact(read_objects(spark, root, prefix, glob), label_field).observe(
        seen, *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES])
    rows = (table.filter("status = 'written'").drop("status", "body")
            .join(F.broadcast(per_date.withColumnRenamed("date", "_date")), F.coalesce("date", F.lit("")) == F.col("_date")))
    (rows.withColumn("_file", F.pmod(F.xxhash64("path"), F.col("files")))
     .repartition(int(files), "date", "_file").drop("_date", "files", "_file")
     .write.mode("overwrite").partitionBy("date").parquet(out))
    # Without an object the plan shrinks to nothing, and nothing is observed.
    counts = [(s, seen.get[s]) for s in STATUSES] if not per_date.isEmpty() else []
    return spark.createDataFrame([c for c in counts if c[1]], "status string, n long")


def pull_counts(table: DataFrame) -> DataFrame:
    return table.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
