"""Line and JSONL scans with source lineage.

Line numbers do not need a whole file in one task. The text source reports the
split (file, block start) a line came from, and rows of one split are read in
order by one task, so a line's number is (lines in earlier splits) + (position in
its split). Only one row per split is ever ordered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from cuelake.functions import labels as L, text as T

EXAMPLE_SCHEMA = "text string, intent string"
CORRUPT = "_corrupt"


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Lines with ``_src`` (file path). Not recursive; no line numbers."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_src"),
        F.col("_metadata.file_block_start").alias("_block"))


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``_line`` (1-based, per file) and ``seq`` (0-based, over sorted files)."""
    tagged = lines.withColumn("_pos", F.monotonically_increasing_id())
    splits = tagged.groupBy("_src", "_block").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_src", "_block").rowsBetween(W.unboundedPreceding, -1)
    in_file = W.partitionBy("_src").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = splits.select(
        F.col("_src").alias("_s"), F.col("_block").alias("_b"), "_first",
        F.coalesce(F.sum("_n").over(in_file), F.lit(0)).alias("_file_start"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_all_start"))
    joined = tagged.join(starts, (F.col("_src") == F.col("_s")) & (F.col("_block") == F.col("_b")))
    at = F.col("_pos") - F.col("_first")
    return joined.select("line", "_src",
                         (F.col("_file_start") + at + 1).alias("_line"),
                         (F.col("_all_start") + at).alias("seq"))


def parse_json(line: Column, schema: str) -> Column:
    """Parse a JSON object; a line that is not one gets its text in ``_corrupt``."""
    return F.from_json(line, f"{schema}, {CORRUPT} string",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    rows = lines.filter(~T.is_blank(F.col("line")))
    kept = [c for c in rows.columns if c not in ("line", "_block")]
    is_object = F.coalesce(F.json_object_keys("line").isNotNull(), F.lit(False))
    return rows.select(*kept, "line", parse_json(F.col("line"), schema).alias("r"),
                       is_object.alias("_object"))


@dataclass
class LabeledScan:
    examples: DataFrame     # text, intent, _src (, _line, seq)
    violations: DataFrame   # _src (, _line, seq), line, reason


def scan_labeled(spark: SparkSession, path: str | list[str],
                 labels: L.LabelSet = L.DEFAULT_LABELS, glob: str | None = None,
                 numbered: bool = True, exact_keys: bool = False) -> LabeledScan:
    """Labeled JSONL, split into valid examples and violations.

    Reasons: ``bad_json``, ``missing_key``, ``unknown_intent`` and, with
    ``exact_keys``, ``extra_key``. Blank lines are skipped but counted.
    """
    lines = read_lines(spark, path, glob)
    rows = _parsed(number_lines(lines) if numbered else lines, EXAMPLE_SCHEMA)
    reason = (F.when(~F.col("_object") | F.col(f"r.{CORRUPT}").isNotNull(), "bad_json")
              .when(F.col("r.text").isNull() | F.col("r.intent").isNull(), "missing_key")
              .when(~L.is_valid(F.col("r.intent"), labels), "unknown_intent"))
    if exact_keys:
        reason = F.coalesce(reason, F.when(
            ~L.has_exact_keys(F.col("line"), ["text", "intent"]), "extra_key"))
    rows = rows.withColumn("reason", reason)
    where = ["_src", "_line", "seq"] if numbered else ["_src"]
    return LabeledScan(
        rows.filter("reason is null").select("r.text", "r.intent", *where),
        rows.filter("reason is not null").select(*where, "line", "reason"))


def load_labeled(spark: SparkSession, path: str | list[str],
                 labels: L.LabelSet = L.DEFAULT_LABELS, glob: str | None = None) -> DataFrame:
    """Strict scan: the job fails when it meets a bad line, naming file and line."""
    lines = _parsed(number_lines(read_lines(spark, path, glob)), EXAMPLE_SCHEMA)
    bad = (~F.col("_object") | F.col(f"r.{CORRUPT}").isNotNull() | F.col("r.text").isNull()
           | ~L.is_valid(F.col("r.intent"), labels))
    where = F.concat(F.col("_src"), F.lit(":"), F.col("_line").cast("string"),
                     F.lit(": not a labeled example: "), F.col("line"))
    # The check is a filter: column pruning cannot drop it, whatever the caller selects.
    checked = lines.filter(F.when(bad, F.raise_error(where).cast("boolean")).otherwise(F.lit(True)))
    return checked.select("r.text", "r.intent", "_src", "_line", "seq")


def load_labeled_dir(spark: SparkSession, directory: str,
                     labels: L.LabelSet = L.DEFAULT_LABELS) -> DataFrame:
    """Union of the directory's own ``*.jsonl`` files; order by ``seq``."""
    return load_labeled(spark, directory, labels, glob="*.jsonl")


def sample_schema(label_field: str = "client_label") -> str:
    return f"text string, {label_field} string"


def scan_samples(spark: SparkSession, path: str | list[str], label_field: str = "client_label",
                 limit: int = 0) -> tuple[DataFrame, DataFrame]:
    """Lenient log scan -> (samples, rejects). Bad lines are set aside, not fatal.

    ``limit`` keeps the first n samples; 0 keeps all.
    """
    rows = _parsed(number_lines(read_lines(spark, path)), sample_schema(label_field))
    ok = F.col("_object") & F.col(f"r.{CORRUPT}").isNull()
    samples = rows.filter(ok).select("seq", "_src", "_line", "r.text",
                                     F.col(f"r.{label_field}").alias("client_label"))
    if limit:
        samples = samples.orderBy("seq").limit(limit)
    return samples, rows.filter(~ok).select("seq", "_src", "_line", "line")


def line_list(lines: DataFrame, col: str = "line") -> DataFrame:
    """Stripped lines without blanks and ``#`` comments."""
    stripped = T.strip(F.col(col))
    return lines.withColumn(col, stripped).filter((F.col(col) != "") & ~F.col(col).startswith("#"))


def read_line_list(spark: SparkSession, path: str) -> DataFrame:
    return line_list(spark.read.text(path).toDF("line"))
