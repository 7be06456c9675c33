"""Log ingest: decide every sample's fate, queue what needs a teacher, append the rest.

First come, first served per key, without ordering a key's rows: one aggregate per
key over log, pool and eval keys finds the first usable sequence number and the eval
flag, and each row is then judged against its key's result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from cuelake.functions import keys as K, labels as L, text as T
from cuelake.operators.skew import HOT_KEYS, HOT_ROWS, attach_per_key, spread_key
from cuelake.session import written
from cuelake.sources.keyed_store import append_keyed, known_keys, read_store

# The sample statuses.
STATUSES = ["client_label", "teacher_label", "dup", "leak", "empty", "bad"]
KEPT = ["client_label", "teacher_label"]
POOL_SEQ = -1


def keyed_samples(samples: DataFrame, labels: L.LabelSet = L.DEFAULT_LABELS) -> DataFrame:
    """Add ``key`` (digest of the redacted text) and what a sample is judged by."""
    stripped = T.strip(F.coalesce("text", F.lit("")))
    usable = ~L.has_label(F.col("client_label")) | L.is_valid(F.col("client_label"), labels)
    return (samples.withColumn("_stripped", stripped).withColumn("_empty", F.col("_stripped") == "")
            .withColumn("_usable", usable).withColumn("key", K.digest(K.key_redacted(F.col("_stripped")))).drop("_stripped"))


def keys_of(rows: DataFrame) -> DataFrame:
    """The ingest keys of rows with a ``text``."""
    return rows.select(K.digest(K.key_redacted(F.col("text"))).alias("key"))


def judge(keyed: DataFrame, pool_keys: DataFrame, eval_keys: DataFrame, hot_rows: int = HOT_ROWS,
          hot_keys: int = HOT_KEYS) -> DataFrame:
    """The status of keyed samples. They are read twice: cut them where redaction is to run once."""
    # Empty rows are judged without a key, so they spread instead of sharing one.
    rows = keyed.withColumn("_at", F.when(F.col("_empty"), spread_key(F.col("seq"), "binary")).otherwise(F.col("key")))

    def known(df, seq, is_eval):
        return df.select(F.col("key").alias("_at"), F.lit(seq).cast("long").alias("_seq"),
                         F.lit(is_eval).alias("_eval"), F.lit(0).alias("_w"))

    log = rows.filter("not _empty").select(
        "_at", F.when(F.col("_usable"), F.col("seq")).alias("_seq"),
        F.lit(False).alias("_eval"), F.lit(1).alias("_w"))
    claims = log.unionByName(known(pool_keys, POOL_SEQ, False)).unionByName(known(eval_keys, None, True))
    per_key = claims.groupBy("_at").agg(
        F.min("_seq").alias("_first"), F.max("_eval").alias("_leak"), F.sum("_w").alias("n"))

    judged = attach_per_key(rows, per_key, "_at", F.col("seq"), hot_rows=hot_rows, hot_keys=hot_keys)
    status = (F.when(F.col("_empty"), "empty")
              .when(F.col("_leak"), "leak")
              .when(F.col("seq") > F.col("_first"), "dup")
              .when(~F.col("_usable"), "bad")
              .when(L.has_label(F.col("client_label")), "client_label")
              .otherwise("teacher_label"))
    return judged.select(*[c for c in keyed.columns if c not in ("_empty", "_usable")], status.alias("status"))


def ingest_status(samples: DataFrame, pool: DataFrame, evals: DataFrame,
                  labels: L.LabelSet = L.DEFAULT_LABELS, hot_rows: int = HOT_ROWS,
                  hot_keys: int = HOT_KEYS) -> DataFrame:
    """Add ``key`` (digest) and ``status`` to samples (seq, text, client_label).

    Checked in this order: ``empty``, ``leak`` (key is in an eval set), ``dup`` (key is
    in the pool, or an earlier usable sample has it), ``bad`` (label outside the set; it
    does not claim the key), ``client_label``, ``teacher_label`` (no label in the log).
    """
    return judge(keyed_samples(samples, labels), keys_of(pool), keys_of(evals), hot_rows, hot_keys)


def status_counts(judged: DataFrame, statuses: list[str] = STATUSES) -> DataFrame:
    """Zero-filled counts per status: the whole result of a dry run."""
    spark = judged.sparkSession
    dim = spark.createDataFrame([(s,) for s in statuses], "status string")
    counts = judged.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(counts, "status", "left").select(
        "status", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def redacted(judged: DataFrame) -> DataFrame:
    return judged.withColumn("text", T.normalize_text(T.strip(F.coalesce("text", F.lit("")))))


def _queue(kept: DataFrame, teacher: DataFrame) -> DataFrame:
    waiting = kept.filter("status = 'teacher_label'")
    return waiting.join(teacher.select("key"), "key", "left_anti").select("key", "text")


def teacher_queue(judged: DataFrame, teacher: DataFrame) -> DataFrame:
    """Surviving keys without a teacher answer, as (key, text) with redacted text.

    Accepted rows are unique by key, so this join has no hot key.
    """
    return _queue(redacted(judged), teacher)


def _labelled(kept: DataFrame, teacher: DataFrame, labels: L.LabelSet) -> DataFrame:
    answers = teacher.select(F.col("key").alias("_k"), F.col("intent").alias("_teacher"))
    label = L.resolve_label(F.col("client_label"), F.col("_teacher"), labels)
    return (kept.filter(F.col("status").isin(KEPT)).join(answers, F.col("key") == F.col("_k"), "left")
            .select("seq", "text", label.alias("r"))
            .filter(F.col("r.intent").isNotNull())
            .select("seq", "text", "r.intent", "r.source"))


def accepted(judged: DataFrame, teacher: DataFrame,
             labels: L.LabelSet = L.DEFAULT_LABELS) -> DataFrame:
    """New training rows (seq, text, intent, source): redacted text, resolved label."""
    return _labelled(redacted(judged), teacher, labels)


@dataclass
class Ingest:
    judged: DataFrame
    counts: DataFrame
    new_rows: DataFrame
    queue: DataFrame


def ingest(samples: DataFrame, pool: DataFrame, evals: DataFrame, teacher: DataFrame,
           labels: L.LabelSet = L.DEFAULT_LABELS) -> Ingest:
    """The whole job, lazily. A dry run evaluates ``counts`` only, which prunes text."""
    judged = ingest_status(samples, pool, evals, labels)
    return Ingest(judged, status_counts(judged), accepted(judged, teacher, labels),
                  teacher_queue(judged, teacher))


def dry_run(samples: DataFrame, pool: DataFrame, evals: DataFrame,
            labels: L.LabelSet = L.DEFAULT_LABELS) -> DataFrame:
    """Counts per status; every text is redacted once, and only keys and flags are kept."""
    keyed = written(keyed_samples(samples, labels).drop("text"), "ingest-keys")
    return status_counts(judge(keyed, keys_of(pool), keys_of(evals)))


@dataclass
class IngestRun:
    counts: dict[str, int]
    new_rows: DataFrame
    queue: DataFrame
    appended: int


def run_ingest(samples: DataFrame, pool: DataFrame, evals: DataFrame, teacher: DataFrame, out: str | None = None,
               limit: int | None = None, labels: L.LabelSet = L.DEFAULT_LABELS) -> IngestRun:
    """The job, run: new rows appended to the keyed store ``out``, counts taken by the write.

    The log is evaluated once, into a table of keys and redacted texts. What survives is
    written once more, and that write counts every status as the rows pass. Rows that
    earlier runs stored in ``out`` count as pool rows; only the store's partitions of this
    log's keys are read for them. ``limit`` takes the first samples only. ``queue`` and
    ``new_rows`` read the survivors' table.
    """
    spark = samples.sparkSession
    if limit is not None:
        samples = samples.orderBy("seq").limit(limit)
    keyed = written(redacted(keyed_samples(samples, labels)), "ingest-log")
    pool_keys = keys_of(pool)
    store = read_store(spark, out) if out else None
    if store is not None:
        pool_keys = pool_keys.unionByName(known_keys(store, keyed.filter("not _empty").select("key")))
    seen = Observation()
    judged = judge(keyed, pool_keys, keys_of(evals)).observe(
        seen, *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES])
    kept = written(judged.filter(F.col("status").isin(KEPT)), "ingest-kept")
    # An empty log's plan shrinks to nothing, and nothing is observed.
    counts = dict.fromkeys(STATUSES, 0) if keyed.isEmpty() else {s: seen.get[s] for s in STATUSES}
    new_rows = _labelled(kept, teacher, labels)
    return IngestRun(counts, new_rows, _queue(kept, teacher), append_keyed(new_rows, out) if out else 0)
