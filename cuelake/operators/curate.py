"""Dataset health: counts, duplicates, train/eval overlap, containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cuelake.functions import keys as K, labels as L
from cuelake.operators.skew import BROADCAST_ROWS, attach_per_key, exclude_keys, keep_keys, small_enough
from cuelake.session import cut_lineage, written

TARGET_PER_INTENT = 30


def intent_counts(examples: DataFrame, labels: L.LabelSet = L.DEFAULT_LABELS) -> DataFrame:
    """Rows per intent over the whole label set, zeros included."""
    counts = examples.groupBy("intent").agg(F.count(F.lit(1)).alias("n"))
    dim = labels.dim(examples.sparkSession).select("intent", "ord")
    return dim.join(counts, "intent", "left").select(
        "intent", "ord", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def shortfall(examples: DataFrame, target: int = TARGET_PER_INTENT,
              labels: L.LabelSet = L.DEFAULT_LABELS) -> DataFrame:
    """Intents below ``target`` and how many rows they lack."""
    return (intent_counts(examples, labels).filter(F.col("n") < target)
            .select("intent", (F.lit(target) - F.col("n")).cast("long").alias("needed")))


def label_violations(rows: DataFrame, labels: L.LabelSet = L.DEFAULT_LABELS) -> DataFrame:
    return rows.filter(~L.is_valid(F.col("intent"), labels))


def with_key(df: DataFrame, key: Column, name: str = "_key") -> DataFrame:
    return df.withColumn(name, K.digest(key))


def leaked_evals(evals: DataFrame, train: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Eval rows whose leak key occurs in train.

    The eval digests are the small side: the pool is reduced to the digests it shares
    with them before anything is joined back, so the pool is never broadcast.
    """
    keyed = with_key(evals, K.key_leak(F.col("text")))
    pool_keys = with_key(train, K.key_leak(F.col("text"))).select("_key")
    shared = keep_keys(pool_keys, keyed, "_key", limit, spread=F.col("_key")).distinct()
    return keyed.join(shared, "_key", "left_semi").drop("_key")


def without_keys_of(rows: DataFrame, blocked: DataFrame, key=K.key_leak,
                    limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key (one of the key functions, over ``text``) is not blocked."""
    keyed = with_key(rows, key(F.col("text")))
    block = with_key(blocked, key(F.col("text"))).select("_key")
    return exclude_keys(keyed, block, "_key", limit).drop("_key")


def shared_keys(a: DataFrame, b: DataFrame, key=K.key_leak) -> DataFrame:
    """Keys both sets contain (must be empty for a clean split)."""
    def keyed(df):
        return df.select(key(F.col("text")).alias("key")).withColumn("_d", K.digest(F.col("key")))

    both = keyed(a).select("_d").intersect(keyed(b).select("_d"))
    texts = keyed(a).groupBy("_d").agg(F.any_value("key").alias("key"))
    return texts.join(both, "_d", "left_semi").select("key")


def duplicate_texts(examples: DataFrame) -> DataFrame:
    """Texts occurring more than once: text, copies beyond the first."""
    grouped = examples.groupBy(K.digest(F.col("text")).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.min("text").alias("text"))
    return grouped.filter("n > 1").select("text", (F.col("n") - 1).alias("extra"))


def top_duplicates(examples: DataFrame, k: int = 20) -> DataFrame:
    return duplicate_texts(examples).orderBy(F.desc("extra"), "text").limit(k)


def dataset_health(train: DataFrame, evals: DataFrame, raw_lines: DataFrame | None = None,
                   labels: L.LabelSet = L.DEFAULT_LABELS, target: int = TARGET_PER_INTENT) -> DataFrame:
    """All checks as one long table (check, key, value).

    Each table is read once, into a narrow one of intents and digests that every check
    reads; texts are never moved. Raw lines are counted in their own single pass.
    """
    def narrow(df, is_eval):
        text = F.col("text")
        return df.select(F.lit(is_eval).alias("is_eval"), "intent", L.is_valid(F.col("intent"), labels).alias("valid"),
                         K.digest(text).alias("exact"), K.digest(K.key_leak(text)).alias("leak"))

    def long(df, check, key, value):
        return df.select(F.lit(check).alias("check"), key.alias("key"), value.cast("long").alias("value"))

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0))

    rows = written(narrow(train, False).unionByName(narrow(evals, True)), "health")
    in_train, in_eval, none = rows.filter("NOT is_eval"), rows.filter("is_eval"), F.lit("")
    per_leak = rows.groupBy("leak").agg(F.count_if("is_eval").alias("e"), F.count_if(~F.col("is_eval")).alias("t"))
    shared = per_leak.filter("leak IS NOT NULL AND e > 0 AND t > 0").agg(total(F.col("e")).alias("rows"), F.count(F.lit(1)).alias("keys"))
    copies = in_train.groupBy("exact").agg(F.count(F.lit(1)).alias("n")).agg(total(F.col("n") - 1).alias("v"))
    bad = in_train.agg(F.count_if(~F.coalesce("valid", F.lit(False))).alias("v"))
    parts = [
        long(intent_counts(in_train, labels), "train_count", F.col("intent"), F.col("n")),
        long(intent_counts(in_eval, labels), "eval_count", F.col("intent"), F.col("n")),
        long(shortfall(in_eval, target, labels), "eval_needed", F.col("intent"), F.col("needed")),
        shared.select(F.explode(F.array(
            F.struct(F.lit("leaked_evals").alias("check"), none.alias("key"), F.col("rows").alias("value")),
            F.struct(F.lit("shared_keys").alias("check"), none.alias("key"), F.col("keys").alias("value")))).alias("r")).select("r.*"),
        long(copies, "duplicate_rows", none, F.col("v")),
        long(bad, "bad_labels", none, F.col("v")),
    ]
    if raw_lines is not None:
        odd = ~L.has_exact_keys(F.col("line"), ["text", "intent"])
        parts.append(long(raw_lines.agg(F.count_if(odd).alias("v")), "odd_key_set", none, F.col("v")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- containment -------------------------------------------------------------

def spaced_tokens(text: Column) -> Column:
    """Lowercased word runs separated and surrounded by one blank."""
    body = F.trim(F.regexp_replace(F.lower(text), F.lit(r"[^\p{L}\p{N}]+"), F.lit(" ")))
    return F.concat(F.lit(" "), body, F.lit(" "))


def _word_hashes(df: DataFrame, id_col: str) -> DataFrame:
    """(id, _t): the hash of every word, in order. Text that starts or ends between words has
    one empty word there."""
    return df.select(id_col, F.transform(F.split(F.lower(F.col("text")), r"[^\p{L}\p{N}]+"), lambda x: F.xxhash64(x)).alias("_t"))


def _shingles(rows: DataFrame, id_col: str, widths: list[int], own: Column | None = None) -> DataFrame:
    """(id, h): the hash of every run of w words, for every width w, in one pass.

    Positions are exploded, not words, and a run is hashed from the word hashes where they
    lie, so nothing is copied per position. With ``own`` a row has runs of that width only.
    """
    last = F.size("_t") - (F.lit(widths[0]) if own is None else own)
    # No filter on the size: it would compute the words a second time.
    at = rows.select("*", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("_i"))

    def run(w):
        return F.xxhash64(F.lit(w), *[F.get("_t", F.col("_i") + k) for k in range(w)])

    def fits(w):
        return F.col("_i") + w <= F.size("_t") if own is None else own == w

    if len(widths) == 1:
        return at.select(id_col, run(widths[0]).alias("h"))
    runs = F.array(*[F.when(fits(w), run(w)) for w in widths])
    return at.select(id_col, F.explode(runs).alias("h")).filter("h IS NOT NULL")


def contained_passages(docs: DataFrame, passages: DataFrame, doc_id: str, item_id: str,
                       width: int = 8, limit: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, item_id) where the document's words contain the passage's in a row.

    Every occurrence includes every shingle of the passage, so each passage is looked
    up by one shingle only: its rarest. One pass over the documents keeps the shingles
    that some passage has, as a narrow table; counts, anchors and candidates come from
    that table, and a second pass verifies the candidates on the texts. A document's text
    is keyed by its own id only, so a passage that many documents hold gathers no texts.
    Passages shorter than ``width`` use their own length as shingle width. Passages
    without a word are in no document.
    """
    empty = F.xxhash64(F.lit(""))
    items = (_word_hashes(passages, item_id).withColumn("_t", F.array_remove("_t", empty)).filter(F.size("_t") > 0)
             .withColumn("_w", F.least(F.size("_t"), F.lit(width))))
    widths = sorted(r[0] for r in items.select("_w").distinct().collect())  # at most ``width`` values
    if not widths:
        return docs.select(doc_id).join(passages.select(item_id).limit(0))
    item_sh = cut_lineage(_shingles(items, item_id, widths, F.col("_w")))
    wanted = item_sh.select("h").distinct()
    runs = _shingles(_word_hashes(docs, doc_id), doc_id, widths)
    if small_enough(wanted, limit):
        known = runs.join(F.broadcast(wanted), "h", "left_semi").distinct()
    else:  # a run that a document repeats is one row before the shuffle; AQE splits runs of many documents
        known = runs.distinct().join(wanted, "h", "left_semi")
    seen = written(known, "shingles")
    per_run = seen.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    anchors = cut_lineage(
        item_sh.join(per_run, "h", "left").groupBy(item_id)
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h")).alias("a"))
        .filter("a.df > 0").select(item_id, "a.h", "a.df"))
    # Documents per anchor are few or, for a hot passage, many rows of two numbers.
    few = F.broadcast(anchors.drop("df")) if small_enough(anchors, limit) else anchors.drop("df")
    pairs = cut_lineage(seen.join(few, "h").select(doc_id, item_id).distinct())

    key = K.digest(F.col(item_id).cast("string"))
    bodies = passages.select(key.alias("_key"), spaced_tokens(F.col("text")).alias("_item"), item_id)
    per_item = bodies.join(pairs.groupBy(item_id).agg(F.count(F.lit(1)).alias("n")), item_id).drop(item_id)
    asked = attach_per_key(pairs.withColumn("_key", key), per_item, "_key", F.col(doc_id)).drop("_key")
    ids = pairs.select(doc_id).distinct()
    held = docs.join(F.broadcast(ids), doc_id, "left_semi") if small_enough(ids, limit) else docs
    return (held.select(doc_id, spaced_tokens(F.col("text")).alias("_doc")).join(asked, doc_id)
            .filter(F.contains("_doc", "_item")).select(doc_id, item_id))
