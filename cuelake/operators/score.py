"""Batch scoring of an embeddings table with a linear head, and retrieval by centroid."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cuelake.functions import labels as L, vectors as V
from cuelake.functions.draws import draw_hash, pick_index, uniform

# A head has one row per class; a label space beyond this is not a routing head.
MAX_CLASSES = 10_000


def _few_classes(rows: DataFrame) -> DataFrame:
    """The rows, at most one beyond the class limit and only with an error: nothing larger is ever packed."""
    counted = rows.limit(MAX_CLASSES + 1).withColumn("_k", F.row_number().over(W.orderBy(F.lit(0))))
    return counted.filter(F.when(F.col("_k") <= MAX_CLASSES, True).otherwise(
        F.raise_error(F.lit(f"more than {MAX_CLASSES} classes")))).drop("_k")


def pack_head(head: DataFrame) -> DataFrame:
    """The head table as one row: ``head`` (array of structs by idx) and ``temperature``."""
    cls = F.struct("idx", "label", "coef", "intercept")
    return _few_classes(head).agg(F.array_sort(F.collect_list(cls)).alias("head"),
                                  F.coalesce(F.max("temperature"), F.lit(1.0)).alias("temperature"))


def with_logits(emb: DataFrame, head: DataFrame, vec: str = "embedding",
                normalize: bool = False) -> DataFrame:
    """Add ``logits``, ``class_labels`` and ``temperature``. The one-row head is broadcast."""
    v = V.as_double(F.col(vec))
    rows = emb.withColumn("_v", V.l2_normalize(v) if normalize else v)
    return (rows.join(F.broadcast(pack_head(head)))
            .withColumn("logits", V.logits(F.col("_v"), F.col("head")))
            .withColumn("class_labels", F.transform("head", lambda h: h["label"]))
            .drop("_v", "head"))


def predict(scored: DataFrame, temperature: Column | float | None = None,
            decimals: int | None = None) -> DataFrame:
    """From ``logits``: ``probs``, ``pred``, ``conf`` (temperature-scaled max softmax).

    ``decimals`` rounds conf, so bin edges compare equally whatever summed the logits.
    """
    t = F.col("temperature") if temperature is None else temperature
    probs = scored.withColumn("probs", V.softmax(V.scale(F.col("logits"), t)))
    conf = F.array_max("probs")
    return (probs.withColumn("pred", F.get("class_labels", V.argmax(F.col("probs"))))
            .withColumn("conf", conf if decimals is None else F.round(conf, decimals)))


def route(predictions: DataFrame, gate: float = L.GATE, reject: str = L.REJECT_INTENT) -> DataFrame:
    """Add ``distribution`` and ``action``; ``intent`` and ``confidence`` as served."""
    return (predictions
            .withColumn("distribution", V.distribution(F.col("probs"), F.col("class_labels")))
            .withColumn("action", L.gate_action(F.col("conf"), F.col("pred"), gate, reject))
            .withColumnsRenamed({"pred": "intent", "conf": "confidence"}))


def label_centroids(emb: DataFrame, label: str, vec: str = "embedding") -> DataFrame:
    """Mean vector per label: (label, coef), summed map-side without exploding vectors."""
    means = emb.groupBy(label).agg(
        Summarizer.mean(array_to_vector(V.as_double(F.col(vec)))).alias("m"))
    return means.select(label, vector_to_array("m").alias("coef"))


def centroid_head(emb: DataFrame, label: str, vec: str = "embedding", gain: float = 1.0,
                  temperature: float = 1.0, decimals: int | None = None) -> DataFrame:
    """A head from label centroids: coef = gain * centroid, intercept = -gain*|centroid|^2/2.

    Classes are indexed in label order.
    """
    cents = label_centroids(emb, label, vec)
    coef = F.transform("coef", lambda x: x * gain)
    if decimals is not None:
        coef = F.transform(coef, lambda x: F.round(x, decimals))
    half = V.dot(F.col("coef"), F.col("coef")) * (-gain / 2)
    if decimals is not None:
        half = F.round(half, decimals)
    dense = cents.select(F.col(label).cast("string").alias("label"), coef.alias("coef"),
                         half.alias("intercept"), F.lit(float(temperature)).alias("temperature"))
    packed = dense.agg(F.array_sort(F.collect_list(F.struct("label", "coef", "intercept", "temperature"))).alias("h"))
    return packed.select(F.posexplode("h").alias("idx", "c")).select(
        "idx", "c.label", "c.coef", "c.intercept", "c.temperature")


def quantize_head(head: DataFrame, decimals: int) -> DataFrame:
    """The head with rounded weights, the low-precision side of a parity check."""
    return (head.withColumn("coef", F.transform("coef", lambda x: F.round(x, decimals)))
            .withColumn("intercept", F.round("intercept", decimals)))


def nearest_label(emb: DataFrame, label: str, vec: str = "embedding") -> DataFrame:
    """Add ``nearest`` and ``similarity``: cosine against every label centroid."""
    cents = label_centroids(emb, label, vec).withColumn("label", F.col(label).cast("string"))
    unit = cents.select("label", V.l2_normalize(F.col("coef")).alias("coef"))
    packed = _few_classes(unit).agg(F.array_sort(F.collect_list(F.struct("label", "coef"))).alias("cents"))
    rows = emb.withColumn("_v", V.l2_normalize(V.as_double(F.col(vec)))).join(F.broadcast(packed))
    rows = rows.withColumn("_s", F.transform("cents", lambda c: V.dot(F.col("_v"), c["coef"])))
    return (rows.withColumn("nearest", F.get(F.transform("cents", lambda c: c["label"]), V.argmax(F.col("_s"))))
            .withColumn("similarity", F.array_max("_s")).drop("_v", "_s", "cents"))


def cosine_spread(emb: DataFrame, id_col: str, vec: str = "embedding", seed: int = 0,
                  bucket_rows: int = 4096) -> DataFrame:
    """Collapse diagnostic: n, min, avg, max, stddev of cosine over a sample of pairs.

    Each row is paired with the next one in its hash bucket, so there are about as many
    pairs as rows and never all pairs of a group.
    """
    size = emb.agg(F.ceil(F.count(F.lit(1)) / bucket_rows).alias("_buckets"))
    dealt = (emb.select(id_col, V.l2_normalize(V.as_double(F.col(vec))).alias("_v"))
             .join(F.broadcast(size)).withColumn("_h", draw_hash(seed, F.col(id_col), "pair"))
             .withColumn("_bucket", pick_index(uniform(F.col("_h"), 0), F.col("_buckets"))))
    nxt = F.lead("_v").over(W.partitionBy("_bucket").orderBy("_h", id_col))
    pairs = dealt.withColumn("_w", nxt).filter("_w is not null").select(
        V.dot(F.col("_v"), F.col("_w")).alias("cos"))
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), F.min("cos").alias("min_cos"),
                     F.avg("cos").alias("avg_cos"), F.max("cos").alias("max_cos"),
                     F.stddev_pop("cos").alias("sd_cos"))


def _gram_sums(batches):
    """Of a task's unit vectors: the sum of v v^T (a row per dimension), of v, and of |v|^2 and |v|^4."""
    import numpy as np
    import pyarrow as pa

    gram, total, n, square, fourth = None, None, 0, 0.0, 0.0
    for batch in batches:
        col = batch.column(0)
        if not len(col):
            continue
        wide = col.flatten().to_numpy(zero_copy_only=False)
        dims = len(wide) // len(col)
        if not dims or not np.all(np.diff(col.offsets.to_numpy()) == (dims if gram is None else len(gram))):
            raise ValueError("vectors of different lengths")
        v = wide.reshape(len(col), dims)
        v = v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-12)
        q = (v * v).sum(1)
        if gram is None:
            gram, total = np.zeros((dims, dims)), np.zeros(dims)
        gram += v.T @ v
        total += v.sum(0)
        n, square, fourth = n + len(v), square + q.sum(), fourth + (q * q).sum()
    for i in range(0 if gram is None else len(gram)):
        first = i == 0
        yield pa.RecordBatch.from_pydict({
            "i": pa.array([i], pa.int32()), "row": pa.array([gram[i]], pa.list_(pa.float64())),
            "total": pa.array([total[i]]), "n": pa.array([n if first else 0], pa.int64()),
            "square": pa.array([square if first else 0.0]), "fourth": pa.array([fourth if first else 0.0])})


def cosine_moments(emb: DataFrame, vec: str = "embedding") -> DataFrame:
    """Collapse diagnostic over all pairs of rows: n, pairs, avg_cos, sd_cos, exactly and in one pass.

    The cosines of all ordered pairs sum to |sum v|^2 and their squares to the squared norm
    of sum v v^T, less each row with itself. A task sends dimensions^2 numbers, whatever its
    rows. Null vectors are left out, a zero vector has cosine 0 with all, vectors of
    different lengths fail; without two rows both figures are null. Extremes are
    ``cosine_spread``'s, over its sample of pairs.
    """
    rows = emb.select(V.as_double(F.col(vec)).alias("v")).filter("v IS NOT NULL")
    sums = rows.mapInArrow(_gram_sums, "i int, row array<double>, total double, n long, square double, fourth double")
    whole = sums.groupBy("i").agg(
        Summarizer.sum(array_to_vector("row")).alias("row"),
        *[F.sum(c).alias(c) for c in ("total", "n", "square", "fourth")]).withColumn("row", vector_to_array("row"))
    one = whole.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), (F.sum(F.col("total") * F.col("total")) - F.sum("square")).alias("_sum"),
                    (F.sum(V.dot(F.col("row"), F.col("row"))) - F.sum("fourth")).alias("_squares"))
    ordered = F.col("n").cast("double") * (F.col("n") - 1)
    mean = F.try_divide("_sum", ordered)
    var = F.try_divide("_squares", ordered) - mean * mean
    return one.select("n", F.expr("n * CAST(n - 1 AS DECIMAL(19, 0)) / 2").cast("decimal(38,0)").alias("pairs"),
                      mean.alias("avg_cos"), F.when(var.isNotNull(), F.sqrt(F.greatest(var, F.lit(0.0)))).alias("sd_cos"))


def class_cohesion(emb: DataFrame, label: str, vec: str = "embedding") -> DataFrame:
    """Per label: n, mean cosine of all its pairs of rows (within_cos) and of its rows with all others (between_cos).

    From one vector sum per label. Null where there is no such pair; null vectors are left out.
    """
    unit = V.l2_normalize(V.as_double(F.col(vec)))
    rows = emb.filter(F.col(vec).isNotNull()).select(label, unit.alias("_v")).withColumn("_q", V.dot(F.col("_v"), F.col("_v")))
    per = _few_classes(rows.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_q").alias("_q"), Summarizer.sum(array_to_vector("_v")).alias("_s")))
    whole = per.agg(F.sum("n").alias("_n"), Summarizer.sum(F.col("_s")).alias("_all"))
    s, total = vector_to_array("_s"), vector_to_array("_all")
    both = per.join(F.broadcast(whole)).withColumns({"_s": s, "_all": total})
    own, n, rest = V.dot(F.col("_s"), F.col("_s")), F.col("n").cast("double"), F.col("_n") - F.col("n")
    return both.select(label, "n", F.try_divide(own - F.col("_q"), n * (n - 1)).alias("within_cos"),
                       F.try_divide(V.dot(F.col("_s"), F.col("_all")) - own, n * rest).alias("between_cos"))
