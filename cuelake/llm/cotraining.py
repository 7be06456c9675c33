"""Document quality by co-training two views.

The content view is a logistic regression on hashed words and character shares of the
whole text; the metadata view is one on source, language and length only. In every
round each view labels every unlabelled document, and all that one is sure of are added
to the other's training rows, however many; together they weigh at most PSEUDO_SHARE of
their class's labelled rows. At the end both views are calibrated, and combined, on
labelled rows neither has seen, and every document is scored.

Only labelled rows are a bounded sample (``max_labelled``), by hash order within each
class and weighted by the class's true size. Features of the unlabelled documents are
written once; a round labels them in the scan of that table, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher, HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from cuelake.llm.common import let, stored, text_of, words

MAX_LABELLED = 8_000
ROUNDS = 2
# A view is sure of an unlabelled row beyond these probabilities of its calibrated score.
SURE_BAD, SURE_GOOD = 0.05, 0.98
# Weight of such a row, and of all such rows of a class as a share of its labelled ones.
PSEUDO_WEIGHT, PSEUDO_SHARE = 0.5, 0.5
# Ids that may be broadcast (8 bytes each).
SMALL_IDS = 1_000_000
WORD_BUCKETS = 1 << 12
META_BUCKETS = 1 << 10
SAMPLE_FILES = 6
ACCEPT = 0.5
TEXT_FEATURES = ["symbols", "upper", "digits", "marks", "distinct", "word_len", "repeats", "log_words"]


@dataclass
class CoTrained:
    features: PipelineModel
    content: LogisticRegressionModel
    metadata: LogisticRegressionModel
    weights: tuple[float, float, float]  # of the two log odds, and the intercept


def _text_features(text: Column) -> Column:
    """Shares of the whole text, all between 0 and about 1."""
    t = text_of(text)

    def of(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1))
        chars = F.greatest(F.length(t), F.lit(1))
        upper = F.regexp_count(t, F.lit(r"\p{Lu}")) / chars
        next_same = F.size(F.filter(F.zip_with(w, F.slice(w, 2, n), lambda a, b: a == b), lambda x: x))
        return F.struct((F.regexp_count(t, F.lit(r"[#*$%&|<>]")) / n).alias("symbols"), upper.alias("upper"),
                        (F.regexp_count(t, F.lit(r"[0-9]")) / chars).alias("digits"),
                        (F.regexp_count(t, F.lit(r"!!|\?\?")) / n).alias("marks"),
                        (F.size(F.array_distinct(w)) / n).alias("distinct"),
                        F.least(F.lit(1.0), chars / n / 20).alias("word_len"), (next_same / n).alias("repeats"),
                        (F.log1p(n) / 12).alias("log_words"))
    return let(words(text), of)


def _featured(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, chars_col: str, *more: Column) -> DataFrame:
    base = docs.select(
        docs[id_col].alias("doc_id"), words(F.lower(docs[text_col])).alias("words"), _text_features(docs[text_col]).alias("t"),
        F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("source"),
        F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang"),
        (F.log1p(F.coalesce(docs[chars_col].cast("double"), F.lit(0.0))) / 12).alias("log_chars"), *more)
    return base.select("*", "t.*").drop("t")


def _feature_stages() -> Pipeline:
    return Pipeline(stages=[
        HashingTF(inputCol="words", outputCol="counts", numFeatures=WORD_BUCKETS),
        Normalizer(inputCol="counts", outputCol="tf"),
        VectorAssembler(inputCols=["tf", *TEXT_FEATURES], outputCol="content", handleInvalid="keep"),
        FeatureHasher(inputCols=["source", "lang", "log_chars"], outputCol="metadata", numFeatures=META_BUCKETS)])


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    return LogisticRegression(featuresCol=view, labelCol="y", weightCol="weight", predictionCol="_p", maxIter=25, regParam=1e-3,
                              rawPredictionCol=f"{view}_raw", probabilityCol=f"{view}_prob").fit(rows)


def _log_odds(rows: DataFrame, model: LogisticRegressionModel, view: str) -> DataFrame:
    return model.transform(rows).withColumn(f"{view}_odds", vector_to_array(f"{view}_raw")[1]).drop(
        "_p", f"{view}_raw", f"{view}_prob")


def _logit(rows: DataFrame, inputs: list[str]) -> tuple[list[float], float]:
    """Platt scaling: logistic regression on log odds."""
    at = VectorAssembler(inputCols=inputs, outputCol="_x").transform(rows)
    model = LogisticRegression(featuresCol="_x", labelCol="y", weightCol="weight", maxIter=25, regParam=1e-3).fit(at)
    return [float(c) for c in model.coefficients], float(model.intercept)


def _sample(known: DataFrame, max_labelled: int) -> DataFrame:
    """At most ``max_labelled`` of the labelled ids (doc_id, y), by hash order within each
    class; a class takes half of them, and what the other leaves. ``weight`` restores the
    classes' sizes."""
    order = F.xxhash64("doc_id", F.lit(6))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    half = max_labelled // 2
    take = {y: min(n, max(half, max_labelled - sum(sizes[z] for z in sizes if z != y))) for y, n in sizes.items()}
    scale = sum(take.values()) / max(1, sum(sizes.values()))
    parts = [known.filter(F.col("y") == y).orderBy(order).limit(take[y]).withColumn("weight", F.lit(scale * sizes[y] / take[y])) for y in sorted(take)]
    out = known.limit(0).withColumn("weight", F.lit(1.0))
    for part in parts:
        out = out.unionByName(part)
    return out


def _labelled_by(pool: DataFrame, teachers: list[tuple[LogisticRegressionModel, float, float]], view: str) -> DataFrame:
    """Pool rows that one of a view's models (in order, with its calibration) is sure of, with y."""
    rows = pool.withColumn("y", F.lit(None).cast("double"))
    for model, a, b in teachers:
        sure = 1 / (1 + F.exp(-(F.col(f"{view}_odds") * a + b)))
        rows = _log_odds(rows, model, view).withColumn(
            "y", F.coalesce("y", F.when(sure <= SURE_BAD, 0.0).when(sure >= SURE_GOOD, 1.0))).drop(f"{view}_odds")
    return rows.filter("y IS NOT NULL")


def _weighted(pseudo: DataFrame, labelled: dict[float, float]) -> DataFrame:
    """Pseudo-labelled rows with their weight; ``labelled`` is the weight of each class."""
    counts = {r["y"]: r["count"] for r in pseudo.groupBy("y").count().collect()}
    each = {y: min(PSEUDO_WEIGHT, PSEUDO_SHARE * labelled.get(y, 0.0) / max(1, counts.get(y, 0))) for y in (0.0, 1.0)}
    return pseudo.withColumn("weight", F.when(F.col("y") == 0, each[0.0]).otherwise(each[1.0]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", chars_col: str = "n_chars", label_col: str = "quality", max_labelled: int = MAX_LABELLED,
          rounds: int = ROUNDS) -> CoTrained | None:
    """Co-train on labelled rows and all unlabelled ones; None without both classes.

    Rows with a null id are unlabelled. An id with several rows (equal or not) has its
    label with each of them; a label given twice counts as its smaller value. Texts of
    any length are read whole; names of further columns do not matter.
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[source_col].alias("source"),
                       docs[lang_col].alias("lang"), docs[chars_col].alias("n_chars"))
    id_col, text_col, source_col, lang_col, chars_col = docs.columns
    known = (labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("double").alias("y"))
             .filter("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y")))
    # The sample is picked on ids alone before any text is fetched.
    ids = docs.select(docs[id_col].alias("doc_id")).distinct()
    known = stored(known.join(ids, "doc_id", "left_semi"), "cotrain-known")
    picked = stored(_sample(known, max_labelled), "cotrain-ids")
    small = F.broadcast(picked.withColumnRenamed("doc_id", "_id"))  # at most max_labelled ids
    stages = _feature_stages()

    def featured(rows: DataFrame, *more: Column) -> DataFrame:
        raw = _featured(rows, id_col, text_col, source_col, lang_col, chars_col, *more)
        return stages.fit(raw).transform(raw)

    seen = featured(docs.join(small, docs[id_col] == small["_id"]), F.col("y"), F.col("weight"))
    # The sample is bounded, so a few files hold it.
    seen = stored(seen.select("doc_id", "y", "weight", "content", "metadata").repartition(SAMPLE_FILES), "cotrain")
    features = stages.fit(_featured(docs, id_col, text_col, source_col, lang_col, chars_col))
    seen = seen.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0)
    fit_rows, held = (seen.filter(c).select("y", "content", "metadata", "weight") for c in ("NOT held", "held"))
    classes = {r["y"]: r["w"] for r in fit_rows.groupBy("y").agg(F.sum("weight").alias("w")).collect()}
    if len(classes) < 2 or held.select("y").distinct().count() < 2:
        return None
    done = known.select(F.col("doc_id").alias("_id"))
    done = F.broadcast(done) if known.count() <= SMALL_IDS else done
    pool = stored(featured(docs.join(done, docs[id_col] == done["_id"], "left_anti")).select("content", "metadata"), "cotrain-pool")
    models = {v: _fit(fit_rows, v) for v in ("content", "metadata")}
    teachers = {v: [] for v in models}
    for _ in range(rounds):
        for v in models:
            (a,), b = _logit(_log_odds(held, models[v], v), [f"{v}_odds"])
            teachers[v].append((models[v], a, b))
        models = {pupil: _fit(fit_rows.unionByName(_weighted(_labelled_by(pool, teachers[v], v), classes)), pupil)
                  for v, pupil in (("content", "metadata"), ("metadata", "content"))}
    both = held
    for v in models:
        both = _log_odds(both, models[v], v)
    (w_content, w_meta), b = _logit(both, ["content_odds", "metadata_odds"])
    return CoTrained(features, models["content"], models["metadata"], (w_content, w_meta, b))


def score(docs: DataFrame, model: CoTrained | None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", chars_col: str = "n_chars", accept: float = ACCEPT, keep_columns: bool = False) -> DataFrame:
    """One row per input row: doc_id, score (probability of good quality), accepted.

    Null and empty texts have no words and are scored by what is left; null metadata
    counts as an empty value; repeated rows score alike; an empty table gives an empty
    result. Without a model (no labels of both classes) everything is accepted with
    score 1. With ``keep_columns`` the result is the rows as ``row`` (a struct of the
    input's columns, whatever their names), score and accepted.
    """
    kept = F.struct(*[docs[c] for c in docs.columns]) if keep_columns else docs[id_col]
    if model is None:
        out = docs.select(kept.alias("_row"), F.lit(1.0).alias("_score"))
    else:
        rows = model.features.transform(_featured(docs, id_col, text_col, source_col, lang_col, chars_col, kept.alias("_row"))).drop("words", "counts", "tf")
        rows = _log_odds(_log_odds(rows, model.content, "content"), model.metadata, "metadata")
        w_content, w_meta, b = model.weights
        odds = F.col("content_odds") * w_content + F.col("metadata_odds") * w_meta + b
        out = rows.withColumn("_score", 1 / (1 + F.exp(-odds)))
    return out.select(F.col("_row").alias("row" if keep_columns else "doc_id"), F.col("_score").alias("score"), (F.col("_score") >= accept).alias("accepted"))
