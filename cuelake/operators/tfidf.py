"""TF-IDF over word unigrams and bigrams: smoothed idf, L2-normalised rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window as W, functions as F

from cuelake.functions import text as T

# Text counted by one task: about two million terms.
TASK_BYTES = 8 << 20


def term_counts(docs: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, term, tf). Documents are hashed by id before their terms are exploded: the
    text is smaller than its terms, and counting then needs no further shuffle. As many
    partitions as the text asks for keep a task's table of terms in memory."""
    texts = docs.select(id_col, text_col)
    size = texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    grams = texts.repartition(tasks, id_col).select(id_col, F.explode(T.unigrams_and_bigrams(F.col(text_col))).alias("term"))
    return grams.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf(df_table: DataFrame, docs: DataFrame) -> DataFrame:
    """Add ``idf`` = ln((1 + n) / (1 + df)) + 1, n being the number of documents."""
    n = docs.agg(F.count(F.lit(1)).alias("_docs"))
    value = F.log((F.lit(1) + F.col("_docs")) / (F.lit(1) + F.col("df"))) + 1
    return df_table.join(F.broadcast(n)).select("term", "df", value.alias("idf"))


def tfidf(docs: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, term, tf, df, weight). Rows meet by 80 bits of their term, so a caller who
    leaves the terms out moves none; they go by term once and come back by document with
    counts only. A term has at most a row per document, a document's norm is its own."""
    term = F.col("term")
    keyed = term_counts(docs, id_col, text_col).withColumns({"_h": F.xxhash64(term), "_i": F.pmod(F.hash(term), F.lit(1 << 16))})
    n = docs.agg(F.count(F.lit(1)).alias("_docs"))
    rows = keyed.withColumn("df", F.count(F.lit(1)).over(W.partitionBy("_h", "_i"))).drop("_h", "_i")
    raw = F.col("tf") * (F.log((F.lit(1) + F.col("_docs")) / (F.lit(1) + F.col("df"))) + 1)
    # Dealt before they are weighed: counts are narrower than weights.
    weighed = rows.repartition(id_col).join(F.broadcast(n)).withColumn("_w", raw)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(id_col)))
    return weighed.select(id_col, "term", "tf", "df", (F.col("_w") / norm).alias("weight"))
