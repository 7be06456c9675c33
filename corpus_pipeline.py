"""From raw documents to token ids: the corpus pipeline.

Each stage takes the documents the one before kept and returns documents, the last one
their pieces. Between stages the documents are written to the shared folder and read
again, so a lost executor costs a stage's tasks and not the run.

Null and repeated ids, equal rows, ties, empty tables, texts of any length and further
columns of any name pass through every stage but the last, which returns ids and tokens.
Of tied documents the smallest id stays; where one id has several texts, one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuelake.llm import cotraining, exact_dedup, jaccard_join, mixing, pieces
from cuelake.llm.common import documents, fresh, row_key, sha256_hex, stored, text_of

# Words per shingle and similarity, in per cent, of near duplicates.
SHINGLE_WORDS, SIMILAR_PCT = 5, 80
ORACLE_SQL = None  # most stages cannot be said in SQL


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained classifier accepts."""
    model = cotraining.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return cotraining.score(docs, model, keep_columns=True).filter("accepted").select("row.*")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id."""
    found = stored(exact_dedup.exact_duplicates(docs), "exact-found")
    gone_id, sha, key = (fresh(docs.columns, c) for c in ("_id", "_sha", "_key"))
    gone = found.filter("keep_id IS NOT NULL AND NOT (doc_id <=> keep_id)").select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(sha))
    keyed = docs.withColumn(key, sha256_hex(text_of(docs["text"])))
    kept = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(sha)), "left_anti")
    if not found.filter("NOT kept AND (doc_id <=> keep_id)").isEmpty():  # rows repeating id and text
        kept = kept.dropDuplicates(["doc_id", key])
    return kept.drop(key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id."""
    found = stored(jaccard_join.near_duplicates(docs, n=SHINGLE_WORDS, pct=SIMILAR_PCT, carry=row_key(docs)), "near-found")
    key = fresh(docs.columns, "_key")
    gone = found.filter("NOT kept").select(F.col("carried").alias(key)).distinct()
    return docs.withColumn(key, row_key(docs)).join(gone, key, "left_anti").drop(key)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources meet their target weights.

    Equal rows stand for one another: together they come as often as they are to.
    """
    key, copies = fresh(docs.columns, "_key"), fresh(docs.columns, "_copies")
    per_row = stored(mixing.mix(docs, carry=row_key(docs)).groupBy(F.col("carried").alias(key)).agg(
        F.sum("copies").cast("int").alias(copies), F.count("*").alias("n")), "mix")
    keyed = docs.withColumn(key, row_key(docs))
    if not per_row.filter("n > 1").isEmpty():
        keyed = keyed.dropDuplicates([key])
    taken = keyed.join(per_row.filter(F.col(copies) > 0).drop("n"), key)
    return taken.withColumn(key, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("near duplicates", near_duplicates),
    ("mixing", mixed_sources),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
