"""Ids with several texts, columns with clashing names, and every stage on such rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cuelake.llm import cotraining, jaccard_join, language_crf, substring_dedup
from tests.llm.test_operators import key_sets, linked

CLASHES = ["y", "weight", "words", "held", "_score", "_accepted", "score", "accepted", "row", "_row", "rank", "_id", "_key", "_copies", "_sha", "id",
           "carried", "n", "size", "key"]


def ordered(rows):
    """Rows with an id, by id and then by digest, under numbers of their own; equal ones once."""
    return list(enumerate(sorted({(i, t) for i, t in rows if i is not None}, key=lambda r: (r[0], hashlib.sha256(r[1].encode()).hexdigest())), 1))


@pytest.fixture(scope="module")
def twice():
    """Near copies and passages, ids with two texts, equal rows, null ids."""
    rng = random.Random(9)
    passage = " ".join(f"passage{k}" for k in range(20))
    rows = []
    for k in range(24):
        words = [f"g{k % 4}w{j}" for j in range(60)]
        words[rng.randrange(60)] = f"new{k}"
        rows.append((k // 2, " ".join(words) + (f" {passage}" if k % 3 else "")))
    return [*rows, rows[3], (None, rows[3][1]), (5, "a clean text of its own, met nowhere else at all"), (6, ""), (6, "x")]


def test_substrings_of_ids_with_two_texts(spark, twice):
    seen, want = set(), {}
    for _, (i, t) in ordered(twice):
        raw = t.encode()
        cover = bytearray(len(raw))
        for j in range(len(raw) - 99):
            if raw[j:j + 100] in seen:
                cover[j:j + 100] = b"\1" * 100
            seen.add(raw[j:j + 100])
        want[i, len(raw), hashlib.sha256(bytes(x for x, c in zip(raw, cover) if not c)).hexdigest()] = sum(cover)
    for rows in (twice, twice[::-1]):
        got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert len(got) == len(rows)
        assert {(r["doc_id"], r["n_bytes"], r["kept_sha256"]): r["n_removed"] for r in got if r["doc_id"] is not None} == want
        assert [r["n_removed"] for r in got if r["doc_id"] is None] == [0]


def test_jaccard_join_of_ids_with_two_texts(spark, twice):
    ranks = ordered(twice)
    sets = key_sets([(k, t) for k, (_, t) in ranks], 3)
    of = dict(ranks)
    want = {r: (len(sets[k]), of[c][0], k == c) for (k, r), c in zip(ranks, linked(sets, 90).values())}
    df = spark.createDataFrame(twice, "doc_id bigint, text string")
    got = jaccard_join.near_duplicates(df, n=3, pct=90, count_links=True, carry=df["text"]).collect()
    assert len(got) == len(twice)
    assert {(r["doc_id"], r["carried"]): (r["n_shingles"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None} == want
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    clean = next(r for r in got if r["carried"].startswith("a clean text"))
    assert clean["component_id"] == 5 and clean["n_links"] == 0 and clean["kept"]


def test_language_refuses_too_many_labels(spark, monkeypatch):
    monkeypatch.setattr(language_crf, "MAX_LABELS", 3)
    rows = spark.createDataFrame([(k, f"word{k}", f"l{k % 4}") for k in range(20)], "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError, match="more than 3 labels"):
        language_crf.train(rows)


@pytest.fixture(scope="module")
def clashing(spark, sf, odd, twice):
    """The documents of the smallest table, odd ones and ids with two texts, among columns of every used name."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    same = odd.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame([(i, t, "en", "s", 9) for i, t in twice], "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    rows = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars")).unionByName(same)
    rows = rows.unionByName(spark.createDataFrame([(700, "word " * 60_000, "en", "s", 1)], rows.schema))
    return rows.select("*", *[F.lit(f"{c}!").alias(c) for c in CLASHES])


def test_quality_with_clashing_columns(spark, sf, clashing, empty):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = cotraining.train(clashing, labels)
    assert model is not None
    for docs in (clashing, empty):
        scored = cotraining.score(docs, model).collect()
        assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert cotraining.train(empty, labels) is None
    kept = cotraining.score(clashing, model, keep_columns=True)
    assert kept.select("row.*").columns == clashing.columns and {r["y"] for r in kept.select("row.y").collect()} == {"y!"}


def test_every_stage_with_clashing_columns(spark, sf, clashing):
    import corpus_pipeline

    docs = spark.createDataFrame(clashing.collect(), clashing.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and {r["y"] for r in rows} == {"y!"}
        if name != "mixing":
            assert len(rows) <= docs.count()
        docs = spark.createDataFrame(rows, docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_one_text_of_an_id_stays(spark, sf):
    """A clean text is kept though another text of its id is a copy; null ids and equal rows each count for themselves."""
    import corpus_pipeline

    words = " ".join(f"w{k}" for k in range(80))
    rows = [(1, words), (2, words + " end"), (2, "clean words of its own and some more"), (None, "no id here"), (None, "none here either"),
            (3, "the same row"), (3, "the same row"), (4, words + " two"), (4, words + " three")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    near = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()]
    assert sorted(near, key=str) == sorted([rows[0], rows[2], rows[3], rows[4], rows[5], rows[6]], key=str)
    mixed = corpus_pipeline.mixed_sources(spark, docs, sf).collect()
    assert len(mixed) == len(rows)  # one source: every row once
