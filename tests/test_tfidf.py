"""TF-IDF against counts by hand: repeated and null ids, texts without terms, more tasks for more text."""

import math
import re
from collections import Counter, defaultdict

import pytest

from cuelake.operators import tfidf as X

ROWS = [(1, "play the song the loud song"), (1, "the end"), (None, "play again"), (2, None), (3, ""), (4, "The song"), (5, "play play play")]


def grams(text):
    words = re.findall(r"\w\w+", (text or "").lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


@pytest.mark.parametrize("task_bytes", [8 << 20, 5])
def test_tfidf_by_hand(spark, monkeypatch, task_bytes):
    monkeypatch.setattr(X, "TASK_BYTES", task_bytes)
    docs = spark.createDataFrame(ROWS, "id long, text string")
    tf = defaultdict(Counter)
    for i, text in ROWS:
        tf[i].update(grams(text))
    df = Counter(t for c in tf.values() for t in c)
    raw = {(i, t): n * (math.log((1 + len(ROWS)) / (1 + df[t])) + 1) for i, c in tf.items() for t, n in c.items()}
    got = {(r["id"], r["term"]): r for r in X.tfidf(docs, "id").collect()}
    assert set(got) == set(raw)
    for (i, t), r in got.items():
        norm = math.sqrt(sum(w * w for (j, _), w in raw.items() if j == i))
        assert (r["tf"], r["df"], r["weight"]) == (tf[i][t], df[t], pytest.approx(raw[i, t] / norm))


def test_tasks_follow_the_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words of a text") for i in range(200)], "id long, text string")
    monkeypatch.setattr(X, "TASK_BYTES", 100)
    counts = X.term_counts(docs, "id")
    assert counts.rdd.getNumPartitions() == 40 and counts.count() == 200 * 7
    assert X.tfidf(docs.limit(0), "id").count() == 0
    # Nobody asks for the terms, so no exchange after the texts' moves one.
    plan = X.tfidf(docs, "id").groupBy("id").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "AS term" not in plan.split("Window")[0]
