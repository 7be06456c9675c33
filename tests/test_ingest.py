import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cuelake.functions import keys as K, labels as L
from cuelake.operators import ingest as I


def sequential(rows, pool, evals):
    """The rule, one row after another. Keys here are the lowercased, stripped texts."""
    key = lambda t: t.lower().strip().rstrip(".!? ").strip()
    seen, ev, out = {key(t) for t in pool}, {key(t) for t in evals}, {}
    for seq, text, label in rows:
        t = (text or "").strip()
        if not t:
            out[seq] = "empty"
        elif key(t) in ev:
            out[seq] = "leak"
        elif key(t) in seen:
            out[seq] = "dup"
        elif label and label not in L.INTENTS:
            out[seq] = "bad"
        else:
            out[seq] = "client_label" if label else "teacher_label"
            seen.add(key(t))
    return out


@pytest.mark.parametrize("seed,hot_rows,hot_keys", [(1, 100_000, 1000), (2, 1, 3), (3, 2, 1)])
def test_matches_sequential_rule(spark, seed, hot_rows, hot_keys):
    rng = random.Random(seed)
    texts = ["Stop", "stop.", "go", "Go!", "...", " ", None, "wait", "later", "eval me", "pooled"]
    rows = [(i, rng.choice(texts + ["stop"] * 6), rng.choice([None, "", "chat", "none", "tyop"])) for i in range(300)]
    pool, evals = ["pooled", "later."], ["Eval me"]
    frame = lambda ts: spark.createDataFrame([(t,) for t in ts], "text string")
    samples = spark.createDataFrame(rows, "seq long, text string, client_label string").repartition(7)
    got = I.ingest_status(samples, frame(pool), frame(evals), hot_rows=hot_rows, hot_keys=hot_keys)
    assert {r["seq"]: r["status"] for r in got.collect()} == sequential(rows, pool, evals)


def test_bad_row_does_not_claim_its_key(spark):
    rows = [(0, "a b", "tyop"), (1, "A b.", "chat"), (2, "a b", "tyop"), (3, "a b", None)]
    samples = spark.createDataFrame(rows, "seq long, text string, client_label string")
    none = spark.createDataFrame([], "text string")
    got = {r["seq"]: r["status"] for r in I.ingest_status(samples, none, none).collect()}
    assert got == {0: "bad", 1: "client_label", 2: "dup", 3: "dup"}


def test_queue_and_merge(spark):
    samples = spark.createDataFrame([(0, "My pin is 1", None), (1, "hello", None), (2, "x", "memory")],
                                    "seq long, text string, client_label string")
    none = spark.createDataFrame([], "text string")
    teacher = spark.createDataFrame([("hello", "chat")], "text string, intent string").select(
        K.digest(K.key_redacted(F.col("text"))).alias("key"), "intent")
    job = I.ingest(samples, none, none, teacher)
    assert [r["text"] for r in job.queue.collect()] == ["my pin <SECRET>"]
    new = {(r["text"], r["intent"], r["source"]) for r in job.new_rows.collect()}
    assert new == {("hello", "chat", "teacher"), ("x", "memory", "client")}
    assert sum(r["n"] for r in job.counts.collect()) == 3


def test_job_counts_while_writing_and_knows_its_store(spark, tmp_path):
    rng = random.Random(5)
    texts = ["Stop", "stop.", "go", "...", " ", None, "wait", "later", "eval me", "pooled"]
    rows = [(i, rng.choice(texts), rng.choice([None, "", "chat", "none", "tyop"])) for i in range(200)]
    frame = lambda ts: spark.createDataFrame([(t,) for t in ts], "text string")
    samples = spark.createDataFrame(rows, "seq long, text string, client_label string").repartition(5)
    teacher = spark.createDataFrame([(hashlib.sha256(b"go").digest(), "agent")], "key binary, intent string")
    pool, evals, out = frame(["pooled"]), frame(["Eval me"]), str(tmp_path / "store")
    run = I.run_ingest(samples, pool, evals, teacher, out)
    want = sequential(rows, ["pooled"], ["Eval me"])
    assert run.counts == {s: sum(v == s for v in want.values()) for s in I.STATUSES}
    lazy = I.ingest(samples, pool, evals, teacher)
    assert sorted(map(tuple, run.new_rows.collect())) == sorted(map(tuple, lazy.new_rows.collect()))
    assert sorted(map(tuple, run.queue.collect())) == sorted(map(tuple, lazy.queue.collect()))
    assert run.appended == lazy.new_rows.count() > 0
    again = I.run_ingest(samples, pool, evals, teacher, out)
    assert again.appended == 0 and again.counts["client_label"] == 0 and sum(again.counts.values()) == 200
    first = I.run_ingest(samples, pool, evals, teacher, limit=50)
    assert sum(first.counts.values()) == 50 and first.appended == 0
    assert {r["status"]: r["n"] for r in I.dry_run(samples, pool, evals).collect()} == run.counts
    assert set(I.run_ingest(samples.limit(0), pool, evals, teacher).counts.values()) == {0}
