"""Claims in turn, partners by place and the keyed store, against loops over the rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cuelake.functions import disfluency as D, keys as K
from cuelake.operators import augment as A, ranks as RK
from cuelake.operators.claims import claim_in_turn
from cuelake.sources import keyed_store as KS


def in_turn(candidates, blocked, per_row):
    """The loop: rows by id, attempts in order, a key to whoever comes first."""
    taken, kept, made = set(blocked), [], {}
    for row, attempt, key in sorted(candidates, key=lambda c: c[:2]):
        if key is not None and key not in taken and made.get(row, 0) < per_row:
            taken.add(key)
            kept.append((row, attempt))
            made[row] = made.get(row, 0) + 1
    return kept


@pytest.mark.parametrize("n_keys, per_row", [(6, 2), (40, 2), (25, 1), (400, 3)])
def test_claims_are_the_loop_s(spark, n_keys, per_row):
    rng = random.Random(n_keys)
    candidates = [(row, a, rng.choice([None, *range(n_keys)])) for row in range(40) for a in range(12)]
    digest = lambda k: None if k is None else hashlib.sha256(str(k).encode()).digest()
    df = spark.createDataFrame([(r, a, digest(k)) for r, a, k in candidates], "seq long, attempt int, key binary")
    blocked = spark.createDataFrame([(digest(k),) for k in (0, 3)], "key binary")
    got = claim_in_turn(df.repartition(5), blocked, "seq", per_row)
    assert sorted((r["seq"], r["attempt"]) for r in got.kept.collect()) == in_turn(candidates, {0, 3}, per_row)
    assert 1 <= got.rounds <= len(candidates)


def test_a_chain_of_refusals(spark):
    """Each row loses its first key to the one before: the longest way to a decision."""
    digest = lambda k: hashlib.sha256(str(k).encode()).digest()
    candidates = [(row, a, max(row - 1, 0) + a) for row in range(8) for a in range(3)]
    df = spark.createDataFrame([(r, a, digest(k)) for r, a, k in candidates], "seq long, attempt int, key binary")
    got = claim_in_turn(df, None, "seq", 2)
    assert sorted((r["seq"], r["attempt"]) for r in got.kept.collect()) == in_turn(candidates, set(), 2) and got.rounds > 2


def test_positions_of_one_large_group(spark):
    rows = [("big", k, f"{hash(k) % 997:04d}") for k in range(3000)] + [("small", k, "0") for k in range(5)] + [(None, 9, "1")]
    df = spark.createDataFrame(rows, "g string, id long, h string")
    got = {(r["g"], r["id"]): r["pos"] for r in RK.positions(df.repartition(7), "g", ["h", "id"]).collect()}
    for g in ("big", "small", None):
        order = sorted((h, i) for x, i, h in rows if x == g)
        assert [got[g, i] for _, i in order] == list(range(len(order)))


def test_partners_are_drawn_anew_over_the_whole_class(spark):
    rows = spark.createDataFrame([(k, f"text {k % 50}", "a" if k < 60 else "b") for k in range(61)], "seq long, text string, intent string")
    tries = rows.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(11))))
    got = A.attempt_partners(tries, A.directory(rows, "seq", 4), "seq", 4).collect()
    again = A.attempt_partners(tries.repartition(3), A.directory(rows.repartition(5), "seq", 4), "seq", 4).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str) and len(got) == 61 * 12
    assert all(r["partner"] is None for r in got if r["intent"] == "b")
    per_row = {}
    for r in got:
        assert r["partner"] != r["text"]
        per_row.setdefault(r["seq"], set()).add(r["partner"])
    assert sum(len(per_row[k]) for k in range(60)) / 60 > 9 and len(set().union(*(per_row[k] for k in range(60)))) == 51


def test_augment_is_the_loop_over_its_candidates(spark):
    """A label space of its own, and few distinct texts, so that rows compete for variants."""
    rows = [(k, f"open the {'red' if k % 3 else 'blue'} door{'.' if k % 2 else ''}", "ask" if k % 4 else "order") for k in range(40)]
    df = spark.createDataFrame(rows, "seq long, text string, intent string")
    holdout = spark.createDataFrame([("um open the red door",)], "text string")
    made = A.augment_in_turn(df, holdout, labels=["ask", "order"], chainable=["order"])
    got = sorted((r["seq"], r["attempt"], r["text"]) for r in made.rows.collect())
    base = df.withColumn("chains", F.col("intent") == "order")
    tries = base.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(11))))
    known = A.directory(df.filter("intent = 'order'"), "seq", 0)
    every = A._with_variants(tries, known, "seq", 0, ["order"]).select(
        "seq", "attempt", "variant", K.key_loose(F.col("text")).alias("own"), K.key_loose(F.col("variant")).alias("key")).collect()
    text = {(r["seq"], r["attempt"]): r["variant"] for r in every}
    candidates = [(r["seq"], r["attempt"], r["key"] if r["key"] and r["key"] != r["own"] else None) for r in every]
    want = in_turn(candidates, {"um open the red door"}, 2)
    assert got == [(*at, text[at]) for at in want] and made.rounds > 1
    assert any(D.CHAIN_LINK in t for s, _, t in got if s % 4 == 0) and not any(D.CHAIN_LINK in t for s, _, t in got if s % 4)


def stored(spark, path):
    return sorted((r["text"], r["intent"]) for r in KS.read_store(spark, path).collect())


def test_keyed_store_replay_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(f"Say {k}!", "chat") for k in "abcdefghij"] + [("say a", "agent"), ("", "chat"), (None, "chat")]
    df = spark.createDataFrame(rows, "text string, intent string")
    assert KS.read_store(spark, path) is None
    assert KS.append_keyed(df.limit(4), path, digits=1) == 4
    first = KS.append_keyed(df, path)
    assert KS.append_keyed(df, path) == 0 and KS.append_keyed(df.repartition(5), path) == 0
    assert len(stored(spark, path)) == 4 + first
    assert KS.read_store(spark, path).selectExpr("max(length(prefix))").first()[0] == 1
    KS.compact_store(spark, path, str(tmp_path / "compact"))
    assert stored(spark, str(tmp_path / "compact")) == stored(spark, path)
    assert KS.append_keyed(df, str(tmp_path / "compact")) == 0


def test_keyed_store_reads_only_the_batch_s_prefixes(spark, tmp_path):
    path = str(tmp_path / "store")
    many = spark.range(3000).select(F.concat(F.lit("row "), F.md5(F.col("id").cast("string"))).alias("text"), F.lit("chat").alias("intent"))
    KS.append_keyed(many, path)
    store = KS.read_store(spark, path)
    assert store.select("prefix").distinct().count() == 256
    one = store.limit(1).select("digest", "prefix").collect()[0]
    batch = spark.createDataFrame([(bytes(one["digest"]), one["prefix"])], "digest binary, prefix string")
    found = KS.known_digests(store, batch)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x)
    assert "ReadSchema: struct<digest:binary>" in scan and f"= {one['prefix']})" in scan.split("PartitionFilters")[1]
    assert [bytes(r["digest"]) for r in found.collect()] == [bytes(one["digest"])]
