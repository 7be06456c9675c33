import math
import random

import pytest
from pyspark.sql import functions as F

from cuelake.functions import disfluency as D, labels as L, text as T, vectors as V
from cuelake.functions.draws import draw_hash
from cuelake.operators import (augment as A, calibrate as C, compare as P, curate as U, fit as FT, metrics as M,
                               ranks as N, score as SC, skew as S)
from cuelake.plans import roles as R


def preds(spark, rows):
    return spark.createDataFrame(rows, "gold string, pred string, conf double")


EDGES = [0.0, 0.1, 0.3, 0.55, 0.6, 0.7, 0.9, 0.95, 0.999, 1.0]
ROWS = [("a", "a" if i % 3 else "b", c) for i, c in enumerate(EDGES * 3)]


def test_ece_edges(spark):
    n, total = len(ROWS), 0.0
    edges = [i * 0.1 for i in range(11)]
    for lo, hi in zip(edges, edges[1:]):
        inside = [(g == p, c) for g, p, c in ROWS if lo <= c < hi]
        if inside:
            total += abs(sum(o for o, _ in inside) - sum(c for _, c in inside)) / n
    got = M.ece(preds(spark, ROWS)).first()
    assert got["n"] == n and got["ece"] == pytest.approx(total)


def test_threshold_table_and_curve(spark):
    for r in M.threshold_table(preds(spark, ROWS)).collect():
        below = [g == p for g, p, c in ROWS if c < r["tau"]]
        above = [g == p for g, p, c in ROWS if c >= r["tau"]]
        assert r["n_deferred"] == len(below)
        assert r["deferred_accuracy"] == pytest.approx(sum(below) / len(below))
        assert r["kept_accuracy"] == pytest.approx(sum(above) / len(above))
    assert M.threshold_table(preds(spark, [("a", "a", 0.9)])).filter("deferred_accuracy is not null").count() == 0
    curve = M.deferral_curve(preds(spark, ROWS).withColumn("suite", F.lit("x"))).collect()
    assert len(curve) == 101
    for r in curve:
        assert r["n_deferred"] == sum(c < 0.5 + r["cut"] * 0.005 for _, _, c in ROWS)


def test_histogram_keeps_one(spark):
    got = M.histogram(preds(spark, ROWS).withColumn("suite", F.lit("x"))).collect()
    assert sum(r["n"] for r in got) == len(ROWS)
    assert sum(r["density"] for r in got) * 0.05 == pytest.approx(1.0)


def test_tied_logits_take_lowest_index(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "z array<double>")
    r = df.select(V.argmax(F.col("z")).alias("i"), V.softmax(F.col("z")).alias("p")).first()
    assert r["i"] == 1 and sum(r["p"]) == pytest.approx(1.0)
    d = df.select(V.distribution(V.softmax(F.col("z")), F.array(*map(F.lit, "abc"))).alias("d")).first()["d"]
    assert [x["label"] for x in d] == ["b", "c", "a"]


@pytest.mark.parametrize("accuracy", [20, 100_000])
def test_kth_values(spark, accuracy):
    rng = random.Random(4)
    vals = [rng.choice([1.5, 1.5, rng.random() * 100]) for _ in range(4000)]
    rows = spark.createDataFrame([(v,) for v in vals], "ms double").repartition(5)
    n = F.col("n")
    got = N.kth_values(rows, "ms", [], {"mid": (0.5, F.floor(n / 2)), "hi": (0.95, F.floor(n * 0.95))}, accuracy).first()
    s = sorted(vals)
    assert (got["mid"], got["hi"]) == (s[2000], s[3800])


def test_latency_rules(spark):
    got = M.latency(spark.createDataFrame([(float(i),) for i in (4, 1, 3, 2)], "ms double")).first()
    assert (got["p50_rank"], got["p50_linear"]) == (3.0, 2.5)


def test_stratified_split_is_exact_and_stable(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 700, "a").when(F.col("id") < 990, "b").otherwise("c").alias("l"))
    got = N.stratified_split(rows, "id", "l", 0.2).filter("chosen")
    sizes = {r["l"]: r["count"] for r in got.groupBy("l").count().collect()}
    assert sizes == {"a": 140, "b": 58, "c": 2}
    again = N.stratified_split(rows.repartition(13), "id", "l", 0.2).filter("chosen")
    assert {r["id"] for r in got.collect()} == {r["id"] for r in again.collect()}


@pytest.mark.parametrize("limit", [0, 1000])
def test_membership_same_on_both_paths(spark, limit):
    rows = spark.range(500).select("id", F.sha2((F.col("id") % 7).cast("string"), 256).alias("h")).select(
        "id", F.unhex("h").alias("k"))
    keys = rows.filter("id in (2, 5)").select("k")
    assert {r["id"] % 7 for r in S.keep_keys(rows, keys, "k", limit).collect()} == {2, 5}
    assert S.exclude_keys(rows, keys, "k", limit).count() + S.keep_keys(rows, keys, "k", limit).count() == 500


@pytest.mark.parametrize("limit", [0, 1000])
def test_containment_matches_brute_force(spark, limit):
    rng = random.Random(9)
    docs = [" ".join(rng.choice("abcdef") for _ in range(60)) for _ in range(40)]
    items = [d.upper()[10:10 + 2 * n] for d, n in zip(docs, [1, 2, 5, 8, 9, 14] * 2)] + ["z z z", "?!"]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    norm = lambda s: " " + " ".join(s.lower().replace("?!", "").split()) + " "
    want = {(i, j) for i, x in enumerate(docs) for j, y in enumerate(items) if norm(y).strip() and norm(y) in norm(x)}
    got = [tuple(r) for r in U.contained_passages(d, b, "doc_id", "item_id", limit=limit).collect()]
    assert sorted(got) == sorted(want)


def test_augment_invariants(spark, sf):
    src = [("start the radio app", "integration"), ("locate the volume slider", "find_action"), ("how late is it now", "chat"),
           ("which team came first", "chat"), ("note that my sister's train leaves at six", "memory"), ("junk", "none"),
           ("compare two laptops and order the lighter one", "agent")] * 4
    rows = spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(src)], "seq long, text string, intent string")
    holdout = spark.createDataFrame([("um start the radio app",), ("Can you, start the radio app?",)], "text string")
    got = A.augment(rows, holdout).collect()
    again = A.augment(rows.repartition(5), holdout).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) and got
    loose = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower().replace("'", "")).split())
    keys = [loose(r["text"]) for r in got]
    assert len(set(keys)) == len(keys) and not {"um start the radio app", "can you start the radio app"} & set(keys)
    assert all(keys) and all(loose(r["text"]) != loose(src[r["seq"]][0]) for r in got)
    per_row = {}
    for r in got:
        per_row[r["seq"]] = per_row.get(r["seq"], 0) + 1
        assert r["intent"] == src[r["seq"]][1] != "none"
        if r["intent"] in ("integration", "find_action"):
            assert D.CHAIN_LINK not in r["text"]
    assert max(per_row.values()) <= 2


def test_temperature_fit(spark, sf):
    known = C.with_gold_index(R.scored(spark, sf).filter("suite = 'indist'"))
    fit = C.fit_temperature(known)
    around = [t for t in (fit.optimum * 0.98, fit.optimum, fit.optimum * 1.02) if 0.5 <= t <= 20.0]
    near = {r["temperature"]: r["nll"] for r in C.nll_grid(known, around).collect()}
    assert min(near.values()) == pytest.approx(near[fit.optimum], abs=1e-9)
    assert fit.nll <= fit.nll_at_one + 1e-12 and 0.5 <= fit.temperature <= 20.0


def test_floor_model_separates(spark):
    rows = [("click the button", "find_action"), ("tap the icon", "find_action"), ("remember my name", "memory"),
            ("note my birthday", "memory")] * 5
    df = spark.createDataFrame(rows, "text string, intent string")
    model = FT.fit_floor(df, max_iter=50)
    assert model.predict(df).filter("pred <> intent").count() == 0
    assert model.labels == ["find_action", "memory"]
    terms = df.select(F.explode(T.unigrams_and_bigrams(F.col("text")))).distinct().count()
    assert len(model.features.stages[0].vocabulary) == terms


def test_hashed_floor_model_separates_at_its_own_size(spark):
    rows = [("click the button", "find_action"), ("tap the icon", "find_action"), ("remember my name", "memory"),
            ("note my birthday", "memory")] * 5
    df = spark.createDataFrame(rows, "text string, intent string")
    hashed = FT.fit_hashed_floor(df, features=1 << 10)
    assert hashed.classifier.stages[0].numFeatures == 1 << 10
    assert hashed.predict(df).filter("pred <> intent").count() == 0
    tiny = FT.fit_hashed_floor(df, features=4, max_iter=50)
    assert tiny.classifier.stages[0].numFeatures == 4 and tiny.labels == hashed.labels


def test_head_fit_is_alphabetical_and_balanced(spark):
    rows = [([1.0, 0.0], "b")] * 30 + [([0.0, 1.0], "a")] * 3
    head = FT.fit_head(spark.createDataFrame(rows, "embedding array<double>, y string"), "y")
    assert [(r["idx"], r["label"]) for r in head.orderBy("idx").collect()] == [(0, "a"), (1, "b")]


def test_parity_and_promotion(spark):
    a = spark.createDataFrame([(1, "x", "x"), (2, "y", "x")], "id int, pred string, gold string")
    b = spark.createDataFrame([(1, "x", "x"), (2, "x", "x")], "id int, pred string, gold string")
    assert P.parity(a, b, "id").first()["matched"] == 1
    with pytest.raises(Exception, match="prediction mismatch at id 2"):
        P.parity(a, b, "id", strict=True).collect()
    assert P.promote(a, b, "id").first()["promote"] is True
    assert P.promote(a, a, "id").first()["promote"] is False
    assert P.promote(a, b.filter("id = 1"), "id").first()["promote"] is False
    with pytest.raises(Exception, match="prediction mismatch at id 2"):
        P.parity(a, b, "id", strict=True).select("n").collect()


def test_promotion_keeps_suites_apart(spark):
    cols = "id int, pred string, gold string, suite string"
    a = spark.createDataFrame([(1, "x", "x", "holdout"), (2, "y", "x", "holdout"), (3, "x", "x", "ood")], cols)
    b = spark.createDataFrame([(1, "x", "x", "holdout"), (2, "x", "x", "holdout"), (3, "y", "x", "ood")], cols)
    got = {r["suite"]: (r["current_accuracy"], r["candidate_accuracy"], r["promote"]) for r in P.promote(a, b, "id", "suite").collect()}
    assert got == {"holdout": (0.5, 1.0, True), "ood": (1.0, 0.0, False)}
    moved = b.withColumn("suite", F.when(F.col("id") == 2, "ood").otherwise(F.col("suite")))
    with pytest.raises(Exception, match="suites differ at id 2"):
        P.promote(a, moved, "id", "suite").select("promote").collect()
    part = {r["suite"]: r["same_ids"] for r in P.promote(a, b.filter("id <> 1"), "id", "suite").collect()}
    assert part == {"holdout": False, "ood": True}


def _unit_pairs(rows):
    """(label, label, cosine) of every pair of rows, each once."""
    import numpy as np

    vs = [(y, np.array(v, float) / max(np.linalg.norm(v), 1e-12)) for y, v in rows if v is not None]
    return len(vs), [(a, b, float(u @ v)) for i, (a, u) in enumerate(vs) for b, v in vs[i + 1:]]


@pytest.mark.parametrize("dims,near", [(5, 0.0), (150, 0.0), (8, 0.999)])
def test_cosines_of_all_pairs(spark, dims, near):
    rng = random.Random(dims)
    base = [rng.gauss(0, 1) for _ in range(dims)]
    rows = [(rng.choice("abc"), [near * x + (1 - near) * rng.gauss(0, 1) for x in base]) for _ in range(61)]
    rows += [("a", rows[0][1]), ("b", [0.0] * dims), ("c", None), ("lone", base)]
    emb = spark.createDataFrame(rows, "y string, embedding array<double>").repartition(7)
    n, pairs = _unit_pairs(rows)
    mean = sum(c for *_, c in pairs) / len(pairs)
    got = SC.cosine_moments(emb).first()
    assert (got["n"], got["pairs"]) == (n, len(pairs))
    assert got["avg_cos"] == pytest.approx(mean, abs=1e-12)
    assert got["sd_cos"] == pytest.approx(math.sqrt(sum((c - mean) ** 2 for *_, c in pairs) / len(pairs)), abs=1e-7)
    for r in SC.class_cohesion(emb, "y").collect():
        within = [c for a, b, c in pairs if a == b == r["y"]]
        between = [c for a, b, c in pairs if (a == r["y"]) != (b == r["y"])]
        assert r["within_cos"] == (pytest.approx(sum(within) / len(within), abs=1e-12) if within else None)
        assert r["between_cos"] == pytest.approx(sum(between) / len(between), abs=1e-12)


def test_cosines_of_few_or_uneven_vectors(spark):
    none = spark.createDataFrame([], "y string, embedding array<float>")
    assert tuple(SC.cosine_moments(none).first()) == (0, 0, None, None) and SC.class_cohesion(none, "y").count() == 0
    one = spark.createDataFrame([("a", [1.0, 2.0])], "y string, embedding array<float>")
    assert tuple(SC.cosine_moments(one).first()) == (1, 0, None, None)
    assert tuple(SC.class_cohesion(one, "y").first()) == ("a", 1, None, None)
    uneven = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [1.0])], "y string, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        SC.cosine_moments(uneven).collect()


def test_too_many_classes_fail_before_they_are_packed(spark, monkeypatch):
    monkeypatch.setattr(SC, "MAX_CLASSES", 3)
    emb = spark.createDataFrame([(str(i % 4), [1.0, float(i)]) for i in range(8)], "y string, embedding array<double>")
    with pytest.raises(Exception, match="more than 3 classes"):
        SC.nearest_label(emb, "y").select("y").collect()
    assert SC.nearest_label(emb.filter("y <> '0'"), "y").count() == 6


def test_report_marks_cached_figures_of_a_changed_suite(spark):
    both = preds(spark, ROWS).withColumns({"model": F.lit("now"), "suite": F.lit("holdout")})
    cached = spark.createDataFrame([("old", "holdout", len(ROWS), 0.9), ("older", "holdout", len(ROWS) - 1, 0.8), ("old", "gone", 5, 1.0)],
                                   "model string, suite string, eval_n long, accuracy double")
    got = {(r["model"], r["suite"], r["metric"]): r["value"] for r in M.evaluation_report(both, ["a", "b"], baselines=cached).collect()
           if r["metric"] in ("stale", "cached_n", "cached_accuracy")}
    assert got == {("old", "holdout", "stale"): 0.0, ("old", "holdout", "cached_n"): len(ROWS), ("old", "holdout", "cached_accuracy"): 0.9,
                   ("older", "holdout", "stale"): 1.0, ("older", "holdout", "cached_n"): len(ROWS) - 1, ("older", "holdout", "cached_accuracy"): 0.8}
