from datetime import datetime, timedelta
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from savora.operators import ranking_eval as ev
from savora.operators import taste as ta
from savora.plans import skew
from savora.settings import REVIEW_TAGS, default_polarity

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def reviews():
    rng = np.random.default_rng(2)
    rows = [
        (f"u{rng.integers(12)}", f"i{rng.integers(6)}", float(rng.integers(1, 6)), START + timedelta(days=int(rng.integers(900))))
        for _ in range(150)
    ]
    rows += [("hot", "i1", float(n % 5 + 1), START + timedelta(days=n)) for n in range(80)]
    rows += [("one", "i2", 5.0, START), ("flat", "i1", 3.0, START), ("flat", "i2", 3.0, START)]
    return rows + [("lost", "gone", 1.0, START), ("lost", "i3", 4.0, START)]


@pytest.mark.parametrize("min_rows", [1, 10_000])
def test_affinity(spark, reviews, min_rows, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", min_rows)
    rng = np.random.default_rng(4)
    strength = {f"i{n}": rng.uniform(size=2) for n in range(6)}
    counts = {i: sum(r[1] == i for r in reviews) for i in strength}
    items = spark.createDataFrame(
        [(i, counts[i], float(s[0]), float(s[1])) for i, s in strength.items()],
        "recipe_id string, review_count bigint, intensity_a double, intensity_b double",
    )
    weights = spark.createDataFrame([("a", 0.7), ("b", 1.5)], "tag string, idf double")
    df = spark.createDataFrame(reviews, "user_id string, recipe_id string, rating double, ts timestamp")
    got = {r.user_id: r for r in ta.affinity_vectors(df, items, weights).collect()}
    latest = max(r[3] for r in reviews)
    for user in {r[0] for r in reviews}:
        own = [r for r in reviews if r[0] == user]
        mean = np.mean([r[2] for r in own])
        w = np.array([0.5 ** ((latest - r[3]).days / 365) for r in own])
        dev = np.array([r[2] - mean for r in own])
        s = np.array([strength.get(r[1], np.zeros(2)) for r in own])
        expected = np.array([0.7, 1.5]) * (w[:, None] * dev[:, None] * s).sum(axis=0) / w.sum()
        assert got[user].affinity == pytest.approx(list(expected), abs=1e-12)
        assert (got[user].n_reviews, got[user].mean_rating) == (len(own), pytest.approx(mean))
    assert got["one"].affinity == [0.0, 0.0] and got["flat"].affinity == [0.0, 0.0]


def test_scores_and_cold_start(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", 1)
    items = spark.createDataFrame([("x", 1.0, 0.0), ("z", 0.0, 0.0)], "recipe_id string, intensity_a double, intensity_b double")
    profiles = spark.createDataFrame([("u", [1.0, 1.0])], "user_id string, affinity array<double>")
    candidates = spark.createDataFrame([("u", "x"), ("u", "z"), ("new", "x"), ("u", "?")], "user_id string, recipe_id string")
    got = {(r.user_id, r.recipe_id): r.affinity_score for r in ta.affinity_scores(candidates, profiles, items).collect()}
    assert got == {("u", "x"): pytest.approx(0.5**0.5), ("u", "z"): 0.0, ("new", "x"): 0.0, ("u", "?"): 0.0}
    known = spark.createDataFrame([("u", 0.5)], "user_id string, affinity_score double")
    cold = ta.with_cold_start(candidates.select("user_id").distinct(), known, ["user_id"])
    assert {r.user_id: r.affinity_score for r in cold.collect()} == {"u": 0.5, "new": 0.0}


def test_tag_weights_and_polarity(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0), (1, None)], "pred_dry int, pred_other int")
    got = {r.tag: r for r in ta.with_polarity(ta.tag_weights(df), default_polarity()).collect()}
    assert got["dry"].idf == pytest.approx(log(2)) and got["dry"].polarity == -1
    assert (got["other"].idf, got["other"].polarity) == (0.0, 0)
    polarity = default_polarity()
    assert len(REVIEW_TAGS) == 17 and sum(p == -1 for p in polarity.values()) == 10
    assert polarity["substitution_modification"] == 0


def test_active_users(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4, "user_id string")
    assert [tuple(r) for r in ta.active_users(df).collect()] == [("a", 5)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, how, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", 1)
    monkeypatch.setattr(skew, "MAX_HOT", 30)
    big = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', string(id % 40)) as k", "id")
    small = spark.range(45).selectExpr("string(id) as k", "id as v").union(
        spark.createDataFrame([("hot", 1), ("hot", 2)], "k string, v bigint")
    )
    hot = skew.hot_keys(big.groupBy("k").agg(F.count("*").alias("n")), "k", "n")
    assert hot.where("k = 'hot'").first()._slices >= 10 and hot.count() <= 30
    got = skew.salted_join(big, small, "k", hot, ["id"], how)
    assert sorted(map(str, got.collect())) == sorted(map(str, big.join(small, "k", how).collect()))


def test_hot_keys_are_cut_by_size_too(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", 1)
    counts = spark.createDataFrame([("a", 400), ("b", 90), ("c", 510)], "k string, n long")
    monkeypatch.setattr(skew, "MAX_HOT", 2)
    assert [tuple(r) for r in skew.hot_keys(counts, "k", "n").collect()] == [("c", 2)]
    monkeypatch.setattr(skew, "SLICE_ROWS", 100)
    assert sorted(tuple(r) for r in skew.hot_keys(counts, "k", "n").collect()) == [("a", 4), ("c", 6)]


@pytest.mark.parametrize("rows", [200_000, 0])
def test_rows_without_a_key_are_dealt_out(spark, monkeypatch, rows):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", rows)
    big = spark.range(2000).selectExpr("if(id % 2 = 0, null, string(id % 10)) AS k", "id")
    small = spark.createDataFrame([(None, -1), ("1", 1), ("3", 3)], "k string, v long")
    hot = skew.hot_keys(big.groupBy("k").agg(F.count("*").alias("n")), "k", "n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = skew.salted_join(big, small, "k", hot, ["id"], "left")
        sizes = [r["count"] for r in got.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
        want = big.join(small, "k", "left")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 1000 and max(sizes) < 300


def test_bounded_broadcast(spark):
    df = spark.range(10)
    assert skew.bounded_broadcast(df, 9) is df
    plan = df.join(skew.bounded_broadcast(df, 10), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan
    wide = spark.range(10).selectExpr("id", "array_repeat(1.0D, 1000) v", "repeat('x', 50) s", "named_struct('a', 1) t")
    assert skew.fits_broadcast(wide) and not skew.fits_broadcast(wide, max_bytes=80_000)
    assert skew.fits_broadcast(wide.limit(0), max_bytes=0)


def test_keyed_join_beyond_the_broadcast(spark, monkeypatch):
    facts = spark.range(500).selectExpr("id", "if(id < 400, 1, id) AS k")
    dimension = spark.range(500).selectExpr("id AS k", "id * 2 AS v")
    small = sorted(map(str, skew.keyed_join(facts, dimension, "k", ["id"]).select("id", "k", "v").collect()))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(skew, "MIN_ROWS", 20)
    large = skew.keyed_join(facts, dimension, "k", ["id"]).select("id", "k", "v")
    assert sorted(map(str, large.collect())) == small and len(small) == 500


# --- ranked lists ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lists(spark):
    ranked = [("a", f"i{n}", n) for n in range(1, 6)] + [("b", "i1", 1), ("b", "out", 2), ("c", "i9", 1)]
    truth = [("a", "i1", 5.0), ("a", "i1", 4.0), ("a", "i3", 4.0), ("a", "i4", 3.0), ("b", "i7", 5.0), ("d", "i1", 5.0)]
    return (
        spark.createDataFrame(ranked, "user_id string, recipe_id string, rank int"),
        spark.createDataFrame(truth, "user_id string, recipe_id string, rating double"),
    )


def test_ndcg(lists):
    got = {r.user_id: r.ndcg for r in ev.ndcg(*lists).collect()}
    assert got == {"a": pytest.approx((1 + 1 / 2) / (1 + 1 / np.log2(3))), "b": 0.0, "c": 0.0}


def test_precision_at_1(lists):
    assert ev.precision_at_1(*lists).first()[0] == pytest.approx(1 / 3)


def test_coverage(spark, lists):
    catalogue = spark.createDataFrame([(f"i{n}",) for n in range(1, 11)], "recipe_id string")
    assert ev.coverage(lists[0], catalogue).first()[0] == pytest.approx(0.6)


def test_tag_diversity(spark, lists):
    items = spark.createDataFrame([("i1", 1.0, 0.0), ("i2", 0.0, 1.0)], "recipe_id string, pred_a double, pred_b double")
    got = {r.user_id: r.diversity for r in ev.tag_diversity(lists[0], items).collect()}
    assert got == {"a": pytest.approx(1.0), "b": 0.0, "c": 0.0}


def test_score_of_a_vector_without_length(spark):
    """A user with equal ratings has no cosine; one without a profile scores 0 in any case."""
    from math import isnan

    candidates = spark.createDataFrame([("flat", "i"), ("new", "i"), ("own", "i")], "user_id string, recipe_id string")
    profiles = spark.createDataFrame([("flat", [0.0, 0.0]), ("own", [1.0, 0.0])], "user_id string, affinity array<double>")
    items = spark.createDataFrame([("i", 2.0, 0.0)], "recipe_id string, intensity_a double, intensity_b double")
    plain = {r.user_id: r.affinity_score for r in ta.affinity_scores(candidates, profiles, items).collect()}
    assert plain == {"flat": 0.0, "new": 0.0, "own": 1.0}
    scores = ta.affinity_scores(candidates, profiles, items, no_length=float("nan"))
    got = {r.user_id: r.affinity_score for r in scores.collect()}
    assert isnan(got.pop("flat")) and got == {"new": 0.0, "own": 1.0}


def test_reviews_are_read_once(spark, monkeypatch):
    """Profiles need the reviews' latest time and their rows; the given reviews, a join at that, are run once for both."""
    staged, plain = [], ta.stage
    monkeypatch.setattr(ta, "stage", lambda df, label: staged.append(label) or plain(df, label))
    day = datetime(2024, 1, 1)
    reviews = spark.createDataFrame([("u", "i", 5.0, day), ("u", "i", 1.0, day), ("u", "j", 3.0, day)], "user_id string, recipe_id string, rating double, ts timestamp")
    items = spark.createDataFrame([("i", 2, 1.0), ("j", 1, 0.5)], "recipe_id string, review_count bigint, intensity_a double")
    weights = spark.createDataFrame([("a", 0.5, 2.0)], "tag string, prevalence double, idf double")
    row = ta.affinity_vectors(reviews, items, weights).first()
    assert (row.n_reviews, row.mean_rating, row.affinity) == (3, 3.0, [0.0]) and "weighted-reviews" in staged
