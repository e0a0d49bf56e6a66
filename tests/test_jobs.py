"""Whole jobs on a small made-up catalogue, and what their plans must not contain."""

import os
import time
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from savora.operators import features as ft
from savora.operators import fit
from savora.operators import network as nw
from savora.operators import reviews as rv
from savora.operators import taste as ta
from savora.plans import jobs, skew
from savora.session import scratch, shared_dir, stage
from savora.settings import NUMERIC_FEATURES, Settings
from savora.sources import adapters as ad

N_ITEMS = 120


@pytest.fixture(scope="module")
def settings(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("job"))
    rng = np.random.default_rng(0)
    words = ["easy", "low-fat", "30-minutes", "baked", "vegan"]
    items = [
        (i, f"dish {i}", " ".join(rng.choice(words, 2)), " ".join(rng.choice(["salt", "olive_oil", "egg"], 2)),
         int(rng.integers(1, 90)), int(rng.integers(1, 9)), int(rng.integers(1, 9)), *map(float, rng.uniform(0, 9, 7)))
        for i in range(N_ITEMS)
    ]
    kinds = ["bigint"] * 3 + ["double"] * 7
    schema = "recipe_id bigint, name string, tags_clean string, ingredients_clean string, " + ", ".join(
        f"{n} {k}" for n, k in zip(NUMERIC_FEATURES, kinds)
    )
    labels = []
    for n in range(2000):
        dry, hit = int(rng.uniform() < 0.2), int(rng.uniform() < 0.5)
        rating = float(np.clip(round(4 + hit - 2 * dry + rng.normal()), 1, 5))
        when = datetime(2024, 1, 1) + timedelta(days=int(rng.integers(700)))
        labels.append((str(int(rng.integers(N_ITEMS + 20))), f"u{rng.integers(50)}", when, rating, dry, float(rng.uniform()), hit, float(rng.uniform())))
    s = Settings(
        folder=base, raw_recipes_path=f"{base}/items", raw_reviews_path=f"{base}/reviews", gold_reviews_path=f"{base}/labels",
        recipes_path=f"{base}/search", processed_recipes_path=f"{base}/training", column_mapping_path=f"{base}/mapping",
        feature_index_path=f"{base}/index", weights_path=f"{base}/weights", embeddings_path=f"{base}/bundle",
        results_path=f"{base}/results", user_profiles_path=f"{base}/profiles", hidden_dim=8,
    )
    spark.createDataFrame(items, schema).write.parquet(s.raw_recipes_path)
    df = spark.createDataFrame(
        labels,
        "recipe_id string, user_id string, ts timestamp, rating double, "
        "pred_dry int, sim_dry double, pred_family_hit int, sim_family_hit double",
    )
    df.write.parquet(s.gold_reviews_path)
    df.select("recipe_id", "rating").write.parquet(s.raw_reviews_path)
    return s


def test_preprocess_reuses_what_is_there(spark, settings):
    table = jobs.preprocess(spark, settings)
    assert table.count() == N_ITEMS
    gone = replace(settings, raw_recipes_path="/nowhere", gold_reviews_path="/nowhere")
    assert jobs.preprocess(spark, gone).columns == table.columns
    with pytest.raises(Exception):
        jobs.preprocess(spark, gone, overwrite=True)
    search = spark.read.parquet(settings.recipes_path)
    assert dict(search.dtypes)["tags_clean"] == "array<string>" and dict(search.dtypes)["pred_dry"] == "boolean"
    assert search.agg(F.max("minutes")).first()[0] > 10, "the search table is not scaled"
    stats = table.agg(F.avg("minutes"), F.stddev_pop("minutes"), F.min("intensity_dry"), F.max("intensity_dry")).first()
    assert tuple(stats) == pytest.approx((0, 1, 0, 1), abs=1e-9)
    assert {"cat_low_fat", "cat_30_minutes", "ing_olive_oil"} <= set(table.columns)


def test_unfinished_table_is_not_reused(spark, settings, tmp_path):
    half = replace(settings, processed_recipes_path=str(tmp_path / "half"))
    (tmp_path / "half").mkdir()
    assert jobs.preprocess(spark, half).count() == N_ITEMS


def test_train_and_score(spark, settings):
    run = jobs.train(spark, settings, report=True)
    stored = run.predictions.orderBy("recipe_id").collect()
    assert len(stored) == N_ITEMS and {len(r.embedding) for r in stored} == {8}
    table = jobs.preprocess(spark, settings)
    rows = ft.assemble(table, ft.feature_groups(table.columns))
    again = fit.RatingModel.load(spark, settings.model_path).predict(rows).orderBy("recipe_id").collect()
    assert [r.prediction for r in stored] == pytest.approx([r.prediction for r in again])
    assert {r.split: r.n for r in run.sizes.collect()} == {"train": 84, "val": 18, "test": 18}
    assert run.model.history.where("chosen").count() == 1
    stored = spark.read.json(settings.results_path).first()
    assert stored.test_rmse == pytest.approx(stored.test_mse**0.5)
    assert 0 < stored.test_mse < 1, "better than a wild guess"
    assert run.report.count() > 10 and len(stored.val_loss) == 3
    with pytest.raises(FileNotFoundError):
        jobs.score(spark, settings)
    table = jobs.preprocess(spark, settings)
    groups = ft.feature_groups(table.columns)
    shapes = nw.parameter_shapes("residual_v2", 10, len(groups.categorical), len(groups.tag), 8)
    nw.weights_table(spark, nw.seeded_weights(shapes)).write.parquet(settings.weights_path)
    bundle, profile = jobs.score(spark, settings)
    assert bundle.count() == N_ITEMS
    row = profile.first()
    assert 1 <= row.min_prediction <= row.max_prediction <= 5 and (row["rows"], row.width) == (N_ITEMS, 8)


def test_regression_equals_least_squares(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 4))
    y = np.clip(3 + x @ [0.4, -0.3, 0.2, 0.0] + 0.1 * rng.normal(size=300), 1.2, 4.8)
    rows = [([float(a), float(b)], [float(c), float(d)], float(t)) for (a, b, c, d), t in zip(x, y)]
    df = spark.createDataFrame(rows, "meta array<double>, tag array<double>, target double")
    model = fit.fit_rating_model(df, df, (0.0, 5.0))
    assert [r.reg_param for r in model.history.where("chosen").collect()] == [0.0]
    design = np.c_[x, np.ones(300)]
    share = (y - 1) / 4
    coefficients, *_ = np.linalg.lstsq(design, np.log(share / (1 - share)), rcond=None)
    expected = 1 + 4 / (1 + np.exp(-design @ coefficients))
    got = {tuple(r.meta): r.prediction for r in model.predict(df).collect()}
    assert [got[tuple(r[0])] for r in rows] == pytest.approx(list(expected), abs=1e-4)


def test_item_vectors(spark, settings):
    table = jobs.preprocess(spark, settings)
    rows = ft.assemble(table, ft.feature_groups(table.columns))
    vectors = np.array([r.embedding for r in fit.item_vectors(rows, 5).collect()])
    assert vectors.shape == (N_ITEMS, 5)
    spread = vectors.var(axis=0)
    assert all(a >= b - 1e-6 for a, b in zip(spread, spread[1:])), "components come by falling variance"
    whole = np.array([r.meta + r.tag for r in rows.collect()])
    expected = np.linalg.eigvalsh(np.cov(whole.T))[::-1][:5]
    assert np.allclose(vectors.var(axis=0, ddof=1), expected, rtol=1e-3)


def test_search_and_recommend(spark, settings):
    labels = spark.read.parquet(settings.gold_reviews_path)
    level = rv.recipe_level(labels)
    names = spark.range(N_ITEMS).select(
        F.col("id").cast("string").alias("recipe_id"), F.concat(F.lit("dish "), F.col("id").cast("string")).alias("name"),
        F.array(F.cos("id"), F.sin("id")).alias("embedding"),
    )
    items = names.join(level, "recipe_id").withColumn("text", F.col("name")).cache()
    profiles = jobs.user_profiles(labels, level, settings, settings.user_profiles_path)
    queries = spark.createDataFrame(
        [(1, "dish 7", "u1", [1.0, 0.0]), (2, "DISH 9", "nobody", [0.0, 1.0])],
        "query_id int, text string, user_id string, vector array<double>",
    )
    for mode in ("lexical", "semantic", "quality", "hybrid", "ablation_no_sem"):
        got = jobs.search(queries, items, mode, 5, settings, profiles=profiles).orderBy("query_id", "rank").collect()
        assert [(r.query_id, r["rank"]) for r in got] == [(q, n) for q in (1, 2) for n in range(1, 6)]
        assert all(a.score >= b.score for a, b in zip(got, got[1:]) if a.query_id == b.query_id)
        if mode == "lexical":
            jobs.index(items, settings)
            stored = jobs.search(queries, items, mode, 5, settings, index=settings.index_path)
            assert sorted(map(str, stored.collect())) == sorted(map(str, got))
            assert [r.name for r in got if r["rank"] == 1] == ["dish 7", "dish 9"]
    # What "stray" has reviewed is in no table of items.
    strays = labels.limit(1).withColumns({"user_id": F.lit("stray"), "recipe_id": F.lit("unknown")})
    users = spark.createDataFrame([("u1",), ("u2",), ("nobody",), ("stray",)], "user_id string")
    got = jobs.recommend(users, labels.unionByName(strays), items, profiles, 4, settings).collect()
    assert sorted((r.user_id, r["rank"]) for r in got) == [
        (u, n) for u in ("nobody", "stray", "u1", "u2") for n in range(1, 5)
    ]
    cold = [sorted((r["rank"], r.recipe_id) for r in got if r.user_id == u) for u in ("nobody", "stray")]
    assert cold[0] == cold[1]
    reviewed = {(r.user_id, r.recipe_id) for r in labels.select("user_id", "recipe_id").distinct().collect()}
    assert not reviewed & {(r.user_id, r.recipe_id) for r in got if r.user_id in ("u1", "u2")}
    best = items.orderBy(F.desc(F.round((F.col("bayesian_rating") - 1) / 4, 6)), "recipe_id").limit(4).collect()
    assert [r.recipe_id for r in sorted((r for r in got if r.user_id == "nobody"), key=lambda r: r["rank"])] == [
        r.recipe_id for r in best
    ]


def catalogue(spark, labels):
    names = spark.range(N_ITEMS).select(
        F.col("id").cast("string").alias("recipe_id"), F.concat(F.lit("dish "), F.col("id").cast("string")).alias("name"),
        F.array(F.cos("id"), F.sin("id")).alias("embedding"),
    )
    return names.withColumn("text", F.col("name")), names.join(rv.recipe_level(labels), "recipe_id").withColumn("text", F.col("name"))


def test_profiles_grow_by_new_reviews(spark, settings, tmp_path):
    labels = spark.read.parquet(settings.gold_reviews_path)
    _, items = catalogue(spark, labels)
    whole = {r.user_id: r for r in jobs.user_profiles(labels, items, settings).collect()}
    # Parts in any order of time; the second is empty, and a run that did not end is passed over.
    parts = [labels.where("day(ts) < 9"), labels.where("false"), labels.where("day(ts) >= 20"), labels.where("day(ts) between 9 and 19")]
    for part in parts:
        got = jobs.grow_profiles(part, items, settings, str(tmp_path / "sums"))
        labels.limit(1).write.mode("overwrite").parquet(str(tmp_path / "sums" / "50" / "pairs"))
    got = {r.user_id: r for r in got.collect()}
    assert set(got) == set(whole)
    for user, r in got.items():
        assert r.n_reviews == whole[user].n_reviews and r.mean_rating == pytest.approx(whole[user].mean_rating)
        assert r.affinity == pytest.approx(whole[user].affinity, abs=1e-9)


def test_fused_ranks(spark):
    one = spark.createDataFrame([("u", "a", 1), ("u", "b", 2), ("v", "c", 1)], "user_id string, recipe_id string, rank int")
    two = spark.createDataFrame([("u", "b", 1), ("u", "d", 2), ("w", "e", 3)], "user_id string, recipe_id string, rank int")
    got = {(r.user_id, r["rank"]): (r.recipe_id, r.score) for r in jobs.fuse_ranks([one, two], 2).collect()}
    assert got == {
        ("u", 1): ("b", round(1 / 62 + 1 / 61, 6)), ("u", 2): ("a", round(1 / 61, 6)),
        ("v", 1): ("c", round(1 / 61, 6)), ("w", 1): ("e", round(1 / 63, 6)),
    }


def test_collaborative_lists_for_active_users_only(spark, settings):
    labels = spark.read.parquet(settings.gold_reviews_path)
    few = labels.where("user_id = 'u1'").orderBy("ts", "recipe_id").limit(4).withColumn("user_id", F.lit("few"))
    labels = labels.unionByName(few)
    _, items = catalogue(spark, labels)
    profiles = jobs.user_profiles(labels, items, settings)
    users = spark.createDataFrame([("u1",), ("few",), ("nobody",)], "user_id string")
    plain = jobs.recommend(users, labels, items, profiles, 20, settings).collect()
    fused = jobs.recommend(users, labels, items, profiles, 20, settings, collaborative=True).collect()

    def items_of(rows, user):
        return [r.recipe_id for r in sorted((r for r in rows if r.user_id == user), key=lambda r: r["rank"])]

    assert items_of(plain, "few") == items_of(fused, "few") and items_of(plain, "nobody") == items_of(fused, "nobody")
    assert items_of(plain, "u1") != items_of(fused, "u1") and len(set(items_of(fused, "u1"))) == 20
    seen = {r.recipe_id for r in labels.where("user_id = 'u1'").select("recipe_id").collect()}
    assert not seen & set(items_of(fused, "u1"))


def test_evaluation_uses_the_past_alone(spark, settings, tmp_path):
    labels = spark.read.parquet(settings.gold_reviews_path)
    everything, _ = catalogue(spark, labels)
    at = replace(settings, evaluation_path=str(tmp_path / "metrics"))
    row = jobs.evaluate_recommender(labels, everything, at).first()
    assert spark.read.json(at.evaluation_path).first().ndcg == pytest.approx(row.ndcg)
    assert 0 < row.ndcg < 1 and 0 <= row.precision_at_1 <= 1 and 0 < row.diversity <= 1 and 0 < row.coverage <= 1
    cut = labels.approxQuantile("rating", [0.5], 0.0)  # any number; what follows changes later reviews only
    later = sorted(r.ts for r in labels.select("ts").collect())[int(0.8 * 2000)]
    turned = labels.withColumn("pred_dry", F.when(F.col("ts") > later, 1 - F.col("pred_dry")).otherwise(F.col("pred_dry")))
    again = jobs.evaluate_recommender(turned, everything, at, store=False).first()
    assert cut and again == row, "tags of later reviews must not change what is recommended"
    both = jobs.evaluate_recommender(labels, everything, at, collaborative=True, store=False).first()
    assert both.n_users == row.n_users


def test_regularised_coefficients(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) * [1.0, 5.0, 0.1]
    y = np.clip(3 + x @ [0.4, -0.1, 2.0] + 0.1 * rng.normal(size=200), 1.2, 4.8)
    rows = [([float(a), float(b)], [float(c), 7.0, float(a)], float(t)) for (a, b, c), t in zip(x, y)]
    df = spark.createDataFrame(rows, "meta array<double>, tag array<double>, target double")
    model = fit.fit_rating_model(df, df, (0.3,))
    design = np.c_[x, np.full(200, 7.0), x[:, 0]]
    label = np.log((y - 1) / (5 - y))
    scaled = (design - design.mean(axis=0)) / np.where(design.std(axis=0) > 0, design.std(axis=0, ddof=1), 1)
    own = np.linalg.solve(scaled.T @ scaled / 199 + 0.3 * np.eye(5), scaled.T @ (label - label.mean()) / 199)
    expected = own / np.where(design.std(axis=0) > 0, design.std(axis=0, ddof=1), 1)
    assert list(model.coefficients) == pytest.approx(list(expected), abs=1e-8) and model.coefficients[3] == 0
    assert model.coefficients[0] == pytest.approx(model.coefficients[4])


def test_item_vectors_do_not_depend_on_signs(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 5)) * [5, 4, 3, 2, 1] + 10
    df = spark.createDataFrame([(i, [float(v) for v in r[:3]], [float(v) for v in r[3:]]) for i, r in enumerate(x)], "recipe_id int, meta array<double>, tag array<double>")
    got = np.array([r.embedding for r in fit.item_vectors(df, 128).orderBy("recipe_id").collect()])
    values, axes = np.linalg.eigh(np.cov(x.T))
    axes = axes[:, ::-1] * np.sign(axes[np.abs(axes).argmax(axis=0), range(5)])[::-1]
    assert np.allclose(got, (x - x.mean(axis=0)) @ axes, atol=1e-3)
    found = fit.explained_variance(df, 2).collect()
    assert [r.variance for r in found] == pytest.approx(list(values[::-1][:2]))
    assert sum(r.share for r in found) == pytest.approx(values[3:].sum() / values.sum())


# --- plans -----------------------------------------------------------------------------------


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.001"


def test_reviews_are_scanned_once_and_narrowly(spark, sf_dir):
    totals = plan(rv.review_totals(ad.labels(spark, sf_dir)))
    assert totals.count("FileScan") == 1 and "l_extendedprice" not in totals
    assert totals.count("Exchange hashpartitioning") == 1
    level = plan(rv.recipe_level(ad.labels(spark, sf_dir)))
    assert "lineitem" not in level, "after staging, the reviews are not read again"


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    reviews = ad.reviews(spark, sf_dir).where(F.col("rating") > 2).select("user_id", "rating")
    text = plan(reviews)
    assert "l_discount" not in text and "IsNotNull(l_orderkey)" in text


def test_no_window_without_partition(spark, sf_dir):
    lvl = rv.recipe_level(ad.labels(spark, sf_dir))
    profiles = ta.affinity_vectors(ad.reviews(spark, sf_dir), lvl, ta.tag_weights(ad.labels(spark, sf_dir)))
    text = plan(profiles)
    assert "Window" not in text and "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_scoring_does_not_shuffle(spark):
    df = spark.range(64, numPartitions=64).selectExpr(
        "string(id) recipe_id", "'n' name", "array(float(id)) meta", "array(float(id)) tag", "float(3) target"
    )
    weights = nw.seeded_weights(nw.parameter_shapes("shallow", 1, 0, 1, 4))
    assert "Exchange" not in plan(nw.score_corpus(df, weights, 1, 0, 1, "shallow", 4))


def test_large_tables_in_small_files_are_not_broadcast(spark):
    rows = spark.range(1_000_000, numPartitions=1).select("id", (F.pmod(F.xxhash64("id"), F.lit(100))).alias("n"))
    stored = stage(rows, "compressed")
    joined = plan(stored.join(stage(spark.range(5_000_000, numPartitions=1), "ids"), "id"))
    assert "SortMergeJoin" in joined and "BroadcastHashJoin" not in joined


def test_pairs_of_many_hits_are_joined_by_shuffle(spark, settings, monkeypatch):
    labels = spark.read.parquet(settings.gold_reviews_path)
    _, items = catalogue(spark, labels)
    queries = spark.createDataFrame([(1, "dish 7", [1.0, 0.0]), (2, "DISH 9", [0.0, 1.0])], "query_id int, text string, vector array<double>")
    plans = {}

    def recorded(df, label):
        plans[label] = plan(df)
        return stage(df, label)

    monkeypatch.setattr(jobs, "stage", recorded)
    expected = sorted(map(str, jobs.search(queries, items, "hybrid", 5, settings).collect()))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 50)
    assert sorted(map(str, jobs.search(queries, items, "hybrid", 5, settings).collect())) == expected
    assert plans["signals"].count("SortMergeJoin [query_id") == 2


def test_shuffle_files_go_with_their_job(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if "shuffle_" in files.apply(i).getName()}

    before = shuffled()
    stage(spark.range(10_000).repartition(5, "id"), "dealt")
    end = time.time() + 20
    while (left := shuffled() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left


def staged(spark):
    folder = shared_dir(spark).removeprefix("file:")
    return {name for name in os.listdir(folder) if os.path.isdir(f"{folder}/{name}")}


def test_tables_of_a_step_go_with_it(spark, settings):
    before = staged(spark)
    with scratch(spark):
        with scratch(spark):
            kept = stage(stage(spark.range(3), "inner"), "outer", keep=True)
        assert {name.rsplit("-", 1)[0] for name in staged(spark) - before} == {"outer"} and kept.count() == 3
    assert staged(spark) == before
    labels = spark.read.parquet(settings.gold_reviews_path)
    _, items = catalogue(spark, labels)
    users = spark.createDataFrame([("u1",), ("nobody",)], "user_id string")
    found = jobs.recommend(users, labels, items, jobs.user_profiles(labels, items, settings), 5, settings, collaborative=True)
    left = {name.rsplit("-", 1)[0] for name in staged(spark) - before}
    assert not left & {"seeds", "warm", "query-vectors", "pair-ratings", "packed-ratings", "own-ratings", "targets", "centred"}
    assert found.count() == 10
