"""Whole jobs: preprocess, train, score, index, profile, search and recommend."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from savora.functions.columns import ablate, cosine
from savora.operators import features as ft
from savora.operators import ranking_eval as ev
from savora.operators.cofilter import item_similarities, pair_ratings, recommend_from_neighbours
from savora.operators.fit import RatingModel, fit_rating_model, with_item_vectors
from savora.operators.merge import merge, validate_merge
from savora.operators.metrics import evaluate, output_profile
from savora.operators.nearest import rank_per, session_neighbours, top_k_cosine
from savora.operators.network import read_weights, score_corpus
from savora.operators.reviews import recipe_level
from savora.operators.search import (
    Index,
    bm25,
    bm25_top,
    postings,
    quality,
    query_terms,
    rank_by_mode,
    read_index,
    write_index,
)
from savora.operators.split import split_by_time, split_exact
from savora.operators.taste import (
    active_users,
    affinity_from_sums,
    affinity_scores,
    affinity_vectors,
    merged_sums,
    net_sentiment,
    review_sums,
    tag_sums,
    tag_weights,
    weights_of,
)
from savora.plans.skew import bounded_broadcast, fits_broadcast, keyed_join, never_broadcast
from savora.session import scratch, stage
from savora.settings import Settings
from savora.sources.tables import (
    is_written,
    load_inputs,
    numbered_folders,
    write_mapping,
    write_metrics,
    write_table,
)


def preprocess(spark: SparkSession, settings: Settings, overwrite: bool = False) -> DataFrame:
    """Inputs to training table; writes search table, training table and feature numbering.

    A training table that is already there is returned as it is, and nothing is rewritten.
    """
    if not overwrite and is_written(spark, settings.processed_recipes_path):
        return spark.read.parquet(settings.processed_recipes_path)
    items, _, labels = load_inputs(spark, settings)
    with scratch(spark):
        level = stage(recipe_level(labels), "recipe-level")
        validate_merge(items, level)
        # Read by the search table, the scaling statistics, both vocabularies and the training table.
        merged = stage(merge(items, level), "merged")
        write_table(ft.search_table(merged), settings.recipes_path)
        training = training_table(merged, settings.top_n)
        write_mapping(ft.column_mapping(training), settings.column_mapping_path)
        write_table(training, settings.processed_recipes_path)
    return spark.read.parquet(settings.processed_recipes_path)


def training_table(merged: DataFrame, top_n: int = 100) -> DataFrame:
    """Scaled columns and token indicators."""
    scaled = ft.scale(merged, ft.standard_columns(merged), ft.minmax_columns(merged))
    for column, prefix in (("tags_clean", "cat"), ("ingredients_clean", "ing")):
        scaled = ft.with_indicators(scaled, column, prefix, ft.vocabulary(merged, column, top_n))
    return scaled


@dataclass(frozen=True)
class TrainingRun:
    model: RatingModel
    metrics: DataFrame
    sizes: DataFrame
    report: DataFrame | None = None
    predictions: DataFrame | None = None


def train(
    spark: SparkSession,
    settings: Settings,
    overwrite: bool = False,
    ablation: str = "all_features",
    report: bool = False,
    skip_scoring: bool = False,
) -> TrainingRun:
    """Preprocess, split, fit, test, store the metrics and the model, and then score the corpus with it.

    The stored predictions are ``recipe_id, recipe_name, target, prediction, embedding``; the last are the
    item vectors. :func:`score` is for the stored weights of a network.
    """
    table = preprocess(spark, settings, overwrite)
    groups = ft.feature_groups(table.columns, settings.numeric_features)
    write_mapping(ft.feature_index(table, groups), settings.feature_index_path)
    rows = ablate(ft.assemble(table, groups), ablation)
    parts = stage(split_exact(rows, fractions=settings.split_fractions, seed=settings.seed), "splits")
    train_rows, val_rows, test_rows = (
        parts.where(F.col("split") == s) for s in ("train", "val", "test")
    )
    model = fit_rating_model(train_rows, val_rows, settings.reg_params, settings.loss)
    tried = model.history.orderBy("reg_param").collect()  # one row per setting
    metrics = evaluate(model.predict(test_rows)).select(
        F.lit("linear_logit").alias("model_type"),
        F.lit(ablation).alias("ablation_type"),
        F.lit(settings.loss).alias("loss_type"),
        F.array(*(F.lit(r.reg_param) for r in tried)).alias("reg_param"),
        F.array(*(F.lit(r.validation_loss) for r in tried)).alias("val_loss"),
        F.col("mse").alias("test_mse"),
        F.col("rmse").alias("test_rmse"),
        F.col("mae").alias("test_mae"),
    )
    write_metrics(metrics, settings.results_path)
    model.save(settings.model_path)
    predictions = None
    if not skip_scoring:
        scored = with_item_vectors(model.predict(rows), settings.hidden_dim)
        columns = ("recipe_id", F.col("name").alias("recipe_name"), "target", "prediction", "embedding")
        write_table(scored.select(*columns), settings.predictions_path)
        predictions = spark.read.parquet(settings.predictions_path)
    return TrainingRun(
        model,
        metrics,
        parts.groupBy("split").agg(F.count("*").alias("n")),
        ft.feature_report(table) if report else None,
        predictions,
    )


def score(
    spark: SparkSession,
    settings: Settings,
    weights_path: str | None = None,
    head: str | None = None,
    output_path: str | None = None,
    batch_size: int | None = None,
    overwrite: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Score every item with stored weights and store the bundle; returns it and its profile."""
    weights_path = weights_path or settings.weights_path
    output_path = output_path or settings.embeddings_path
    table = preprocess(spark, settings, overwrite)
    if not is_written(spark, weights_path):
        raise FileNotFoundError(f"no weights at {weights_path}")
    groups = ft.feature_groups(table.columns, settings.numeric_features)
    bundle = score_corpus(
        ft.assemble(table, groups),
        read_weights(spark.read.parquet(weights_path)),
        len(groups.numeric),
        len(groups.categorical),
        len(groups.tag),
        head or settings.head,
        settings.hidden_dim,
        batch_size=batch_size or settings.batch_size,
    )
    write_table(bundle, output_path)
    stored = spark.read.parquet(output_path)
    return stored, output_profile(stored)


def user_profiles(
    reviews: DataFrame, level: DataFrame, settings: Settings, path: str | None = None
) -> DataFrame:
    """Affinity vectors with review count and mean rating per user, stored if a path is given."""
    profiles = affinity_vectors(
        reviews, level, tag_weights(reviews), settings.recency_half_life_days
    )
    if path is None:
        return profiles
    write_table(profiles, path)
    return reviews.sparkSession.read.parquet(path)


def grow_profiles(
    reviews: DataFrame, level: DataFrame, settings: Settings, path: str | None = None
) -> DataFrame:
    """Affinity vectors of all reviews so far, reading only the new ``reviews`` and stored sums.

    Each run stores the sums per user and item, and per tag, in a numbered folder of its own; the newest finished
    one is the next run's start. ``level`` describes all items as of now. A review must be given once.
    """
    spark = reviews.sparkSession
    path = path or settings.profile_sums_path
    done = [n for n in numbered_folders(spark, path) if is_written(spark, f"{path}/{n}/tags")]
    pairs, tags = review_sums(reviews, settings.recency_half_life_days), tag_sums(reviews)
    if done:
        pairs = merged_sums(spark.read.parquet(f"{path}/{done[-1]}/pairs"), pairs, settings.recency_half_life_days)
        tags = spark.read.parquet(f"{path}/{done[-1]}/tags").unionByName(tags)
        tags = tags.groupBy("tag").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    now = f"{path}/{max(numbered_folders(spark, path), default=-1) + 1}"
    write_table(pairs, f"{now}/pairs")
    write_table(tags, f"{now}/tags")  # last: a run without it does not count
    return affinity_from_sums(spark.read.parquet(f"{now}/pairs"), level, weights_of(spark.read.parquet(f"{now}/tags")))


def index(items: DataFrame, settings: Settings, text: str = "text") -> None:
    """Store the full-text index of ``recipe_id`` and ``text``, for :func:`search` to read."""
    with scratch(items.sparkSession):
        write_index(stage(postings(items, "recipe_id", text), "postings"), settings.index_path)


def _item_signals(items: DataFrame, tags, polarity) -> DataFrame:
    return items.select(
        "recipe_id",
        "name",
        quality(F.col("bayesian_rating")).alias("quality"),
        net_sentiment(tags, polarity).alias("tag"),
    )


def search(
    queries: DataFrame,
    items: DataFrame,
    mode: str = "hybrid",
    top_k: int | None = None,
    settings: Settings = Settings(),
    index: DataFrame | Index | str | None = None,
    profiles: DataFrame | None = None,
    text: str = "text",
) -> DataFrame:
    """``(query_id, rank, recipe_id, name, score)`` for a batch of queries.

    ``queries`` holds ``query_id, text`` and, for modes with the semantic signal, ``vector``; with
    ``user_id`` and ``profiles`` the user's affinity joins in, otherwise it is 0. ``items`` holds
    ``recipe_id, name, text, bayesian_rating, pred_*, intensity_*`` and, for the semantic signal,
    ``embedding``. Candidates are the BM25 pool, or the nearest vectors in ``semantic`` mode. ``index`` are
    postings, a stored index or its path, of which only the buckets of the queries' terms are read.
    """
    top_k = settings.default_top_k if top_k is None else top_k
    pool = settings.candidate_pool_size
    tags = sorted(c.removeprefix("intensity_") for c in items.columns if c.startswith("intensity_"))
    if mode == "semantic":
        hits = top_k_cosine(queries, items, pool).select(
            "query_id", "recipe_id", F.col("score").alias("semantic")
        )
    elif index is None:
        hits = bm25(items, queries, pool, doc_id="recipe_id", text=text).select(
            "query_id", F.col("doc_id").alias("recipe_id"), "lexical"
        )
    else:
        wanted = query_terms(queries)
        if isinstance(index, str):
            index = read_index(queries.sparkSession, index, wanted)
        hits = bm25_top(index, wanted, pool).select(
            "query_id", F.col("doc_id").alias("recipe_id"), "lexical"
        )
    # At most ``pool`` rows per query.
    hits = stage(hits, "hits")
    # What has a row for each hit is no smaller than the hits.
    per_hit = (lambda df: df) if fits_broadcast(hits) else never_broadcast
    scored = keyed_join(hits, _item_signals(items, tags, settings.polarity), "recipe_id", ["query_id"])
    if mode == "hybrid":
        scored = scored.join(per_hit(_semantic_scores(hits, queries, items)), ["query_id", "recipe_id"])
    if mode in ("hybrid", "ablation_no_sem"):
        scored = scored.join(per_hit(_affinity(hits, queries, items, profiles)), ["query_id", "recipe_id"])
    scored = stage(scored, "signals")
    return rank_by_mode(scored, mode, top_k).select("query_id", "rank", "recipe_id", "name", "score")


def _semantic_scores(hits: DataFrame, queries: DataFrame, items: DataFrame) -> DataFrame:
    pairs = hits.select("query_id", "recipe_id").join(queries.select("query_id", "vector"), "query_id")
    both = keyed_join(pairs, items.select("recipe_id", "embedding"), "recipe_id", ["query_id"])
    return both.select(
        "query_id", "recipe_id", cosine(F.col("vector"), F.col("embedding")).alias("semantic")
    )


def _affinity(hits, queries, items, profiles) -> DataFrame:
    pairs = hits.select("query_id", "recipe_id")
    if profiles is None or "user_id" not in queries.columns:
        return pairs.withColumn("affinity", F.lit(0.0))
    named = pairs.join(queries.select("query_id", "user_id"), "query_id")
    scores = affinity_scores(named, profiles, items)
    return scores.select("query_id", "recipe_id", F.col("affinity_score").alias("affinity"))


# In the sum of reciprocal ranks a first place is worth 1 / (RANK_OFFSET + 1).
RANK_OFFSET = 60


def fuse_ranks(lists: list[DataFrame], top_k: int, user: str = "user_id", item: str = "recipe_id", places: int = 6) -> DataFrame:
    """``user, item, score, rank`` from several ranked lists by the sum of reciprocal ranks.

    The lists' scores need no common scale. A user who is in one list only keeps its order.
    """
    parts = [x.select(user, item, (F.lit(1.0) / (F.col("rank") + RANK_OFFSET)).alias("part")) for x in lists]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    fused = both.groupBy(user, item).agg(F.round(F.sum("part"), places).alias("score"))
    return rank_per(fused, user, item, "score", top_k)


def recommend(
    users: DataFrame,
    reviews: DataFrame,
    items: DataFrame,
    profiles: DataFrame,
    top_k: int | None = None,
    settings: Settings = Settings(),
    collaborative: bool = False,
) -> DataFrame:
    """``(user_id, rank, recipe_id, name, score)`` for a batch of users.

    All items a user has reviewed are the session, and are not recommended again; its nearest neighbours are
    ranked again by similarity, quality, tags and the user's affinity. Users for whom there are none, as all
    those without a review of a known item, get the best rated items.

    With ``collaborative``, users with at least ``settings.min_reviews_for_cf`` rated reviews also get a list from the
    item-item filter over all ``reviews``; both lists, whose scores have no common scale, are fused by rank, and
    ``score`` is that of :func:`fuse_ranks` for everyone with a list.
    ``items`` as in :func:`search`, with ``embedding``.
    """
    top_k = settings.default_top_k if top_k is None else top_k
    tags = sorted(c.removeprefix("intensity_") for c in items.columns if c.startswith("intensity_"))
    asked = reviews.join(bounded_broadcast(users.select("user_id").distinct()), "user_id", "left_semi")
    signals = _item_signals(items, tags, settings.polarity)
    with scratch(reviews.sparkSession):
        seeds = stage(asked.select("user_id", "recipe_id").distinct(), "seeds")
        near = session_neighbours(seeds, items, settings.n_neighbors, session_id="user_id")
        near = stage(near.select("user_id", "recipe_id", F.col("score").alias("semantic")), "near", keep=True)
    with scratch(reviews.sparkSession):
        warm = stage(affinity_scores(near, profiles, items), "warm")
        warm = keyed_join(warm, signals, "recipe_id", ["user_id"]).select(
            "*", F.col("affinity_score").alias("affinity"), F.lit(0.0).alias("lexical")
        )
        warm = stage(warm, "signals", keep=True)
    columns = ["user_id", "rank", "recipe_id", "name", "score"]
    if collaborative:
        listed = rank_by_mode(warm, "hybrid", settings.n_neighbors, query_id="user_id").select("user_id", "recipe_id", "rank")
        filtered = _collaborative(asked, reviews, items, settings)
        fused = stage(fuse_ranks([listed, filtered], top_k), "fused")
        ranked = keyed_join(fused, signals.select("recipe_id", "name"), "recipe_id", ["user_id"])
        served = fused.select("user_id")
    else:
        ranked = rank_by_mode(warm, "hybrid", top_k, query_id="user_id")
        served = warm.select("user_id")

    # The same top_k rows for every new user.
    best = (
        signals.select(F.round("quality", 6).alias("score"), "recipe_id", "name")
        .orderBy(F.desc("score"), "recipe_id")
        .limit(top_k)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "recipe_id", "name", "score"))).alias("best"))
    )
    new = users.select("user_id").distinct().join(served, "user_id", "left_anti")
    cold = (
        new.select("user_id", F.posexplode(best.scalar()).alias("pos", "item"))
        .select("user_id", (F.col("pos") + 1).alias("rank"), "item.recipe_id", "item.name", "item.score")
    )
    return ranked.select(*columns).unionByName(cold.select(*columns))


def _collaborative(asked: DataFrame, reviews: DataFrame, items: DataFrame, settings: Settings) -> DataFrame:
    """``user_id, recipe_id, rank`` of the item-item filter for the active users among ``asked``, stored.

    Similarities come from everyone's ratings of known items; ratings of the asked users alone are scored with them.
    """
    known = bounded_broadcast(items.select("recipe_id"))
    with scratch(reviews.sparkSession):
        pairs = stage(pair_ratings(reviews.join(known, "recipe_id", "left_semi")), "pair-ratings")
        neighbours = stage(item_similarities(pairs, settings.n_neighbors), "neighbours", keep=True)
    with scratch(reviews.sparkSession):
        active = active_users(asked, settings.min_reviews_for_cf).select("user_id")
        own = pair_ratings(asked.join(bounded_broadcast(stage(active, "active")), "user_id", "left_semi"))
        own = stage(own.join(known, "recipe_id", "left_semi"), "own-ratings")
        found = recommend_from_neighbours(own, neighbours, settings.n_neighbors, 0).select("user_id", "recipe_id", "rank")
        return stage(found, "filtered", keep=True)


def evaluate_recommender(
    reviews: DataFrame,
    items: DataFrame,
    settings: Settings = Settings(),
    share: float = 0.8,
    k: int = 5,
    collaborative: bool = False,
    store: bool = True,
) -> DataFrame:
    """One row ``ndcg, precision_at_1, diversity, coverage, n_users`` of recommendations made from earlier reviews.

    The first ``share`` of the time is the past. Item features, tag prevalences, profiles and neighbours come from
    it alone; every user with a later review is asked for, and later reviews are the truth. ``items`` holds
    ``recipe_id, name, text, embedding``; those without a review in the past cannot be recommended, but count
    as catalogue. The row is stored with the metrics.
    """
    parts = stage(split_by_time(reviews, "ts", share), "timed")
    past = parts.where("split = 'train'").drop("split")
    truth = stage(parts.where("split = 'test'").select("user_id", "recipe_id", "rating"), "truth")
    level = recipe_level(past.drop("user_id", "ts"))
    known = stage(merge(items.select("recipe_id", "name", "text", "embedding"), level), "known")
    profiles = stage(user_profiles(past, known, settings), "profiles")
    users = truth.select("user_id").distinct()
    found = stage(recommend(users, past, known, profiles, k, settings, collaborative), "recommended")
    row = (
        ev.ndcg(found, truth, k)
        .agg(F.avg("ndcg").alias("ndcg"), F.count("*").alias("n_users"))
        .withColumn("precision_at_1", ev.precision_at_1(found, truth).scalar())
        .withColumn("diversity", ev.tag_diversity(found, known, k).agg(F.avg("diversity").alias("diversity")).scalar())
        .withColumn("coverage", ev.coverage(found, items).scalar())
    )
    row = stage(row, "evaluated")
    if store:
        write_metrics(row, settings.evaluation_path)
    return row
