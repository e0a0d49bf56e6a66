"""What users like: tag weights, affinity vectors from review history, affinity scores.

The source of these features names them without formulas; the formulas are this package's, with
every constant a parameter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from savora.functions.columns import cosine, dot, tag_names
from savora.plans.skew import hot_keys, salted_join
from savora.session import stage

DAY_MICROS = 86_400_000_000


def tag_sums(labels: DataFrame) -> DataFrame:
    """``tag, n, total``: labelled reviews and positive ones; the sums of parts of the reviews add up."""
    tags = tag_names(labels.columns)
    if not tags:
        return labels.sparkSession.createDataFrame([], "tag string, n bigint, total double")
    counted = labels.agg(
        F.array(
            *(
                F.struct(
                    F.lit(t).alias("tag"),
                    F.count(f"pred_{t}").alias("n"),
                    F.coalesce(F.sum(F.col(f"pred_{t}").cast("double")), F.lit(0.0)).alias("total"),
                )
                for t in tags
            )
        ).alias("rows")
    )
    return counted.select(F.inline("rows"))


def weights_of(sums: DataFrame) -> DataFrame:
    """Per tag of :func:`tag_sums`: prevalence over the reviews and ``idf = ln(1/prevalence)``, 0 for an unseen tag."""
    share = F.try_divide(F.sum("total"), F.sum("n")).alias("prevalence")
    idf = F.when(F.col("prevalence") > 0, -F.log("prevalence")).otherwise(F.lit(0.0))
    return sums.groupBy("tag").agg(share).withColumn("idf", idf)


def tag_weights(labels: DataFrame) -> DataFrame:
    """Per tag: prevalence over the reviews and ``idf = ln(1/prevalence)``, 0 for an unseen tag."""
    return weights_of(tag_sums(labels))


def with_polarity(tags: DataFrame, polarity: Mapping[str, int]) -> DataFrame:
    """Add +1, 0 or -1 per tag; a tag without entry counts as neutral. One row per known tag is broadcast."""
    dimension = tags.sparkSession.createDataFrame(list(polarity.items()), "tag string, polarity int")
    return tags.join(F.broadcast(dimension), "tag", "left").withColumn(
        "polarity", F.coalesce("polarity", F.lit(0))
    )


def net_sentiment(tags: Sequence[str], polarity: Mapping[str, int]) -> Column:
    """Mean intensity of the positive tags minus mean intensity of the negative ones."""

    def mean(sign: int) -> Column:
        columns = [F.col(f"intensity_{t}") for t in tags if polarity.get(t, 0) == sign]
        return sum(columns, F.lit(0.0)) / F.lit(float(max(len(columns), 1)))

    return mean(1) - mean(-1)


SUMS = ["_n", "_sum_r", "_sum_w", "_sum_wr"]


def review_sums(
    reviews: DataFrame,
    half_life_days: float = 365.0,
    user: str = "user_id",
    item: str = "recipe_id",
    rating: str = "rating",
    ts: str = "ts",
) -> DataFrame:
    """What :func:`affinity_from_sums` needs of the reviews, one row per (user, item).

    The weight of a review is ``w = 0.5 ** (age / half_life)``, its age counted back from the latest review, whose time in
    microseconds is in ``latest``. Reviews without a rating do not count.
    """
    rows, latest = _weighted(reviews, half_life_days, user, item, rating, ts)
    return (
        rows.groupBy(user, item)
        .agg(
            F.count("*").alias("_n"),
            F.sum("_r").alias("_sum_r"),
            F.sum("_w").alias("_sum_w"),
            F.sum(F.col("_w") * F.col("_r")).alias("_sum_wr"),
            F.min("_r").alias("_lo"),
            F.max("_r").alias("_hi"),
        )
        .withColumn("latest", latest)
    )


def _weighted(reviews: DataFrame, half_life_days: float, user: str, item: str, rating: str, ts: str) -> tuple[DataFrame, Column]:
    """``(user, item, _r, _w)`` of rated reviews, read once, and the time of the latest review in microseconds."""
    micros = F.unix_micros(F.col(ts).cast("timestamp")).alias("_micros")
    given = reviews.select(F.col(user), F.col(item).cast("string").alias(item), F.col(rating).cast("double").alias("_r"), micros)
    given = stage(given, "weighted-reviews")
    latest = given.agg(F.max("_micros").alias("latest")).scalar()
    age_days = (latest - F.col("_micros")).cast("double") / F.lit(float(DAY_MICROS))
    w = F.pow(F.lit(0.5), age_days / F.lit(float(half_life_days)))
    return given.where(F.col("_r").isNotNull()).select(user, item, "_r", w.alias("_w")), latest


def merged_sums(
    old: DataFrame, new: DataFrame, half_life_days: float = 365.0, user: str = "user_id", item: str = "recipe_id"
) -> DataFrame:
    """The :func:`review_sums` of all reviews from those of two parts of them.

    Each part's weights fade by the time from its latest review to the latest of both.
    """
    both = old.unionByName(new)
    latest = both.agg(F.max("latest").alias("latest")).scalar()
    fade = F.pow(F.lit(0.5), (latest - F.col("latest")).cast("double") / F.lit(float(DAY_MICROS * half_life_days)))
    faded = both.withColumns({c: F.col(c) * fade for c in ("_sum_w", "_sum_wr")})
    sums = (F.sum(c).alias(c) for c in SUMS)
    merged = faded.groupBy(user, item).agg(*sums, F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    return merged.withColumn("latest", latest)


def affinity_vectors(
    reviews: DataFrame,
    items: DataFrame,
    weights: DataFrame,
    half_life_days: float = 365.0,
    user: str = "user_id",
    item: str = "recipe_id",
    rating: str = "rating",
    ts: str = "ts",
) -> DataFrame:
    """Per user ``(user, n_reviews, mean_rating, affinity)`` of :func:`affinity_from_sums`.

    Users seldom review an item twice, so the reviews are joined as they are, not summed by user and item first.
    """
    return affinity_from_sums(_weighted(reviews, half_life_days, user, item, rating, ts)[0], items, weights, user, item)


def affinity_from_sums(
    pairs: DataFrame, items: DataFrame, weights: DataFrame, user: str = "user_id", item: str = "recipe_id"
) -> DataFrame:
    """Per user ``(user, n_reviews, mean_rating, affinity)``, one entry per tag in name order.

    ``affinity_t = idf_t * sum(w * (rating - mean_user) * intensity_t) / sum(w)`` with the weights of
    :func:`review_sums`.

    The sum is split into ``sum(w*r*s) - mean_user * sum(w*s)``, so the user mean needs no pass of
    its own. What is joined with the item table is one row per (user, item), and hot items are cut into
    slices. ``items`` holds one row per item with ``review_count`` and ``intensity_*``; reviews of items that
    are not in it still count for ``n_reviews`` and the mean. ``pairs`` are :func:`review_sums` or single reviews
    ``(user, item, _r, _w)``.
    """
    tags = sorted(c.removeprefix("intensity_") for c in items.columns if c.startswith("intensity_"))
    strength = items.select(
        F.col(item).cast("string").alias(item), *(f"intensity_{t}" for t in tags)
    )
    hot = hot_keys(items.select(F.col(item).cast("string").alias(item), "review_count"), item, "review_count")
    single = "_n" not in pairs.columns
    joined = salted_join(pairs, strength, item, hot, [user, *(["_r", "_w"] if single else [])], "left")
    if single:
        r, w = F.col("_r"), F.col("_w")
        joined = joined.withColumns({"_n": F.lit(1), "_sum_r": r, "_sum_w": w, "_sum_wr": w * r, "_lo": r, "_hi": r})

    def weighted(total: str, t: str) -> Column:
        return F.sum(F.col(total) * F.coalesce(F.col(f"intensity_{t}"), F.lit(0.0)))

    sums = joined.groupBy(user).agg(
        F.sum("_n").alias("n_reviews"),
        (F.sum("_sum_r") / F.sum("_n")).alias("mean_rating"),
        (F.min("_lo") == F.max("_hi")).alias("_flat"),
        F.sum("_sum_w").alias("_w"),
        *(weighted("_sum_wr", t).alias(f"_wr_{t}") for t in tags),
        *(weighted("_sum_w", t).alias(f"_ws_{t}") for t in tags),
    )
    idf = weights.agg(F.map_from_entries(F.collect_list(F.struct("tag", "idf"))).alias("m")).scalar()

    def entry(t: str) -> Column:
        deviation = (F.col(f"_wr_{t}") - F.col("mean_rating") * F.col(f"_ws_{t}")) / F.col("_w")
        # With equal ratings every deviation is 0; keep float noise out of the later cosine.
        deviation = F.when(F.col("_flat"), F.lit(0.0)).otherwise(deviation)
        return F.coalesce(idf[t], F.lit(0.0)) * deviation

    return sums.select(
        user, "n_reviews", "mean_rating", F.array(*map(entry, tags)).alias("affinity")
    )


def active_users(
    reviews: DataFrame, min_reviews: int = 5, user: str = "user_id", rating: str = "rating"
) -> DataFrame:
    """Users with enough rated reviews for collaborative filtering."""
    rated = reviews.where(F.col(rating).isNotNull()) if rating in reviews.columns else reviews
    return (
        rated.groupBy(user)
        .agg(F.count("*").alias("n_reviews"))
        .where(F.col("n_reviews") >= min_reviews)
    )


def intensity_vector(items: DataFrame) -> Column:
    return F.array(*(F.col(c) for c in sorted(items.columns) if c.startswith("intensity_")))


def affinity_scores(
    candidates: DataFrame,
    profiles: DataFrame,
    items: DataFrame,
    user: str = "user_id",
    item: str = "recipe_id",
    no_length: float = 0.0,
) -> DataFrame:
    """Add ``affinity_score``: cosine of the user's affinity and the item's intensities.

    Users without a profile get 0 (cold start), and a vector without length, which has no cosine, gets ``no_length``.
    Candidates under a hot user or item are cut into slices.
    """
    vectors = items.select(F.col(item), intensity_vector(items).alias("_strength"))
    tastes = profiles.select(user, "affinity")

    def heavy(key: str) -> DataFrame:
        return hot_keys(candidates.groupBy(key).agg(F.count("*").alias("n")), key, "n")

    joined = salted_join(candidates, tastes, user, heavy(user), [item], "left")
    joined = salted_join(joined, vectors, item, heavy(item), [user], "left")
    taste, strength = F.col("affinity"), F.col("_strength")
    score = F.coalesce(cosine(taste, strength), F.lit(0.0))
    if no_length != 0.0:
        score = F.when((dot(taste, taste) == 0) | (dot(strength, strength) == 0), F.lit(no_length)).otherwise(score)
    return joined.withColumn("affinity_score", score).drop("affinity", "_strength")


def with_cold_start(candidates: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join known affinity scores; where there is none, 0."""
    return candidates.join(scores.select(*keys, "affinity_score"), list(keys), "left").withColumn(
        "affinity_score", F.coalesce("affinity_score", F.lit(0.0))
    )
