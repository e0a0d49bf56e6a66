"""Reviews to item level: mean rating, tag proportions and intensities, smoothed rating."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from savora.functions.columns import normalised_id, tag_names
from savora.session import stage


def review_totals(labels: DataFrame, item: str = "recipe_id", rating: str = "rating") -> DataFrame:
    """One row per item from one pass over the reviews.

    ``pred_t`` is the share of reviews with tag t, ``intensity_t`` the mean ``sim_t`` where
    ``pred_t`` is 1. Missing values leave the denominator; an empty mean is 0. Every aggregate is a
    sum or a count, so Spark combines them before the shuffle and a hot item costs one row per task.
    """
    tags = sorted(tag_names(labels.columns))

    def mean(column: Column) -> Column:
        return F.coalesce(F.avg(column.cast("double")), F.lit(0.0))

    return labels.groupBy(F.col(item).cast("string").alias(item)).agg(
        mean(F.col(rating)).alias("raw_mean_rating"),
        F.count(rating).alias("review_count"),
        F.sum(F.col(rating).cast("double")).alias("_rating_sum"),
        *(mean(F.col(f"pred_{t}")).alias(f"pred_{t}") for t in tags),
        *(
            mean(F.when(F.col(f"pred_{t}") == 1, F.col(f"sim_{t}"))).alias(f"intensity_{t}")
            for t in tags
        ),
    )


def global_mean_rating(totals: DataFrame) -> DataFrame:
    """Mean over all reviews (not over items), from the per-item sums."""
    return totals.agg(
        F.try_divide(F.sum("_rating_sum"), F.sum("review_count")).alias("global_mean_rating")
    )


def count_threshold(totals: DataFrame, p: float = 0.25) -> DataFrame:
    """The p-quantile of the review counts, interpolated.

    The aggregate's buffer holds distinct counts only. With N reviews there are at most sqrt(2N).
    """
    return totals.agg(F.percentile("review_count", p).alias("count_threshold"))


def smoothed_rating(mean: Column, count: Column, global_mean: Column, threshold: Column) -> Column:
    """Bayesian average: few reviews are pulled towards the global mean."""
    return F.try_divide(count * mean + threshold * global_mean, count + threshold)


def bayesian_rating(
    df: DataFrame,
    global_mean: Column,
    rating: str = "raw_mean_rating",
    count: str = "review_count",
    threshold: float | None = None,
) -> Column:
    """Smoothed rating of ``df``'s rows; without a threshold, the 25th percentile of ``count``."""
    m = (
        F.lit(float(threshold))
        if threshold is not None
        else df.agg(F.percentile(count, 0.25).alias("m")).scalar()
    )
    return smoothed_rating(F.col(rating), F.col(count), global_mean, m)


def has_signal(df: DataFrame) -> Column:
    """True where at least one tag was seen. A table without tags has no such row."""
    shares = [F.col(f"pred_{t}") for t in tag_names(df.columns)]
    return reduce(add, shares) > 0 if shares else F.lit(False)


def recipe_level(
    labels: DataFrame,
    item: str = "recipe_id",
    rating: str = "rating",
    threshold: float | None = None,
    normalise_first: bool = False,
    keep_all: bool = False,
) -> DataFrame:
    """Item-level features with the smoothed rating, for items with at least one tag.

    Global mean and threshold come from all items, before the tag filter. The per-item totals are
    staged, so reviews are read once although three results depend on them. Ids are grouped as they
    stand ("38" and "38.0" are two groups) unless ``normalise_first``.
    """
    if normalise_first:
        labels = labels.withColumn(item, normalised_id(F.col(item)))
    totals = stage(review_totals(labels, item, rating), "review-totals")
    smoothed = bayesian_rating(totals, global_mean_rating(totals).scalar(), threshold=threshold)
    tags = sorted(tag_names(totals.columns))
    out = totals.select(
        item,
        "raw_mean_rating",
        "review_count",
        smoothed.alias("bayesian_rating"),
        *(f"pred_{t}" for t in tags),
        *(f"intensity_{t}" for t in tags),
    )
    return out if keep_all else out.where(has_signal(out))
