"""Joining item metadata with review features, and checking that the two fit."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savora.functions.columns import named, normalised_id
from savora.plans.skew import grid_join

log = logging.getLogger(__name__)
LOW_OVERLAP = 100
NO_NUMBER = "0"  # the normalised id of all ids that are no numbers


def merge(items: DataFrame, features: DataFrame, on: str = "recipe_id") -> DataFrame:
    """Inner join on the normalised id; other shared names get ``_x`` (left) and ``_y`` (right).

    Spark picks broadcast or sort-merge from the sizes. Ids that are no numbers all become "0"; with n of them on
    one side and m on the other the result has n x m rows, which leave from a grid of tasks.
    """
    shared = (set(items.columns) & set(features.columns)) - {on}

    def prepared(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(
            *(
                normalised_id(named(c)).alias(c)
                if c == on
                else named(c).alias(c + suffix if c in shared else c)
                for c in df.columns
            )
        )

    return grid_join(prepared(items, "_x"), prepared(features, "_y"), on, NO_NUMBER)


def overlap(items: DataFrame, features: DataFrame, on: str = "recipe_id") -> DataFrame:
    """One row: how many distinct ids each side has, and how many both share."""

    def side(df: DataFrame, left: bool) -> DataFrame:
        return df.select(F.col(on).cast("string").alias("id"), F.lit(left).alias("is_left"))

    # One grouping of both id lists; the ids collapse before the shuffle.
    seen = (
        side(items, True)
        .unionByName(side(features, False))
        .where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.bool_or("is_left").alias("l"), F.bool_or(~F.col("is_left")).alias("r"))
    )
    return seen.agg(
        F.count_if("l").alias("left_ids"),
        F.count_if("r").alias("right_ids"),
        F.count_if(F.col("l") & F.col("r")).alias("shared_ids"),
    )


def validate_merge(items: DataFrame, features: DataFrame, on: str = "recipe_id") -> dict[str, int]:
    """Fail when the two sides share no id, warn when they share few."""
    counts = overlap(items, features, on).first().asDict()
    if counts["shared_ids"] == 0:
        raise ValueError(f"items and review features share no {on}: {counts}")
    if counts["shared_ids"] < LOW_OVERLAP:
        log.warning("items and review features share few ids: %s", counts)
    return counts
