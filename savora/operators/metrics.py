"""Losses and errors of predictions, and a profile of a scored corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savora.functions.losses import LOSSES, loss
from savora.operators.split import rank_key
from savora.plans.order_stats import run_starts
from savora.session import stage


def losses(df: DataFrame, prediction: str = "prediction", target: str = "target") -> DataFrame:
    """One row with every loss."""
    error = F.col(prediction).cast("double") - F.col(target).cast("double")
    return df.agg(*(loss(name, error).alias(name) for name in LOSSES))


def evaluate(df: DataFrame, prediction: str = "prediction", target: str = "target") -> DataFrame:
    """One row ``(mse, rmse, mae)``, every row weighing the same."""
    error = F.col(prediction).cast("double") - F.col(target).cast("double")
    return (
        df.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"))
        .select("mse", F.sqrt("mse").alias("rmse"), "mae")
    )


def evaluate_batched(
    df: DataFrame,
    item: str = "recipe_id",
    batch_size: int = 256,
    seed: int = 42,
    prediction: str = "prediction",
    target: str = "target",
) -> DataFrame:
    """One row ``(mse, rmse, mae)`` as means of per-batch means; a short last batch weighs as much.

    Batches are consecutive rows in seeded order. Equal rows form a run; a run touches at most two
    batches partly, and the batches it fills need no row each, so copies are never spread out.
    """
    error = F.col(prediction).cast("double") - F.col(target).cast("double")
    runs = (
        df.select(
            rank_key(F.col(item), seed).alias("key"),
            F.col(item).cast("string").alias("id"),
            error.alias("error"),
        )
        .groupBy("key", "id", "error")
        .agg(F.count("*").alias("n"))
    )
    placed = run_starts(stage(runs, "error-runs"), "key", ["key", "id", "error"], "n")
    size = F.lit(batch_size).cast("bigint")
    first = F.expr(f"start div {batch_size}")
    last = F.expr(f"(start + n - 1) div {batch_size}")
    end = F.col("start") + F.col("n")
    none = F.lit(0).cast("bigint")

    def piece(batch, rows, whole):
        return F.struct(batch.alias("batch"), rows.alias("rows"), whole.alias("whole"))

    pieces = F.when(first == last, F.array(piece(first, F.col("n"), none))).otherwise(
        F.array(
            piece(first, (first + 1) * size - F.col("start"), none),
            piece(last, end - last * size, none),
            piece(first + 1, none, last - first - 1),
        )
    )
    cut = placed.select("error", F.inline(pieces))
    partly = (
        cut.where("rows > 0")
        .groupBy("batch")
        .agg(
            (F.sum(F.col("error") ** 2 * F.col("rows")) / F.sum("rows")).alias("mse"),
            (F.sum(F.abs("error") * F.col("rows")) / F.sum("rows")).alias("mae"),
            F.lit(1).cast("bigint").alias("batches"),
        )
        .drop("batch")
    )
    filled = cut.where("whole > 0").select(
        (F.col("error") ** 2).alias("mse"),
        F.abs("error").alias("mae"),
        F.col("whole").alias("batches"),
    )
    every = partly.unionByName(filled)
    weight = F.sum("batches")
    return every.agg(
        (F.sum(F.col("mse") * F.col("batches")) / weight).alias("mse"),
        (F.sum(F.col("mae") * F.col("batches")) / weight).alias("mae"),
    ).select("mse", F.sqrt("mse").alias("rmse"), "mae")


def output_profile(
    scored: DataFrame, prediction: str = "prediction", embedding: str = "embedding"
) -> DataFrame:
    """One row: range of the predictions, number and width of the embeddings."""
    return scored.agg(
        F.min(prediction).alias("min_prediction"),
        F.max(prediction).alias("max_prediction"),
        F.count("*").alias("rows"),
        F.max(F.size(embedding)).alias("width"),
    )
