"""Models fitted on Spark: a rating regression and item vectors, both from first and second moments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from savora.functions.columns import bounded_rating, dot, rating_logit
from savora.functions.losses import loss
from savora.session import stage


def with_vector(features: DataFrame) -> DataFrame:
    """Add ``features``: the meta and tag vectors laid end to end, missing entries as 0."""
    return features.withColumn("features", array_to_vector(_entries()))


@dataclass(frozen=True)
class Moments:
    """Number of rows, means, standard deviations (of a sample) and correlations; a constant has none with others."""

    n: int
    mean: np.ndarray
    deviation: np.ndarray
    correlation: np.ndarray


def moments(rows: DataFrame, column: str = "features") -> Moments:
    """Two distributed passes; the driver gets a square of the vectors' width."""
    stats = rows.select(Summarizer.metrics("count", "mean", "std").summary(F.col(column)).alias("s")).first().s
    if stats["count"] < 2:
        raise ValueError("moments need two rows")
    deviation = stats["std"].toArray()
    r = Correlation.corr(rows, column).first()[0].toArray()
    varies = deviation > 0
    r = np.where(np.outer(varies, varies), r, 0.0)
    np.fill_diagonal(r, 1.0)
    return Moments(stats["count"], stats["mean"].toArray(), deviation, r)


def ridge(m: Moments, reg_param: float) -> tuple[float, np.ndarray]:
    """Intercept and coefficients for the last entry of the vectors, from all others.

    Minimises half the mean square error plus ``reg_param / 2`` times the squares of the coefficients that
    standardised features would have. Of several solutions without regularisation the smallest is taken.
    """
    d = len(m.mean) - 1
    scaled, *_ = np.linalg.lstsq(m.correlation[:d, :d] + reg_param * np.eye(d), m.correlation[:d, d] * m.deviation[d], rcond=None)
    own = np.divide(scaled, m.deviation[:d], out=np.zeros(d), where=m.deviation[:d] > 0)
    return float(m.mean[d] - own @ m.mean[:d]), own


def _predicted(intercept: float, coefficients: Sequence[float]) -> Column:
    weights = F.array(*(F.lit(float(c)) for c in coefficients))
    return bounded_rating(F.lit(float(intercept)) + dot(_entries(), weights))


def _entries() -> Column:
    return F.transform(F.concat("meta", "tag"), lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))


@dataclass(frozen=True)
class RatingModel:
    """A fitted model and the losses it was chosen by."""

    intercept: float
    coefficients: tuple[float, ...]
    history: DataFrame

    def predict(self, features: DataFrame) -> DataFrame:
        return features.withColumn("prediction", _predicted(self.intercept, self.coefficients))

    def save(self, path: str) -> None:
        """Store the coefficients and the losses; what was there before is replaced."""
        spark = self.history.sparkSession
        row = [(self.intercept, list(self.coefficients))]
        spark.createDataFrame(row, "intercept double, coefficients array<double>").write.mode("overwrite").parquet(f"{path}/coefficients")
        self.history.write.mode("overwrite").parquet(f"{path}/history")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RatingModel:
        row = spark.read.parquet(f"{path}/coefficients").first()
        return cls(row.intercept, tuple(row.coefficients), spark.read.parquet(f"{path}/history"))


def fit_rating_model(
    train: DataFrame,
    validation: DataFrame,
    reg_params: Sequence[float] = (0.0, 0.01, 0.1),
    loss_name: str = "mse",
) -> RatingModel:
    """Linear regression on the logit of the rating; the validation loss picks the regularisation.

    One pass over the training rows sums products, from which every setting is solved in closed form
    (:func:`ridge`), and one pass over the validation rows measures all settings. Equal losses go to the smaller
    setting. The driver holds a square of the number of features, which the vocabulary sizes bound.
    """
    label = F.array(rating_logit(F.col("target").cast("double")))
    rows = stage(train.select(array_to_vector(F.concat(_entries(), label)).alias("features")), "train-vectors")
    m = moments(rows)
    solved = [(float(reg), *ridge(m, reg)) for reg in reg_params]
    target = F.col("target").cast("double")
    losses = validation.agg(
        *(loss(loss_name, _predicted(a, b) - target).alias(f"loss_{i}") for i, (_, a, b) in enumerate(solved))
    ).first()
    tried = [(reg, value, a, b) for (reg, a, b), value in zip(solved, losses, strict=True)]
    best = min(tried, key=lambda t: (t[1] is None, t[1], t[0]))
    rows = [(reg, value, reg == best[0]) for reg, value, *_ in tried]
    history = train.sparkSession.createDataFrame(
        rows, "reg_param double, validation_loss double, chosen boolean"
    )
    return RatingModel(best[2], tuple(best[3].tolist()), history)


def item_vectors(features: DataFrame, k: int = 128, item: str = "recipe_id") -> DataFrame:
    """``(item, embedding)`` of :func:`with_item_vectors`."""
    return with_item_vectors(features, k).select(item, "embedding")


def with_item_vectors(features: DataFrame, k: int = 128) -> DataFrame:
    """Add ``embedding``: principal components of the feature vectors, for similarity without a stored model.

    Components come by falling variance; vectors are taken from their mean, and of the two signs a component
    can have that one is chosen under which its greatest entry (the first of equal ones) is positive. With as
    many components as features the length of an embedding is the item's distance from the mean. The driver holds
    a square matrix of the feature width, which the vocabulary sizes bound.
    """
    prepared = with_vector(features)
    model, shift, sign = _components(prepared, k)
    raw = vector_to_array("_components")
    moved = F.zip_with(raw, F.array(*map(F.lit, shift)), lambda x, s: x - s)
    signed = F.zip_with(moved, F.array(*map(F.lit, sign)), lambda x, s: (x * s).cast("float"))
    return model.transform(prepared).withColumn("embedding", signed).drop("features", "_components")


def _components(prepared: DataFrame, k: int):
    width = prepared.select((F.size("meta") + F.size("tag")).alias("d")).first().d
    model = PCA(k=min(k, width), inputCol="features", outputCol="_components").fit(prepared)
    axes = model.pc.toArray()
    mean = prepared.select(Summarizer.mean(F.col("features")).alias("m")).first().m.toArray()
    sign = np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return model, (mean @ axes).tolist(), sign.tolist()


def explained_variance(features: DataFrame, k: int = 128) -> DataFrame:
    """``component, variance, share`` of the components of :func:`with_item_vectors`, from 1 by falling variance."""
    prepared = with_vector(features)
    width = prepared.select((F.size("meta") + F.size("tag")).alias("d")).first().d
    shares = PCA(k=min(k, width), inputCol="features", outputCol="_components").fit(prepared).explainedVariance.toArray()
    total = float(np.sum(prepared.select(Summarizer.variance(F.col("features")).alias("v")).first().v.toArray()))
    rows = [(i + 1, float(s) * total, float(s)) for i, s in enumerate(shares)]
    return features.sparkSession.createDataFrame(rows, "component int, variance double, share double")
