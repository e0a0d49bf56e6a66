"""Row-wise losses; their mean is the loss of a set of predictions."""

from __future__ import annotations

from math import log

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared(error: Column) -> Column:
    return error * error


def huber(error: Column) -> Column:
    size = F.abs(error)
    return F.when(size <= 1.0, error * error / 2.0).otherwise(size - 0.5)


def log_cosh(error: Column) -> Column:
    """ln cosh, in the form that does not overflow."""
    size = F.abs(error + 1e-12)
    return size + F.log1p(F.exp(-2.0 * size)) - F.lit(log(2.0))


LOSSES = {"mse": squared, "huber": huber, "log_cosh": log_cosh}


def loss(name: str, error: Column) -> Column:
    """Mean loss by name; an unknown name means Huber."""
    return F.avg(LOSSES.get(name, huber)(error))
