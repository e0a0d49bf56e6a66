"""Column expressions shared by the operators. All stay inside Spark SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a number in an id, and what separates tokens.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
TOKEN_BREAK = r"(?U)[\s\x1c-\x1f]+"

# Soft binning uses 15 centres on [-3, 3].
BIN_CENTRES = 15
BIN_LOW, BIN_HIGH = -3.0, 3.0


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def tag_names(columns: Sequence[str]) -> list[str]:
    """Names of the tags a table carries, found by the ``pred_`` prefix."""
    return [c.removeprefix("pred_") for c in columns if c.startswith("pred_")]


def with_nulls_for_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float and double column, so aggregates skip it."""
    floating = (T.FloatType, T.DoubleType)
    return df.select(
        *(
            F.nullif(named(f.name), F.lit(float("nan")).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, floating)
            else named(f.name)
            for f in df.schema
        )
    )


def normalised_id(column: Column) -> Column:
    """An id as a clean integer string; fractions are cut off, what is no number becomes "0"."""
    text = column.cast("string")
    parsed = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double").try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), parsed, F.lit(0).cast("bigint")).cast("string")


def tokens(column: Column) -> Column:
    """Whitespace-separated tokens; null gives an empty list."""
    return F.filter(F.split(F.coalesce(column, F.lit("")), TOKEN_BREAK), lambda t: t != "")


def spaced_tokens(column: Column) -> Column:
    """Tokens in which an underscore stands for a space."""
    return F.transform(tokens(column), lambda t: F.replace(t, F.lit("_"), F.lit(" ")))


def count_normalised(ids: DataFrame, raw: str, name: str) -> DataFrame:
    """``(name, n)``: rows per :func:`normalised_id`. Equal raw ids are counted first and read once."""
    counted = ids.groupBy(raw).agg(F.count("*").alias("_n"))
    return counted.groupBy(normalised_id(F.col(raw)).alias(name)).agg(F.sum("_n").alias("n"))


def flag(column: Column) -> Column:
    """True for non-zero and for missing."""
    return F.coalesce(column != 0, F.lit(True))


def bounded_rating(raw: Column) -> Column:
    """Map any real number into [1, 5]."""
    return F.lit(1.0) + F.lit(4.0) / (F.lit(1.0) + F.exp(-raw))


def rating_logit(rating: Column, margin: float = 0.001) -> Column:
    """Inverse of :func:`bounded_rating`, with ratings kept ``margin`` inside (1, 5)."""
    inside = F.greatest(F.lit(1.0 + margin), F.least(F.lit(5.0 - margin), rating))
    share = (inside - 1.0) / 4.0
    return F.log(share / (F.lit(1.0) - share))


def soft_bins(x: Column) -> Column:
    """Weight of ``x`` in each of the bins: a triangle around every centre."""
    step = (BIN_HIGH - BIN_LOW) / (BIN_CENTRES - 1)
    centres = F.sequence(F.lit(0), F.lit(BIN_CENTRES - 1))
    return F.transform(
        centres,
        lambda i: F.greatest(
            F.lit(0.0), F.lit(1.0) - F.abs(x - (F.lit(BIN_LOW) + i * F.lit(step))) / F.lit(step)
        ),
    )


def zeroed(vector: Column) -> Column:
    """The vector with every entry 0."""
    return F.transform(vector, lambda x: F.lit(0.0).cast("float"))


def ablate(df: DataFrame, ablation: str, meta: str = "meta", tag: str = "tag") -> DataFrame:
    """Blank one feature group: ``meta_only`` blanks the tags, ``tag_only`` the metadata."""
    if ablation == "all_features":
        return df
    blank = {"meta_only": tag, "tag_only": meta}.get(ablation)
    if blank is None:
        raise ValueError(f"unknown ablation: {ablation}")
    return df.withColumn(blank, zeroed(F.col(blank)))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 where one has no length."""
    length = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.try_divide(dot(a, b), length), F.lit(0.0))


def rounded(column: Column, places: int = 6) -> Column:
    """Rounded, without negative zero."""
    return F.round(column, places) + F.lit(0.0)


