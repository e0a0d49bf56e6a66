"""Feature building: typing, scaling, vocabularies, indicators, vectors, reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from savora.functions.columns import flag, named, spaced_tokens, tokens
from savora.plans.skew import spread
from savora.settings import NUMERIC_FEATURES

# Columns that are ids, targets or names, never model inputs.
NOT_FEATURES = ("recipe_id", "name", "bayesian_rating", "raw_mean_rating", "review_count")


def search_table(
    merged: DataFrame, ingredients: str = "ingredients_clean", tags: str = "tags_clean"
) -> DataFrame:
    """Unscaled rows for search: ``pred_*`` as booleans, token columns as arrays."""

    def typed(name: str) -> Column:
        if name.startswith("pred_"):
            return flag(named(name)).alias(name)
        if name == ingredients:
            return spaced_tokens(named(name)).alias(name)
        if name == tags:
            return tokens(named(name)).alias(name)
        return named(name)

    return merged.select(*(typed(c) for c in merged.columns))


# --- scaling ---------------------------------------------------------------------------------


def standard_columns(df: DataFrame) -> list[str]:
    """Columns to standardise: double or long, no id, target, name, ``pred_`` or ``intensity_``."""
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, (T.DoubleType, T.LongType))
        and f.name not in NOT_FEATURES
        and not f.name.startswith(("pred_", "intensity_"))
    ]


def minmax_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("intensity_")]


def scale(
    df: DataFrame,
    standard: Sequence[str] = (),
    minmax: Sequence[str] = (),
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Standardise ``standard`` (population deviation) and map ``minmax`` to [0, 1].

    A constant column becomes 0. Nulls are ignored in the fit and stay null. All statistics come
    from one aggregate over ``fit_on`` (default: all of ``df``).
    """
    if not standard and not minmax:
        raise ValueError("name at least one column to standardise or to map to [0, 1]")
    source = df if fit_on is None else fit_on
    parts: list[Column] = []
    for c in standard:
        parts += [F.avg(named(c)).alias(f"mean_{c}"), F.stddev_pop(named(c)).alias(f"dev_{c}")]
    for c in minmax:
        parts += [F.min(named(c)).alias(f"min_{c}"), F.max(named(c)).alias(f"max_{c}")]
    stats = source.agg(F.struct(*parts).alias("s")).scalar()

    def span(width: Column) -> Column:
        return F.when(width == 0, F.lit(1.0)).otherwise(width)

    def scaled(name: str) -> Column:
        x = named(name).cast("double")
        if name in standard:
            return ((x - stats[f"mean_{name}"]) / span(stats[f"dev_{name}"])).alias(name)
        if name in minmax:
            low, high = stats[f"min_{name}"], stats[f"max_{name}"]
            return ((x - low) / span(high - low)).alias(name)
        return named(name)

    return df.select(*(scaled(c) for c in df.columns))


# --- vocabularies and indicators -------------------------------------------------------------


def top_tokens(df: DataFrame, column: str, top_n: int = 100) -> DataFrame:
    """The ``top_n`` most frequent tokens (repeats within a row count); ties go to the smaller token."""
    return (
        spread(df.select(column))
        .select(F.explode(tokens(F.col(column))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(top_n)
    )


def vocabulary(df: DataFrame, column: str, top_n: int = 100) -> list[str]:
    """:func:`top_tokens` as a list: at most ``top_n`` strings, needed to name columns."""
    return [row.token for row in top_tokens(df, column, top_n).collect()]


def indicator_name(prefix: str, token: str) -> str:
    return f"{prefix}_" + token.replace("-", "_").replace(" ", "_")


def with_indicators(
    df: DataFrame, column: str, prefix: str, vocab: Sequence[str] | None = None, top_n: int = 100
) -> DataFrame:
    """Add one 0/1 column per vocabulary token, map-only.

    Tokens whose column names are equal but for case share one, named after the first of them.
    """
    vocab = vocabulary(df, column, top_n) if vocab is None else vocab
    groups: dict[str, list[str]] = {}
    for token in vocab:
        groups.setdefault(indicator_name(prefix, token).lower(), []).append(token)
    parsed = df.withColumn("_tokens", tokens(F.col(column)))

    def present(group: list[str]) -> Column:
        if len(group) == 1:
            return F.array_contains("_tokens", group[0])
        return F.arrays_overlap("_tokens", F.array(*map(F.lit, group)))

    return parsed.select(
        *(named(c) for c in df.columns),
        *(present(group).cast("int").alias(indicator_name(prefix, group[0])) for group in groups.values()),
    )


def indicators_long(df: DataFrame, item: str, column: str, prefix: str, vocab: DataFrame) -> DataFrame:
    """The indicators that are 1, as ``(item, feature)`` rows, for vocabularies too wide for columns."""
    feature = F.concat(F.lit(f"{prefix}_"), F.translate("token", "- ", "__"))
    return (
        df.select(F.col(item), F.explode(F.array_distinct(tokens(F.col(column)))).alias("token"))
        .join(vocab.select("token"), "token", "left_semi")
        .select(item, feature.alias("feature"))
        .distinct()
    )


# --- vectors ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureGroups:
    """Which columns feed which vector, in vector order."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    tag: tuple[str, ...]

    @property
    def meta(self) -> tuple[str, ...]:
        return self.numeric + self.categorical


def feature_groups(
    columns: Sequence[str], numeric: Sequence[str] = NUMERIC_FEATURES
) -> FeatureGroups:
    missing = [c for c in numeric if c not in columns]
    if missing:
        raise ValueError(f"numeric features not in the table: {missing}")
    return FeatureGroups(
        tuple(numeric),
        tuple(c for c in columns if c.startswith(("cat_", "ing_"))),
        tuple(c for c in columns if c.startswith(("pred_", "intensity_"))),
    )


def feature_widths(spark, groups: FeatureGroups) -> DataFrame:
    rows = [
        ("meta", len(groups.meta)),
        ("numeric", len(groups.numeric)),
        ("categorical", len(groups.categorical)),
        ("tag", len(groups.tag)),
    ]
    return spark.createDataFrame(rows, "feature_group string, width bigint")


def assemble(
    df: DataFrame, groups: FeatureGroups, item: str = "recipe_id", name: str = "name"
) -> DataFrame:
    """Rows ``(item, name, meta, tag, target)`` with single-precision vectors."""

    def vector(columns: Sequence[str]) -> Column:
        return F.array(*map(named, columns)).cast("array<float>")

    return df.select(
        F.col(item),
        named(name),
        vector(groups.meta).alias("meta"),
        vector(groups.tag).alias("tag"),
        F.col("bayesian_rating").cast("float").alias("target"),
    )


def _numbered(spark, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "feature string, idx int")


def column_mapping(df: DataFrame) -> DataFrame:
    """Every column but ids and targets, numbered in table order (text columns included)."""
    return _numbered(df.sparkSession, [c for c in df.columns if c not in NOT_FEATURES])


def feature_index(df: DataFrame, groups: FeatureGroups) -> DataFrame:
    """True position of every feature in the ``meta`` and ``tag`` vectors laid end to end."""
    return _numbered(df.sparkSession, groups.meta + groups.tag)


# --- report ----------------------------------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def feature_report(df: DataFrame, item: str = "recipe_id") -> DataFrame:
    """Per numeric column: mean, sample deviation, min, max; with item and column counts.

    The statistics are one narrow-buffer aggregate. Distinct ids are counted on their own, so no
    statistics travel with them through a shuffle.
    """
    columns = numeric_columns(df)
    parts: list[Column] = []
    for c in columns:
        x = named(c).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            )
        )
    items = df.select(item).distinct().agg(F.count(item).alias("n")).scalar()
    return (
        df.agg(F.array(*parts).alias("rows"))
        .select(F.inline("rows"))
        .select(
            items.alias("items"), F.lit(len(columns)).cast("bigint").alias("numeric_columns"), "*"
        )
    )
