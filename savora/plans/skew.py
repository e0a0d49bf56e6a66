"""Joins that survive hot keys, broadcasts that check their size, and use of idle cores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from savora.session import stage

# A key is hot above 1/MAX_HOT of all rows, or above SLICE_ROWS rows however many there are in all, so no
# slice outgrows a task. Keys below MIN_ROWS are not worth cutting.
MAX_HOT = 1000
MIN_ROWS = 10_000
SLICE_ROWS = 5_000_000
# Rows without a key find no partner; they go to this many places instead of one.
NULL_SLICES = 1000

# Above this many rows or bytes a side is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def _bytes(field: T.StructField) -> Column:
    column, kind = F.col(f"`{field.name.replace('`', '``')}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
        size = F.size(column) * 8
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(column)))
    else:
        size = F.lit(0)
    return F.coalesce(size, F.lit(0)).cast("bigint") + 16


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether ``df`` was counted to hold at most so many rows, and so many bytes in all its columns."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    width = sum(map(_bytes, df.schema.fields), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only if :func:`fits_broadcast`."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def never_broadcast(df: DataFrame) -> DataFrame:
    """Join ``df`` by shuffle, however small its files are; for a side that was counted and does not fit."""
    return df.hint("merge")


def hot_keys(counts: DataFrame, key: str, rows: str) -> DataFrame:
    """Keys that hold more than their share of all rows, and into how many slices to cut each.

    ``counts`` has one row per key with its number of rows. The result has at most ``MAX_HOT`` rows, or one for
    each ``SLICE_ROWS`` of all rows if that is more.
    """
    share = counts.agg(F.least(F.sum(rows) / F.lit(MAX_HOT), F.lit(float(SLICE_ROWS))).alias("share")).scalar()
    return (
        counts.select(
            F.col(key), F.col(rows).alias("_rows"), F.greatest(share, F.lit(float(MIN_ROWS))).alias("_share")
        )
        .where(F.col("_rows") > F.col("_share"))
        .select(key, F.ceil(F.col("_rows") / F.col("_share")).cast("int").alias("_slices"))
    )


def salted_join(
    big: DataFrame, small: DataFrame, key: str, hot: DataFrame, spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Join on ``key``, cutting each hot key of ``big`` into slices.

    Rows of ``small`` under a hot key are copied once per slice; all other keys join as usual.
    ``spread_by`` names columns of ``big`` that tell rows of one key apart. ``hot`` comes from
    :func:`hot_keys`; it is stored, and broadcast if it is small. Rows of ``big`` whose key is null are dealt out too.
    """
    hot = bounded_broadcast(stage(hot, "hot-keys"))
    slices = F.when(F.col(key).isNull(), F.lit(NULL_SLICES)).otherwise(F.coalesce(F.col("_slices"), F.lit(1)))
    left = (
        big.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), slices.cast("bigint")).cast("int"))
        .drop("_slices")
    )
    right = (
        small.where(F.col(key).isNotNull()).join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)))
        .drop("_slices")
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")


def grid_join(left: DataFrame, right: DataFrame, key: str, hot: str, slices: int = 16) -> DataFrame:
    """Inner join on ``key``, in which the one key ``hot`` may have very many rows on both sides.

    Its rows are dealt into ``slices`` on either side and copied once for each slice of the other, so its
    pairs are made in ``slices * slices`` places. All other keys join as usual.
    """
    is_hot = F.col(key) == F.lit(hot)
    every, one = F.sequence(F.lit(0), F.lit(slices - 1)), F.array(F.lit(0))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        hashed = [F.col(f"`{n.replace('`', '``')}`") for n, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
        mine = F.when(is_hot, F.pmod(F.xxhash64(*hashed), F.lit(slices)).cast("int")).otherwise(F.lit(0))
        return df.withColumn(own, mine).withColumn(other, F.explode(F.when(is_hot, every).otherwise(one)))

    joined = dealt(left, "_row", "_column").join(dealt(right, "_column", "_row"), [key, "_row", "_column"])
    return joined.drop("_row", "_column")


def keyed_join(facts: DataFrame, dimension: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """Inner join of ``facts`` with a table of one row per ``key``.

    Few facts are broadcast, so the table is not shuffled; with more, hot keys are cut into slices.
    ``facts`` is read several times and should be stored or staged.
    """
    if fits_broadcast(facts):
        return dimension.join(F.broadcast(facts), key)
    hot = hot_keys(facts.groupBy(key).agg(F.count("*").alias("_n")), key, "_n")
    return salted_join(facts, dimension, key, hot, spread_by)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores if the input comes in fewer pieces than there are cores.

    For heavy work per row on small files; an input with many splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
