"""Exact cosine search of query vectors among all item vectors.

A bounded set of queries is broadcast, so the items are read once and never shuffled. Each task keeps
the best k per query over its partition; a ranking per query merges what the tasks kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from savora.plans.skew import bounded_broadcast, fits_broadcast, hot_keys, spread
from savora.session import stage

# Most query numbers (vectors x width) that are broadcast; with more, both sides are cut into blocks.
QUERY_VALUES = 4_000_000
ITEMS_PER_BLOCK = 100_000
# Scores computed at once inside a task: queries x items.
QUERY_BLOCK = 2048
ITEM_BLOCK = 1024
# Candidates whose vectors are copied at once.
CANDIDATES = 16_384


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.where(np.isnan(flat), 0.0, flat).reshape(-1, width)


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def _keep_best(query, item, score, k):
    """Rows of the k best per query, ties to the smaller item."""
    order = np.lexsort((item, -score, query))
    query, item, score = query[order], item[order], score[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    best = rank < k[query]
    return query[best], item[best], score[best]


def rank_per(df: DataFrame, query: str, item: str, score: str, k) -> DataFrame:
    """Add ``rank`` per query by score, then item, and keep ranks up to ``k`` (number or column).

    With a number, Spark drops what cannot rank before the shuffle, so a query with very many
    candidates does not meet in one task.
    """
    order = Window.partitionBy(query).orderBy(F.desc(score), F.asc(item))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k_cosine(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_vector: str = "vector",
    item_id: str = "recipe_id",
    item_vector: str = "embedding",
    exclude: DataFrame | None = None,
    places: int = 6,
) -> DataFrame:
    """``(query_id, item_id, score, rank)``: the k most similar items of every query.

    ``exclude(query_id, item_id)`` names items a query must not get. A query with e exclusions looks
    for k + e items, so k are left. Scores are rounded to ``places`` before ranking, so float noise
    decides no tie. Rows without a vector take no part; missing numbers inside one count as 0, and a
    vector of another width than the first item's is an error. Of items with the same vector one is scored, if that
    saves half of them.
    """
    width = _width(items, item_vector)
    queries = queries.where(F.col(query_vector).isNotNull()).select(
        F.col(query_id), _checked(F.col(query_vector), width).cast("array<double>").alias("vector")
    )
    items = items.where(F.col(item_vector).isNotNull()).select(
        item_id, _checked(F.col(item_vector), width).alias(item_vector)
    )
    schema = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(item_id, items.schema[item_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    if not width:
        return rank_per(items.sparkSession.createDataFrame([], schema), query_id, item_id, "score", k)
    copies = distinct_vectors(items, item_id, item_vector)
    if exclude is not None:
        exclude = exclude.select(query_id, item_id).distinct()
        extra = exclude.groupBy(query_id).agg(F.count("*").alias("extra"))
        queries = queries.join(extra, query_id, "left").withColumn(
            "extra", F.coalesce("extra", F.lit(0))
        )
    else:
        queries = queries.withColumn("extra", F.lit(0))

    if copies is not None:
        queries = stage(queries, "query-vectors")
        items = copies[0].select(F.col("_first").alias(item_id), F.col("_vector").alias(item_vector))
    most = max(1, QUERY_VALUES // width)
    rows = queries.limit(most + 1).toArrow()
    if len(rows) <= most:
        found = _scan(rows, items, k, width, places, schema)
    else:
        found = _multiply_blocks(queries, items, most, k, width, places, schema)
    if copies is not None:
        found = _with_copies(found, queries.select(query_id, "extra"), *copies, k, query_id, item_id)
    if exclude is not None:
        found = found.join(exclude, [query_id, item_id], "left_anti")
    return rank_per(found, query_id, item_id, "score", k)


def distinct_vectors(items: DataFrame, item_id: str, item_vector: str) -> tuple[DataFrame, DataFrame] | None:
    """``(_first, _vector, _size)`` per distinct vector and ``(item, _first)`` per item, both stored, or nothing.

    ``_first`` is the smallest of the items with that vector. Nothing comes back if more than half of the items have a
    vector of their own, or if an item with several vectors would stand for more than one.
    """
    rows, kinds = items.agg(F.count("*"), F.count_distinct(F.xxhash64(item_vector))).first()
    if 2 * kinds > rows:
        return None
    classes = items.groupBy(F.col(item_vector).alias("_vector")).agg(F.min(item_id).alias("_first"), F.count("*").alias("_size"))
    classes = stage(classes.select("_first", "_vector", "_size"), "distinct-vectors")
    found, firsts = classes.agg(F.count("*"), F.count_distinct("_first")).first()
    if found != firsts:
        return None
    keyed = items.join(bounded_broadcast(classes.select("_first", "_vector")), F.col(item_vector) == F.col("_vector"))
    return classes, stage(keyed.select(item_id, "_first"), "equal-vectors")


def _with_copies(found, limits, classes, members, k: int, query_id: str, item_id: str) -> DataFrame:
    """The hits among all items from those among distinct vectors.

    Vectors behind ``k + extra`` items of better scores are left out, and so are copies that as many others precede.
    """
    best = found.withColumnRenamed(item_id, "_first").join(bounded_broadcast(classes.select("_first", "_size")), "_first")
    best = best.join(limits.withColumn("_most", F.col("extra") + k).select(query_id, "_most"), query_id)
    up_to = F.sum("_size").over(Window.partitionBy(query_id).orderBy(F.desc("score")))
    level = F.sum("_size").over(Window.partitionBy(query_id, "score"))
    best = best.withColumn("_before", up_to - level).where(F.col("_before") < F.col("_most"))
    most = limits.agg(F.max("extra")).first()[0] or 0
    copies = rank_per(members.withColumn("_one", F.lit(1)), "_first", item_id, "_one", k + most).drop("_one")
    copies = bounded_broadcast(stage(copies.withColumnRenamed("rank", "_place"), "copies"))
    opened = best.join(copies, "_first").where(F.col("_place") <= F.col("_most"))
    return opened.select(query_id, item_id, "score")


def _width(items: DataFrame, item_vector: str) -> int:
    first = items.select(F.size(item_vector).alias("d")).where(F.col(item_vector).isNotNull()).first()
    return first.d if first else 0


def _checked(vector: Column, width: int) -> Column:
    message = F.concat(F.lit(f"vectors must have {width} numbers, this one has "), F.size(vector).cast("string"))
    return F.when(F.size(vector) == width, vector).otherwise(F.raise_error(message))


class _Best:
    """The best items per query among those seen so far.

    Scores are computed for a block of queries and a block of items at a time, in single precision; those that can
    be hits are computed again in double. Once a query has its items, only scores that reach the last of them are looked at.
    """

    def __init__(self, queries: pa.Table, k: int, width: int, places: int, names: list[str]):
        self.ids = queries.column(0)
        self.unit = np.empty((len(queries), width))
        for low in range(0, len(queries), QUERY_BLOCK):
            self.unit[low : low + QUERY_BLOCK] = _unit(_matrix(queries.column(1).slice(low, QUERY_BLOCK), width))
        self.near = self.unit.astype(np.float32)
        self.limit = queries.column(2).to_numpy().astype(np.int64) + k
        self.floor = np.full(len(queries), -np.inf)
        self.width, self.places, self.names = width, places, names
        # What rounding can move, and twice the error of a product of unit vectors in single precision.
        self.slack = 10.0**-places + (width + 4) * 2.0**-22
        self.kept: dict[int, list[tuple]] = {}

    def add(self, ids: np.ndarray, vectors, rows: np.ndarray | None = None) -> None:
        """Compare items with all queries, or with those at the ascending positions ``rows``."""
        if not len(ids) or not len(self.unit):
            return
        ids = ids.astype(str) if ids.dtype == object else ids
        lows = range(0, len(self.unit), QUERY_BLOCK)
        if rows is None:
            blocks = [(low, slice(low, low + QUERY_BLOCK)) for low in lows]
        else:
            edges = np.searchsorted(rows, [*lows, len(self.unit)])
            blocks = [(low, rows[x:y]) for low, x, y in zip(lows, edges, edges[1:]) if x < y]
        for start in range(0, len(ids), ITEM_BLOCK):
            matrix = _unit(_matrix(vectors.slice(start, ITEM_BLOCK), self.width))
            turned = matrix.astype(np.float32).T
            for low, asked in blocks:
                scores = self.near[asked] @ turned
                floor = self.floor[asked]
                if np.isneginf(floor).any():
                    bound = int(min(self.limit[asked].max(), scores.shape[1]))
                    own = -np.partition(-scores, bound - 1, axis=1)[:, bound - 1]
                    floor = np.maximum(floor, own)
                least = (floor - self.slack).astype(np.float32)
                q, i = np.divmod(np.flatnonzero(scores >= least[:, None]), scores.shape[1])
                if len(q):
                    self._keep(low, q + low if rows is None else asked[q], i, ids[start : start + ITEM_BLOCK], matrix)
                    # Cut while queries lack hits, and then whenever as many came as are wanted.
                    new = sum(len(x[0]) for x in self.kept[low][1:])
                    if np.isneginf(self.floor[asked]).any() or new > self.limit[low : low + QUERY_BLOCK].sum():
                        self.cut(low)

    def _keep(self, low: int, q: np.ndarray, i: np.ndarray, ids: np.ndarray, matrix: np.ndarray) -> None:
        found = np.empty(len(q))
        for at in range(0, len(q), CANDIDATES):
            part = slice(at, at + CANDIDATES)
            found[part] = np.einsum("ij,ij->i", self.unit[q[part]], matrix[i[part]])
        self.kept.setdefault(low, []).append((q, ids[i], np.round(found, self.places) + 0.0))

    def cut(self, low: int) -> None:
        q, i, s = (np.concatenate(part) for part in zip(*self.kept[low]))
        q, i, s = _keep_best(q, i, s, self.limit)
        self.kept[low] = [(q, i, s)]
        # Rows come ordered by query and falling score: a full query's last score is its floor.
        found, first, n = np.unique(q, return_index=True, return_counts=True)
        full = n >= self.limit[found]
        self.floor[found[full]] = s[(first + n - 1)[full]]

    def table(self) -> pa.Table:
        if not self.kept:
            return pa.table([self.ids.slice(0, 0), pa.array([]), pa.array([])], names=self.names)
        for low in self.kept:
            self.cut(low)
        q, i, s = (np.concatenate(part) for part in zip(*(rows for (rows,) in self.kept.values())))
        return pa.table([self.ids.take(pa.array(q)), pa.array(i), pa.array(s)], names=self.names)


def _scan(rows: pa.Table, items: DataFrame, k, width, places, schema) -> DataFrame:
    """Few queries: broadcast them, read the items once, shuffle only what each task keeps."""
    shared = items.sparkSession.sparkContext.broadcast(rows)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(shared.value, k, width, places, schema.names)
        for batch in batches:
            best.add(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1))
        if best.kept:
            yield from best.table().combine_chunks().to_batches(max_chunksize=10_000)

    return spread(items).mapInArrow(search, schema)


def _multiply_blocks(queries: DataFrame, items: DataFrame, most, k, width, places, schema) -> DataFrame:
    """Too many queries to broadcast: cut both sides into blocks, one task per pair of blocks."""
    query_id, item_id = schema.names[:2]
    queries = stage(queries, "query-vectors")
    i_blocks = max(1, ceil(items.count() / ITEMS_PER_BLOCK))
    q_blocks = query_blocks(queries, ceil(most / 2), i_blocks)

    def blocks(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        numbers = F.sequence(F.lit(0), F.lit(n_other - 1)).cast("array<bigint>")
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own))).withColumn(
            other, F.explode(numbers)
        )

    left = blocks(queries, query_id, "_q", q_blocks, "_i", i_blocks).groupBy("_q", "_i")
    right = blocks(items, item_id, "_i", i_blocks, "_q", q_blocks).groupBy("_q", "_i")

    def search(asked: pa.Table, given: pa.Table) -> pa.Table:
        best = _Best(asked, k, width, places, schema.names)
        if len(given):
            best.add(given.column(0).to_numpy(), given.column(1))
        return best.table().cast(target)

    target = to_arrow_schema(schema)
    return left.cogroup(right).applyInArrow(search, schema)


def query_blocks(queries: DataFrame, most: int, i_blocks: int) -> int:
    """Blocks of at most ``most`` queries each; more if blocks of both sides would be fewer than twice the cores."""
    cores = queries.sparkSession.sparkContext.defaultParallelism
    return max(ceil(queries.count() / most), ceil(2 * cores / i_blocks))


def session_vectors(
    sessions: DataFrame,
    items: DataFrame,
    session_id: str = "session_id",
    item_id: str = "recipe_id",
    item_vector: str = "embedding",
    width: int | None = None,
) -> DataFrame:
    """``(session_id, vector)``: mean embedding of each session's items.

    One average per dimension, whatever a session's length.
    Items without a vector do not count, nor do sessions that have no others.
    """
    if width is None:
        width = _width(items, item_vector)
    given = items.select(item_id, item_vector).where(F.col(item_vector).isNotNull())
    seeds = sessions.select(session_id, item_id)
    copies = distinct_vectors(given, item_id, item_vector)
    numbered = copies is not None and fits_broadcast(copies[0])
    joined = seeds.join(copies[1] if numbered else given, item_id)
    # Sums of all dimensions are far larger than a row, so the rows are dealt out and not the sums; a long
    # session is cut into slices.
    hot = bounded_broadcast(stage(hot_keys(sessions.groupBy(session_id).agg(F.count("*").alias("_n")), session_id, "_n"), "hot-keys"))
    slices = F.coalesce(F.col("_slices"), F.lit(1)).cast("bigint")
    dealt = joined.join(hot, session_id, "left").withColumn("_salt", F.pmod(F.xxhash64(item_id), slices)).drop(item_id, "_slices")
    dealt = dealt.repartition(session_id, "_salt")
    if numbered:
        vectors = copies[0].select("_first", F.col("_vector").alias(item_vector))
        dealt = dealt.join(F.broadcast(vectors), "_first")
    numbers = [F.get(F.col(item_vector), F.lit(d)).cast("double") for d in range(width)]
    sums = (f(x).alias(f"_{c}{d}") for d, x in enumerate(numbers) for f, c in ((F.sum, "s"), (F.count, "n")))
    parts = dealt.groupBy(session_id, "_salt").agg(*sums)
    means = (F.try_divide(F.sum(f"_s{d}"), F.sum(f"_n{d}")) for d in range(width))
    return parts.groupBy(session_id).agg(F.array(*means).alias("vector"))


def session_neighbours(
    sessions: DataFrame,
    items: DataFrame,
    k: int = 20,
    session_id: str = "session_id",
    item_id: str = "recipe_id",
    item_vector: str = "embedding",
) -> DataFrame:
    """The k nearest items of each session's mean embedding, without the session's own items."""
    vectors = session_vectors(sessions, items, session_id, item_id, item_vector)
    return top_k_cosine(
        vectors, items, k, session_id, "vector", item_id, item_vector, exclude=sessions
    )
