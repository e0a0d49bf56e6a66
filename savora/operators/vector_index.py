"""A stored index for cosine search: vectors by cell, of which a search opens only some.

Cells are those of k-means on a sample; every vector is stored in the cell whose centre is nearest. A search
opens the cells with the nearest centres. No unit vector of a cell is farther from its centre than the cell's
radius, so ``query * centre + radius`` bounds the cosine of all that is in it: an exact search goes on to
the cells whose bound reaches the query's last hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from savora.operators.nearest import _Best, _checked, _matrix, _unit, _width, query_blocks, rank_per, top_k_cosine
from savora.session import stage

MOST_CELLS = 4096
# Vectors that the centres are fitted to; all vectors are stored.
SAMPLE_PER_CELL, MOST_SAMPLED = 64, 200_000
# Most query numbers (vectors x width) that are broadcast; with more, both sides meet in slices.
PROBE_VALUES = 4_000_000
ITEMS_PER_SLICE, QUERIES_PER_SLICE = 100_000, 50_000
# Stored vectors that ask for their own nearest, to find how many cells a search must open.
CALIBRATED, NEAREST = 500, 10


@dataclass(frozen=True)
class Cells:
    """Centres in the order of their numbers, radii and sizes; at most ``MOST_CELLS`` of them. ``shares`` are those of the
    nearest vectors that 1, 2, ... probes find."""

    centre: np.ndarray
    radius: np.ndarray
    size: np.ndarray
    shares: np.ndarray

    def probes_for(self, recall: float) -> int:
        return min(len(self.shares), 1 + int(np.searchsorted(self.shares, recall)))


def fit_centres(items: DataFrame, item_vector: str, n: int, n_cells: int, seed: int = 42) -> np.ndarray:
    """Centres of at most ``n_cells`` cells, from about 64 unit vectors per cell, 200,000 at most."""
    share = min(1.0, 1.5 * min(MOST_SAMPLED, SAMPLE_PER_CELL * n_cells) / max(n, 1))
    sample = items.sample(share, seed=seed) if share < 1 else items
    length = F.sqrt(F.aggregate(item_vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = F.transform(item_vector, lambda x: x.cast("double") / F.col("length"))
    rows = sample.withColumn("length", length).where("length > 0").select(array_to_vector(unit).alias("features"))
    rows = stage(rows, "sampled")
    count = rows.count()
    if not count:
        return np.zeros((1, _width(items, item_vector)))
    return np.array(KMeans(k=min(n_cells, count), seed=seed, maxIter=20).fit(rows).clusterCenters())


def write_vector_index(
    items: DataFrame, path: str, n_cells: int | None = None, item_id: str = "recipe_id", item_vector: str = "embedding",
    seed: int = 42,
) -> None:
    """Store ``item, vector`` below ``path`` by cell, and the cells with centre, radius and size.

    The number of cells is the root of the number of vectors if it is not given. Rows without a vector are
    left out; missing numbers inside one count as 0; vectors of another width are an error. A large cell
    has as many writers as its rows need. With the cells is stored which share of the 10 nearest vectors of 500 stored
    ones a number of probes finds.
    """
    width = _width(items, item_vector)
    checked = _checked(F.col(item_vector), width).cast("array<double>")
    given = items.where(F.col(item_vector).isNotNull()).select(
        F.col(item_id).alias("item"), F.transform(checked, lambda x: F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))).alias("vector")
    )
    given = stage(given, "vectors")
    n = given.count()
    n_cells = min(MOST_CELLS, n_cells or max(1, ceil(sqrt(n))))
    centres = fit_centres(given, "vector", n, n_cells, seed)
    sent = given.sparkSession.sparkContext.broadcast(centres)
    kind = given.schema["item"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), own.shape[1]))
            # Nearest centre: the square of the length of a unit vector is the same for all.
            cell = np.argmax(unit @ own.T - 0.5 * (own * own).sum(axis=1), axis=1)
            away = np.linalg.norm(unit - own[cell], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], ["item", "vector", "cell", "away"]
            )

    placed = stage(given.mapInArrow(place, f"item {kind}, vector array<double>, cell int, away double"), "placed")
    dealt = placed.select("item", "vector", "cell").repartitionByRange("cell", "item").sortWithinPartitions("cell")
    dealt.write.partitionBy("cell").mode("overwrite").parquet(f"{path}/vectors")
    sizes = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count("*").alias("n"))
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    numbered = given.sparkSession.createDataFrame(rows, "cell int, centre array<double>")
    cells = numbered.join(F.broadcast(sizes), "cell", "left").na.fill({"radius": 0.0, "n": 0})
    shares = found_shares(placed, centres, seed)
    found = F.get(F.array(*map(F.lit, shares)), F.col("cell"))
    cells.withColumns({"kind": F.lit(kind), "share": found}).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")


def found_shares(placed: DataFrame, centres: np.ndarray, seed: int) -> list[float]:
    """Of the nearest vectors of some stored ones, the share that stands in the first cell, in the first two, ..."""
    some = placed.orderBy(F.xxhash64("item", F.lit(seed)), "item").limit(CALIBRATED).select(F.col("item").alias("query"), "vector")
    some = stage(some, "asking")
    hits = top_k_cosine(some, placed, NEAREST, "query", "vector", "item", "vector")
    hits = stage(hits.select("query", "item"), "nearest")  # at most CALIBRATED * NEAREST rows
    rows = hits.join(placed.select("item", "cell"), "item").join(some, "query").select("vector", "cell").toArrow()
    if not len(rows):
        return [1.0] * len(centres)
    near = _unit(_matrix(rows["vector"], centres.shape[1])) @ centres.T
    own = near[np.arange(len(rows)), rows["cell"].to_numpy()]
    rank = (near > own[:, None]).sum(axis=1)
    return (np.cumsum(np.bincount(rank, minlength=len(centres))) / len(rows)).tolist()


def read_cells(spark: SparkSession, path: str) -> Cells:
    rows = sorted(spark.read.parquet(f"{path}/cells").collect(), key=lambda r: r.cell)
    return Cells(*(np.array([r[c] for r in rows]) for c in ("centre", "radius", "n", "share")))


def stored_vectors(spark: SparkSession, path: str, cells: list[int]) -> DataFrame:
    """``item, vector, cell`` of some cells; the folders of others are not listed among the files to read."""
    kind = spark.read.parquet(f"{path}/cells").first()["kind"]
    return spark.read.schema(f"item {kind}, vector array<double>, cell int").parquet(f"{path}/vectors").where(F.col("cell").isin(cells))


def _probes(queries: DataFrame, cells: Cells, probes: int, slack: float) -> DataFrame:
    """``query, vector, opened`` of the queries that open a cell: the ``probes`` nearest ones, or, of queries that have
    ``opened`` some, all others whose bound reaches ``floor``. ``opened`` has one bit per cell."""
    sent = queries.sparkSession.sparkContext.broadcast(cells)
    kind = queries.schema["query"].dataType.simpleString()
    more = "opened" in queries.columns

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        filled = own.size > 0
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                near = _unit(_matrix(batch.column(1), own.centre.shape[1])) @ own.centre.T
                if more:
                    floor = batch.column(3).to_numpy(zero_copy_only=False)
                    chosen = ~_bits(batch.column(2), len(filled)) & (near + own.radius >= floor[:, None] - slack)
                else:
                    order = np.argsort(-np.where(filled, near, -np.inf), axis=1, kind="stable")
                    chosen = np.zeros(near.shape, bool)
                    np.put_along_axis(chosen, order[:, :probes], True, axis=1)
                chosen &= filled
                some = np.flatnonzero(chosen.any(axis=1))
                bits = pa.array([row.tobytes() for row in np.packbits(chosen[some], axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(some)), batch.column(1).take(pa.array(some)), bits], ["query", "vector", "opened"]
                )

    names = ["query", "vector"] + (["opened", "floor"] if more else [])
    return queries.select(*names).mapInArrow(choose, f"query {kind}, vector array<double>, opened binary")


def _bits(opened, n: int) -> np.ndarray:
    """Rows of packed bits as truth values, one column for each of ``n`` cells."""
    packed = np.frombuffer(b"".join(opened.to_pylist()), np.uint8).reshape(len(opened), -1)
    return np.unpackbits(packed, axis=1, count=n).astype(bool) if len(opened) else np.zeros((0, n), bool)


def _asked_cells(probed: DataFrame, n: int) -> np.ndarray:
    """Which cells any query opens; each task sends on one row."""

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n, bool)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                seen |= _bits(batch.column(0).slice(at, 2048), n).any(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen).astype(np.int32))], ["cell"])

    rows = probed.select("opened").mapInArrow(union, "cell int").distinct().collect()  # MOST_CELLS at most
    return np.array(sorted(r.cell for r in rows), np.int64)


def _open(probed: DataFrame, path: str, cells: Cells, k: int, places: int) -> DataFrame:
    """``query, item, score``: the best k per query of each task, from the cells that ``probed`` has opened.

    Queries travel with the bits of their cells, never once for each of them.
    """
    spark = probed.sparkSession
    width, n_cells = cells.centre.shape[1], len(cells.size)
    asked = _asked_cells(probed, n_cells)
    items = stored_vectors(spark, path, asked.tolist())
    schema = T.StructType(
        [T.StructField("query", probed.schema["query"].dataType), T.StructField("item", items.schema["item"].dataType),
         T.StructField("score", T.DoubleType())]
    )
    target = to_arrow_schema(schema)
    limit = k

    def best_of(rows: pa.Table) -> _Best:
        extra = pa.array(np.zeros(len(rows), np.int64))
        return _Best(pa.table([rows["query"], rows["vector"], extra], names=["query", "vector", "extra"]), limit, width, places, schema.names)

    def add(best: _Best, opened: np.ndarray, ids: np.ndarray, vectors, numbers: np.ndarray) -> None:
        order = np.argsort(numbers, kind="stable")
        if (numbers[order] != numbers).any():
            ids, vectors, numbers = ids[order], vectors.take(pa.array(order)), numbers[order]
        edges = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True]) if len(numbers) else []
        for low, high in zip(edges, edges[1:]):
            best.add(ids[low:high], vectors.slice(low, high - low), np.flatnonzero(opened[:, numbers[low]]))

    most = max(1, PROBE_VALUES // width)
    if probed.limit(most + 1).count() <= most and PROBE_VALUES:
        sent = spark.sparkContext.broadcast(probed.toArrow())

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, opened = best_of(sent.value), _bits(sent.value["opened"], n_cells)
            for batch in batches:
                numbers = batch.column(2).to_numpy(zero_copy_only=False)
                add(best, opened, batch.column(0).to_numpy(zero_copy_only=False), batch.column(1), numbers)
            if best.kept:
                yield from best.table().cast(target).combine_chunks().to_batches(max_chunksize=10_000)

        return items.select("item", "vector", "cell").mapInArrow(scan, schema)

    # Many queries: both sides meet in slices. One of items is several cells, or a part of a large one.
    pieces = np.maximum(1, np.ceil(cells.size / ITEMS_PER_SLICE)).astype(int)
    first, at, held = np.zeros(n_cells, int), -1, ITEMS_PER_SLICE
    for cell in asked:
        if pieces[cell] > 1 or held + cells.size[cell] > ITEMS_PER_SLICE:
            at, held = at + 1, 0
        first[cell], held = at, held + cells.size[cell]
        if pieces[cell] > 1:
            at, held = at + pieces[cell] - 1, ITEMS_PER_SLICE
    slices = at + 1
    parts = query_blocks(probed, QUERIES_PER_SLICE, max(1, slices))
    of_cell = np.zeros((n_cells, slices), np.float32)
    for cell in asked:
        of_cell[cell, first[cell] : first[cell] + pieces[cell]] = 1
    kind = probed.schema["query"].dataType.simpleString()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 2048):
                batch = whole.slice(low, 2048)
                q, i = np.nonzero(_bits(batch.column(2), n_cells).astype(np.float32) @ of_cell)
                for start in range(0, len(q), 10_000):
                    part = pa.array(q[start : start + 10_000])
                    slice_ = pa.array(i[start : start + 10_000].astype(np.int32))
                    yield pa.RecordBatch.from_arrays([*(c.take(part) for c in batch.columns), slice_], ["query", "vector", "opened", "i"])

    left = probed.select("query", "vector", "opened").mapInArrow(visit, f"query {kind}, vector array<double>, opened binary, i int")
    left = left.withColumn("q", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
    of, n_pieces = (F.get(F.array(*(F.lit(int(x)) for x in numbers)), F.col("cell")) for numbers in (first, pieces))
    right = items.withColumn("i", of + F.pmod(F.xxhash64("item"), n_pieces.cast("bigint")).cast("int"))
    right = right.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def meet(asking: pa.Table, given: pa.Table) -> pa.Table:
        best = best_of(asking)
        if len(given) and len(asking):
            add(best, _bits(asking["opened"], n_cells), given["item"].to_numpy(), given["vector"], given["cell"].to_numpy())
        return best.table().cast(target)

    return left.groupBy("q", "i").cogroup(right.groupBy("q", "i")).applyInArrow(meet, schema)


def search_vector_index(
    queries: DataFrame, path: str, k: int, probes: int | None = None, exact: bool = False, query_id: str = "query_id",
    query_vector: str = "vector", item_id: str = "recipe_id", places: int = 6, recall: float = 0.95,
) -> DataFrame:
    """``(query_id, item_id, score, rank)``: the k most similar stored items of every query.

    Opens the ``probes`` cells of the nearest centres; if their number is not given, as many as found the share
    ``recall`` of the nearest vectors when the index was written. With ``exact`` it then opens every other cell whose bound
    reaches the last of the k scores found, which gives what a scan of all vectors gives. Queries without a
    vector get nothing; ties go to the smaller item.
    """
    spark = queries.sparkSession
    cells = read_cells(spark, path)
    probes = probes or cells.probes_for(recall)
    asked = queries.where(F.col(query_vector).isNotNull()).select(
        F.col(query_id).alias("query"),
        _checked(F.col(query_vector), cells.centre.shape[1]).cast("array<double>").alias("vector"),
    )
    asked = stage(_probes(asked, cells, probes, 0.0), "queries")
    found = _open(asked, path, cells, k, places)
    if exact:
        found = stage(rank_per(found, "query", "item", "score", k), "probed")
        last = found.where(F.col("rank") == k).select("query", "score")
        known = asked.join(last, "query", "left").select(
            "query", "vector", "opened", F.coalesce("score", F.lit(float("-inf"))).alias("floor")
        )
        rest = _open(stage(_probes(known, cells, probes, 2 * 10.0**-places), "probes"), path, cells, k, places)
        found = found.drop("rank").unionByName(rest)
    ranked = rank_per(found, "query", "item", "score", k)
    return ranked.select(F.col("query").alias(query_id), F.col("item").alias(item_id), "score", "rank")


def recall(found: DataFrame, exact: DataFrame, query_id: str = "query_id") -> DataFrame:
    """One row ``n_queries, n_exact, recall``: the share of the exact hits whose score the found ones reach.

    Compared by score, so that of equally near items either counts.
    """
    last = exact.groupBy(query_id).agg(F.min("score").alias("least"), F.count("*").alias("n"))
    good = found.join(last, query_id).where("score >= least").groupBy(query_id).agg(F.count("*").alias("hits"))
    return last.join(good, query_id, "left").agg(
        F.count("*").alias("n_queries"),
        F.sum("n").alias("n_exact"),
        (F.sum(F.least(F.coalesce("hits", F.lit(0)), F.col("n"))) / F.sum("n")).alias("recall"),
    )
