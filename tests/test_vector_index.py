import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.compare import both_sides, database
from checks.oracle import ORACLE
from checks.queries import d3_semantic
from savora.operators import nearest as nn
from savora.operators import vector_index as vi
from tests.test_nearest import brute


@pytest.fixture(scope="module")
def data():
    """Clusters, one of them with a third of all rows, copies, a zero vector."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 6))
    near = np.concatenate([c + 0.3 * rng.normal(size=(30, 6)) for c in centres] + [centres[0] + 0.2 * rng.normal(size=(200, 6))])
    items = [(f"i{n:04d}", [float(x) for x in v]) for n, v in enumerate(near)]
    items += [("zero", [0.0] * 6)] + [(f"copy{n}", items[0][1]) for n in range(40)]
    queries = [(n, [float(x) for x in c + 0.3 * rng.normal(size=6)]) for n, c in enumerate(np.repeat(centres, 3, axis=0))]
    return queries + [(99, [0.0] * 6), (98, items[0][1])], items


@pytest.fixture(scope="module")
def stored(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("vectors"))
    items = spark.createDataFrame(data[1], "recipe_id string, embedding array<double>").withColumns({"cell": F.lit("x"), "away": F.lit(1)})
    none = spark.createDataFrame([("none", None)], "recipe_id string, embedding array<double>")
    vi.write_vector_index(items.unionByName(none, allowMissingColumns=True), path, n_cells=15)
    return path


@pytest.mark.parametrize("way,probes", [("broadcast", 1), ("by cell", 4)])
def test_exact_search_equals_a_scan(spark, data, stored, way, probes, monkeypatch):
    if way == "by cell":
        monkeypatch.setattr(vi, "PROBE_VALUES", 0)
        monkeypatch.setattr(vi, "ITEMS_PER_SLICE", 25)
        monkeypatch.setattr(vi, "QUERIES_PER_SLICE", 3)
    queries, items = data
    q = spark.createDataFrame([*queries, (7000, None)], "query_id bigint, vector array<double>")
    got = vi.search_vector_index(q, stored, 7, probes=probes, exact=True).collect()
    assert sorted(map(tuple, got)) == sorted(brute(queries, items, 7))
    assert vi.search_vector_index(q, stored, 700, probes=probes, exact=True).groupBy("query_id").count().where(f"count != {len(items)}").count() == 0


def test_probed_cells_only(spark, data, stored):
    queries, items = data
    q = spark.createDataFrame(queries, "query_id bigint, vector array<double>")
    i = spark.createDataFrame(items, "recipe_id string, embedding array<double>")
    exact = nn.top_k_cosine(q, i, 5)
    shares = [vi.recall(vi.search_vector_index(q, stored, 5, probes=p), exact).first() for p in (1, 5, 15)]
    assert [r.n_queries for r in shares] == [38] * 3 and [r.n_exact for r in shares] == [190] * 3
    assert shares[0].recall <= shares[1].recall <= shares[2].recall == 1.0 and shares[1].recall >= 0.9
    cells = vi.read_cells(spark, stored)
    assert cells.shares[-1] == 1.0 and cells.probes_for(1.0) <= 15 and cells.shares[cells.probes_for(0.9) - 1] >= 0.9
    assert vi.recall(vi.search_vector_index(q, stored, 5), exact).first().recall >= 0.9
    plan = vi.stored_vectors(spark, stored, [1, 3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "cell" in plan.split("PartitionFilters")[1].split("]")[0]
    assert vi.stored_vectors(spark, stored, [1, 3]).select("cell").distinct().count() <= 2


def test_no_items_and_no_queries(spark, data, tmp_path):
    queries, items = data
    i = spark.createDataFrame(items, "recipe_id string, embedding array<double>")
    q = spark.createDataFrame(queries, "query_id bigint, vector array<double>")
    vi.write_vector_index(i, str(tmp_path / "a"))
    assert vi.search_vector_index(q.limit(0), str(tmp_path / "a"), 3, exact=True).count() == 0
    ragged = spark.createDataFrame([(1, [1.0])], "query_id bigint, vector array<double>")
    with pytest.raises(Exception, match="vectors must have 6 numbers"):
        vi.search_vector_index(ragged, str(tmp_path / "a"), 3).collect()


@pytest.mark.parametrize("values", [0, 4_000_000])
def test_queries_travel_once_whatever_they_open(spark, data, stored, values, monkeypatch):
    monkeypatch.setattr(vi, "PROBE_VALUES", values)
    queries, _ = data
    q = spark.createDataFrame(queries, "query string, vector array<double>")
    cells = vi.read_cells(spark, stored)
    probed = vi._probes(q, cells, 9, 0.0)
    assert probed.count() == len(queries)
    assert vi._bits(probed.toArrow()["opened"], 15).sum(axis=1).tolist() == [9] * len(queries)
    found = vi._open(probed, stored, cells, 4, 6)
    if not values:  # candidates of a slice, not of each cell
        assert found.count() == 4 * len(queries)


def test_suppliers_and_vectors_ask(spark, tmp_path):
    rng = np.random.default_rng(4)
    vectors = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(3)], "vec_id bigint, embedding array<float>")
    for name, keys in (("more", [1, 2, 3, 7, None]), ("fewer", [1])):
        at = tmp_path / name
        at.mkdir()
        pq.write_table(vectors.toArrow(), at / "embeddings.parquet")
        pq.write_table(spark.createDataFrame([(k,) for k in keys], "s_suppkey bigint").toArrow(), at / "supplier.parquet")
        ours, theirs, problems = both_sides(d3_semantic(spark, str(at)), database(str(at)), ORACLE["d3_semantic"])
        assert not problems and ours == theirs
        assert len(ours) == 3 * len({0, 1, 2} | {k for k in keys if k is not None}), "each gets all three vectors"
