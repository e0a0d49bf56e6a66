import numpy as np
import pyarrow as pa
import pytest

from savora.operators import nearest as nn


def brute(queries, items, k, exclude=()):
    def unit(v):
        n = np.linalg.norm(v)
        return np.asarray(v) / n if n else np.zeros(len(v))

    out = []
    for q, v in queries:
        scored = [(round(float(unit(v) @ unit(w)), 6) + 0.0, i) for i, w in items if (q, i) not in exclude]
        scored.sort(key=lambda t: (-t[0], t[1]))
        out += [(q, i, s, r + 1) for r, (s, i) in enumerate(scored[:k])]
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    items = [(f"i{n:03d}", [float(x) for x in rng.integers(-2, 3, 6)]) for n in range(300)]
    items += [("zero", [0.0] * 6)] + [(f"copy{n}", items[0][1]) for n in range(150)]
    queries = [(n, [float(x) for x in rng.normal(size=6)]) for n in range(25)] + [(99, [0.0] * 6), (98, items[0][1])]
    return queries, items


@pytest.mark.parametrize("way", ["broadcast", "blocks", "small blocks in tasks"])
def test_against_brute_force(spark, data, way, monkeypatch):
    if way == "blocks":
        monkeypatch.setattr(nn, "QUERY_VALUES", 60)
        monkeypatch.setattr(nn, "ITEMS_PER_BLOCK", 90)
    queries, items = data
    q = spark.createDataFrame(queries, "query_id bigint, vector array<double>")
    i = spark.createDataFrame(items, "recipe_id string, embedding array<double>").repartition(3)
    got = nn.top_k_cosine(q, i, 7).collect()
    assert sorted(map(tuple, got)) == sorted(brute(queries, items, 7))


def test_more_wanted_than_there_are(spark, data):
    queries, items = data[0][:2], data[1][:3]
    q = spark.createDataFrame(queries, "query_id bigint, vector array<double>")
    i = spark.createDataFrame(items, "recipe_id string, embedding array<float>")
    assert nn.top_k_cosine(q, i, 10).count() == 6
    assert nn.top_k_cosine(q.limit(0), i, 10).count() == 0
    assert nn.top_k_cosine(q, i.limit(0), 10).count() == 0


def test_session_without_its_own_items(spark, data):
    _, items = data
    seeds = [(1, "i000"), (1, "i001"), (2, "i005"), (3, "absent"), (2, "absent")]
    seeds += [(4, i) for i, _ in items[:200]]
    vectors = dict(items)
    means = {}
    for s in (1, 2, 4):
        means[s] = np.mean([vectors[i] for t, i in seeds if t == s and i in vectors], axis=0)
    s = spark.createDataFrame(seeds, "session_id int, recipe_id string")
    i = spark.createDataFrame(items, "recipe_id string, embedding array<double>")
    got = nn.session_neighbours(s, i, 5).collect()
    assert sorted(map(tuple, got)) == sorted(brute(means.items(), items, 5, set(seeds)))


def test_rank_limit_is_applied_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 as q", "id as i", "double(id) as s")
    plan = nn.rank_per(df, "q", "i", "s", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("most", [nn.QUERY_VALUES, 2])
def test_missing_and_ragged_vectors(spark, monkeypatch, most):
    monkeypatch.setattr(nn, "QUERY_VALUES", most)
    items = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", None), ("c", [0.0, 1.0]), ("d", [None, 1.0])], "recipe_id string, embedding array<double>"
    )
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, None]), (4, [0.0, 2.0])], "query_id int, vector array<double>")
    got = {(r.query_id, r["rank"]): (r.recipe_id, r.score) for r in nn.top_k_cosine(queries, items, 2).collect()}
    assert got == {
        (1, 1): ("a", 1.0), (1, 2): ("c", 0.0), (3, 1): ("a", 0.0), (3, 2): ("c", 0.0), (4, 1): ("c", 1.0), (4, 2): ("d", 1.0)
    }
    assert nn.top_k_cosine(queries, items.limit(0), 2).count() == 0
    sessions = spark.createDataFrame([("s", "b"), ("t", "a"), ("t", "b")], "session_id string, recipe_id string")
    assert {r.session_id for r in nn.session_neighbours(sessions, items, 1).collect()} == {"t"}
    ragged = queries.unionByName(spark.createDataFrame([(9, [1.0])], queries.schema))
    with pytest.raises(Exception, match="vectors must have 2 numbers, this one has 1"):
        nn.top_k_cosine(ragged, items, 2).collect()


def test_equal_vectors_are_scored_once(spark, monkeypatch):
    """Items that share a vector give the hits of a scan over all of them, with exclusions and ties."""
    rng = np.random.default_rng(3)
    kinds = [v.tolist() for v in rng.normal(size=(6, 4))] + [[0.0] * 4] * 2
    items = [(i, kinds[i * 7 % 8]) for i in range(80)] + [(99, None)]
    queries = [(q, rng.normal(size=4).tolist()) for q in range(5)] + [(7, [0.0] * 4)]
    seen = [(q, i) for q in range(5) for i in range(q * 9, q * 12)]
    df = spark.createDataFrame(items, "recipe_id int, embedding array<float>")
    asked = spark.createDataFrame(queries, "query_id int, vector array<float>")
    exclude = spark.createDataFrame(seen, "query_id int, recipe_id int")
    scanned, scan = [], nn._scan

    def counted(rows, given, *more):
        scanned.append(given.count())
        return scan(rows, given, *more)

    monkeypatch.setattr(nn, "_scan", counted)
    for k in (1, 7, 30):
        got = nn.top_k_cosine(asked, df, k, exclude=exclude).collect()
        with monkeypatch.context() as m:
            m.setattr(nn, "distinct_vectors", lambda *a: None)
            expected = nn.top_k_cosine(asked, df, k, exclude=exclude).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, expected))
    assert scanned[0] == 7
    sessions = spark.createDataFrame([(q % 3, i) for q, i in seen], "session_id int, recipe_id int")
    got = {r.session_id: r.vector for r in nn.session_vectors(sessions, df).collect()}
    for s, vector in got.items():
        own = [np.float32(kinds[i * 7 % 8]).astype(float) for q, i in seen if q % 3 == s]
        assert np.allclose(vector, np.mean(own, axis=0))
    assert len(got) == 3


def test_vectors_are_unpacked_in_blocks(monkeypatch):
    """What a task holds in double precision besides the queries is a block, however many items it is given."""
    rng = np.random.default_rng(5)
    items, asked = rng.normal(size=(700, 3)), rng.normal(size=(90, 3))
    monkeypatch.setattr(nn, "QUERY_BLOCK", 40)
    monkeypatch.setattr(nn, "ITEM_BLOCK", 50)
    monkeypatch.setattr(nn, "CANDIDATES", 7)
    unpacked, matrix = [], nn._matrix
    monkeypatch.setattr(nn, "_matrix", lambda column, width: unpacked.append(len(column)) or matrix(column, width))
    table = pa.table([np.arange(90), pa.array(asked.tolist()), np.zeros(90, np.int64)], names=["q", "v", "extra"])
    best = nn._Best(table, 4, 3, 6, ["q", "i", "s"])
    best.add(np.arange(700), pa.array(items.tolist()))
    got = [tuple(r.values()) for r in best.table().to_pylist()]
    assert max(unpacked) == 50
    assert sorted(got) == sorted((q, i, s) for q, i, s, _ in brute(enumerate(asked), list(enumerate(items)), 4))
    some = nn._Best(table, 4, 3, 6, ["q", "i", "s"])
    some.add(np.arange(700), pa.array(items.tolist()), np.array([3, 39, 40, 81]))
    assert [tuple(r.values()) for r in some.table().to_pylist()] == [r for r in got if r[0] in (3, 39, 40, 81)]
