from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from savora.operators import search as se


def brute_bm25(docs, queries, k1=1.2, b=0.75):
    words = {d: t.lower().split() for d, t in docs if t and t.split()}
    n, avgdl = len(words), sum(map(len, words.values())) / len(words)
    df = Counter(t for w in words.values() for t in set(w))
    out = {}
    for q, text in queries:
        for d, w in words.items():
            tf = Counter(w)
            shared = [t for t in set(text.lower().split()) if tf[t]]
            if shared:
                out[q, d] = sum(
                    log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
                    * tf[t] / (tf[t] + k1 * (1 - b + b * len(w) / avgdl))
                    for t in shared
                )
    return out


DOCS = [
    (1, "red Soup red"), (2, "blue soup with salt"), (3, "salt " * 3000 + "red"), (4, None), (5, "  "),
    (6, "nothing here"), (7, "RED"), (8, "red"),
]
QUERIES = [(10, "Red red SALT"), (11, "unknown"), (12, "soup"), (13, None)]


@pytest.fixture
def tables(spark):
    return (
        spark.createDataFrame(DOCS, "doc_id int, text string"),
        spark.createDataFrame(QUERIES, "query_id int, text string"),
    )


def test_bm25(tables):
    docs, queries = tables
    expected = brute_bm25(DOCS, [q for q in QUERIES if q[1]])
    got = se.bm25(docs, queries, 100, places=12).collect()
    assert {(r.query_id, r.doc_id): pytest.approx(r.lexical) for r in got} == expected
    ties = [r.doc_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 10 and r.doc_id in (7, 8)]
    assert ties == [7, 8]
    assert se.bm25(docs, queries, 1).count() == 2


def test_index(spark, tables, tmp_path):
    docs, queries = tables
    index = se.postings(docs)
    assert tuple(se.corpus_stats(index).first()) == (6, pytest.approx((3 + 4 + 3001 + 2 + 1 + 1) / 6))
    path = str(tmp_path / "index")
    se.write_index(index, path, buckets=8)
    held = index.where("term is not null")
    assert sorted(map(str, se.read_index(spark, path).postings.collect())) == sorted(map(str, held.collect()))
    wanted = se.query_terms(queries)
    some = se.read_index(spark, path, wanted)
    assert some.postings.count() < held.count()
    got = se.bm25_top(some, wanted, 100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, se.bm25(docs, queries).collect()))


def test_index_of_nothing(spark, tables, tmp_path):
    docs, queries = tables
    path = str(tmp_path / "none")
    se.write_index(se.postings(docs.limit(0)), path)
    wanted = se.query_terms(queries)
    assert se.bm25_top(se.read_index(spark, path, wanted), wanted, 9).count() == 0


def test_combining_signals(spark):
    rows = [(1, "a", 2.0, 0.5, None), (1, "b", 4.0, 0.5, 1.0), (1, "c", 3.0, 0.5, 3.0), (2, "a", 9.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "query_id int, recipe_id string, x double, y double, z double")
    got = {(r.query_id, r.recipe_id): r.score for r in se.combine_scores(df, {"x": 1.0, "y": 1.0, "z": 2.0}).collect()}
    assert got == {(1, "a"): 0.0, (1, "b"): pytest.approx(0.25 + 0.5 / 3), (1, "c"): pytest.approx(0.625), (2, "a"): 0.0}


def test_ranking_by_mode(spark):
    df = spark.createDataFrame([(1, "b", 1.0), (1, "a", 1.0), (1, "c", 2.0)], "query_id int, recipe_id string, lexical double")
    ranked = se.rank_by_mode(df, "lexical", 2).orderBy("rank").collect()
    assert [r.recipe_id for r in ranked] == ["c", "a"]
    with pytest.raises(ValueError):
        se.rank_by_mode(df, "other")


def test_quality_is_clipped(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (6.0,)], "r double")
    assert [r[0] for r in df.select(se.quality(F.col("r"))).collect()] == [0.0, 0.5, 1.0]


def test_copies_are_scored_once(spark, monkeypatch):
    """Equal queries and equal texts give one scoring; the hits and their order are those of all pairs."""
    texts = ["red soup", "blue soup", "red soup", "salt", None, "Red  soup", "red"]
    docs = [(i, texts[i % len(texts)]) for i in range(70)] + [(3, "red")]
    queries = [(q, ["soup red", "RED soup red", "salt", "x"][q % 4]) for q in range(40)]
    scored, plain = [], se.bm25_scores

    def counted(index, wanted, *more):
        scored.append((index.postings.where("term is not null").select("doc_id").distinct().count(), wanted.select("query_id").distinct().count()))
        return plain(index, wanted, *more)

    df, asked = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(queries, "query_id int, text string")
    index = se.postings(df)
    for pool in (1, 4, 25, 100):
        expected = se.bm25_top(index, se.query_terms(asked), pool)
        with monkeypatch.context() as m:
            m.setattr(se, "bm25_scores", counted)
            got = se.bm25(df, asked, pool)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert scored[0] == (6, 3)
