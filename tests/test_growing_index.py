import random

import pytest
from pyspark.sql import functions as F

from savora.operators import bounded_search as bs
from savora.operators import search as se
from savora.operators import segments as sg
from savora.session import stage
from savora.sources.tables import numbered_folders


def texts(seed, n):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(pick.choices(words, weights=[1 / (k + 1) for k in range(60)], k=pick.randrange(1, 60)))) for i in range(n)]
    return rows + [(n, ""), (n + 1, None), (n + 2, "the only one")]


QUERIES = [(1, "w1 w3 w3 w50"), (2, "only W2"), (3, "nothing known"), (4, "w0"), (5, None)]


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id int, text string")


def hits(df):
    return sorted(map(tuple, df.select("query_id", "doc_id", "lexical", "rank").collect()))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("pool,per_block", [(3, 4), (1000, 64)])
def test_bounds_give_the_same_hits(spark, queries, tmp_path, pool, per_block):
    docs = table(spark, texts(1, 400))
    index = stage(se.postings(docs), "postings")
    bs.write_bounded_index(index, str(tmp_path), buckets=4, docs_per_block=per_block)
    opened = bs.bounded_top(spark, str(tmp_path), queries, pool)
    assert hits(opened.hits) == hits(se.bm25(docs, queries, pool))
    every = index.join(se.query_terms(queries), "term").count()
    read = opened.postings.count()
    assert read < 0.6 * every if pool == 3 else read <= every


def test_added_replaced_and_removed_documents(spark, queries, tmp_path):
    path = str(tmp_path / "index")
    first, second, third = dict(texts(2, 60)), dict(texts(3, 40)), {7: "w50 w50 w1", 500: "only w2", 3: ""}
    sg.update(path, table(spark, list(first.items())), buckets=4)
    sg.update(path, table(spark, list(second.items())), removed=spark.createDataFrame([(50,), (51,), (9999,)], "doc_id bigint"))
    sg.update(path, table(spark, list(third.items())), removed=spark.createDataFrame([(7,), (10,)], "doc_id bigint"))
    live = {**first, **second}
    for gone in (50, 51, 10):
        del live[gone]
    live.update(third)
    wanted = se.query_terms(queries)
    expected = hits(se.bm25(table(spark, list(live.items())), queries, 30))
    for only in (None, wanted):
        index = sg.open_index(spark, path, only)
        assert hits(se.bm25_top(index, wanted, 30)) == expected
    built = se.postings(table(spark, list(live.items())))
    assert index.stats.first().asDict() == pytest.approx(se.corpus_stats(built).first().asDict())
    assert set(sg.open_index(spark, path).frequencies.collect()) == set(se.document_frequencies(built).collect())
    # A segment that was not finished does not count.
    table(spark, [(1, "x")]).write.parquet(f"{path}/0/9/postings")
    assert hits(se.bm25_top(sg.open_index(spark, path), wanted, 30)) == expected
    sg.compact(spark, path)
    assert numbered_folders(spark, path) == [0, 1] and numbered_folders(spark, f"{path}/1") == [0]
    assert hits(se.bm25_top(sg.open_index(spark, path, wanted), wanted, 30)) == expected
    sg.update(path, table(spark, [(7, "w0")]), removed=spark.createDataFrame([(500,)], "doc_id bigint"))
    live[7] = "w0"
    del live[500]
    assert hits(se.bm25_top(sg.open_index(spark, path), wanted, 30)) == hits(se.bm25(table(spark, list(live.items())), queries, 30))
    with pytest.raises(FileNotFoundError):
        sg.open_index(spark, str(tmp_path / "nowhere"))


def test_removing_everything(spark, queries, tmp_path):
    path = str(tmp_path / "index")
    docs = table(spark, [(1, "w0 w1"), (2, "w0")])
    sg.update(path, docs)
    sg.update(path, docs.where("false"), removed=docs.select("doc_id"))
    assert se.bm25_top(sg.open_index(spark, path), se.query_terms(queries), 5).count() == 0
    assert sg.open_index(spark, path).stats.first()["n_docs"] == 0
    assert sg.open_index(spark, path).frequencies.where(F.col("df") != 0).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_segments_that_live_or_died_as_a_whole_are_not_joined(spark, queries, tmp_path):
    """All documents are replaced in two steps: no posting is looked up by its document, until one of a segment goes."""
    path, rows = str(tmp_path / "index"), texts(5, 30)
    docs, even = table(spark, rows), F.col("doc_id") % 2 == 0
    sg.update(path, table(spark, [(i, f"old w1 w1 {i}") for i, _ in rows]), buckets=4)
    sg.update(path, docs.where(even), removed=docs.where(~even))
    sg.update(path, docs.where(~even))
    wanted = se.query_terms(queries)
    for more in ([], [(4, "w1 w1 w2")]):
        if more:
            sg.update(path, table(spark, more), removed=table(spark, [(9, "")]))
        now = {**dict(rows), **dict(more)}
        if more:
            del now[9]
        live = table(spark, list(now.items()))
        index = sg.open_index(spark, path)
        assert ("Join" in plan_of(index.postings)) == bool(more)
        assert sorted(index.postings.collect()) == sorted(se.postings(live).where("term is not null").collect())
        assert set(index.frequencies.collect()) == set(se.document_frequencies(se.postings(live)).collect())
        assert hits(se.bm25_top(index, wanted, 9)) == hits(se.bm25(live, queries, 9))
    assert "Exchange" not in plan_of(sg._postings(docs.repartition(100), "doc_id", "text")).split("Exchange RoundRobin")[0]


def test_only_postings_of_the_wanted_terms_are_shuffled(spark, queries, tmp_path):
    se.write_index(stage(se.postings(table(spark, texts(6, 50))), "postings"), str(tmp_path), buckets=1)
    wanted = se.query_terms(queries)
    plan = plan_of(se.bm25_scores(se.read_index(spark, str(tmp_path), wanted), wanted))
    assert "LeftSemi" in plan.split("hashpartitioning(doc_id", 1)[1].split("/postings]")[0]


def test_bounded_sums_are_made_where_postings_are(spark, queries, tmp_path, monkeypatch):
    """Postings are shuffled once by document, not once for each query that asks for them."""
    docs, plans = table(spark, texts(1, 400)), {}

    def recorded(df, label):
        plans[label] = plan_of(df)
        return stage(df, label)

    monkeypatch.setattr(bs, "stage", recorded)
    bs.write_bounded_index(stage(se.postings(docs), "postings"), str(tmp_path), buckets=4, docs_per_block=4)
    assert "shares" not in plans, "postings are stored once"
    assert hits(bs.bounded_top(spark, str(tmp_path), queries, 3).hits) == hits(se.bm25(docs, queries, 3))
    assert "hashpartitioning(doc_id" in plans["open"] and "hashpartitioning(query_id" not in plans["open"]
