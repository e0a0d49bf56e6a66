"""Periodic runs against all periods at all places."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from savora.llm import queries, runs
from tests.llm import brute

COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def found(texts, least):
    made = runs.runs_of([t.encode().split() for t in texts], least)
    return [list(zip(*(x.tolist() for x in r), strict=True)) for r in made]


@pytest.mark.parametrize("least", [1, 2, 5, 12])
def test_random_words(least):
    pick = random.Random(least)
    texts = ["", "a", "a a", "a b a b", "spam " * 300, "a b " * 40 + "a a " * 40]
    for _ in range(400):
        few = "abcdefghij"[: pick.randrange(1, 10)]
        part = pick.choices(few, k=pick.randrange(1, 12))
        texts.append(" ".join(pick.choices(few, k=pick.randrange(40)) + part * pick.randrange(1, 9) + pick.choices(few, k=pick.randrange(20))))
    a, b = "x", "x y"
    for _ in range(10):
        a, b = b, f"{b} {a}"  # Fibonacci words hold runs of many periods
    texts += [b, " ".join("ab"[i.bit_count() % 2] for i in range(512))]
    assert found(texts, least) == [brute.runs(t.split(), least) for t in texts]


def test_a_few_candidates_at_a_time(monkeypatch):
    monkeypatch.setattr(runs, "CANDIDATES", 7)
    text = "q " + "a b c d a b c e " * 9 + "b " * 30
    assert found([text, text[2:]], 12) == [brute.runs(t.split()) for t in (text, text[2:])]


def test_grammar_derives_the_text():
    pick = random.Random(4)
    seq = np.array(pick.choices(range(5), k=700) * 2 + [5] * 33)
    g = runs.re_pair(seq, 6)

    def expand(x):
        return [x] if x < 6 else expand(g.left[x - 6]) + expand(g.right[x - 6])

    assert [w for x in g.top for w in expand(x)] == seq.tolist()
    pairs = list(zip(g.top.tolist(), g.top.tolist()[1:], strict=False))
    assert len(set(pairs)) == len(pairs)
    assert len({*zip(g.left.tolist(), g.right.tolist(), strict=True)}) == len(g.left)
    assert all(expand(6 + k) == seq[p : p + g.length[6 + k]].tolist() for k, p in enumerate(g.at))


def test_a_very_long_text():
    part = [f"w{i % 977}" for i in range(60_000)]
    (got,) = found([" ".join(part)], 12)
    assert got == [(0, 60_000, 977)]


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b " * 6), (4, "A b " * 6), (None, "x " * 11), (7, "x\x0b" * 12), (8, "é\xa0ü " * 13)]
    extra = {c: F.lit("x") for c in ("runs", "n_words", "collapsed")}
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(extra)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.word_runs(df).collect()), key=repr)
    words = [(d, brute.re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    want = [(d, len(w), brute.runs(w), brute.collapsed(w, brute.runs(w))) for d, w in words]
    assert got == sorted(want, key=repr)
    assert runs.word_runs(df.where("false")).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [r for r in duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall() if len(r[1] or "") < 8_000]
    got = {r.doc_id: tuple(r) for r in queries.op12_runs(spark, folder).select(*COLUMNS).collect()}
    want = brute.op12(docs)
    assert [got[w[0]] for w in want] == want and sum(w[1] > 0 for w in want) > 10
