"""The pipeline's stages on edge cases, and all of it against plain versions of what each stage decides."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from savora.llm import factorization
from tests.llm import brute

BASE = " ".join(f"word{i}" for i in range(60))
LONG = "a very long text of few words " * 60_000
ROWS = [
    (0, BASE), (1, BASE), (2, "  " + BASE + "\n"), (3, BASE.replace("word30 ", "other ")), (4, None), (5, ""), (6, " \t\n"),
    (7, "tiny"), (8, "tiny"), (None, "no id"), (None, "no id"), (10, "spam " * 300), (10, "another text of one id"), (11, LONG),
    (12, BASE + " " + " ".join(f"more{i}" for i in range(200))), (13, "x<|endoftext|> y\r\n\n 'll don't"),
]
ITEMS = [(1, " ".join(f"more{i}" for i in range(20, 40))), (2, None), (3, ""), (4, "spam " * 12)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def docs(spark):
    """With columns of the names that the stages use themselves."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    names = ("lang", "source", "__gone_0", "__gone_1", "__digest", "__score", "__spans", "__items", "digest", "kept", "bucket")
    return df.withColumns({c: F.lit("x") for c in names})


@pytest.mark.parametrize("step", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_columns_and_take_empty_tables(spark, folder, step):
    rows = docs(spark)
    got = step[1](spark, rows, folder)
    assert got.dtypes == rows.dtypes and 0 < got.count() <= len(ROWS)
    none = step[1](spark, rows.where("false"), folder)
    assert none.dtypes == rows.dtypes and none.count() == 0


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_exact_copies(spark, folder):
    got = texts(corpus_pipeline.exact_copies(spark, docs(spark), folder))
    kept = [row for row, b in zip(ROWS, brute.exact(ROWS), strict=True) if b[3]]
    assert got == sorted(kept, key=repr)


def test_near_copies(spark, folder):
    given = [r for r in ROWS if r[0] not in (None, 10)]
    got = texts(corpus_pipeline.near_copies(spark, docs(spark).where("doc_id is not null and doc_id != 10"), folder))
    assert got == sorted((row for row, b in zip(given, brute.near(given, 5, 80), strict=True) if b[3]), key=repr)
    assert sum(d is None for d, _ in texts(corpus_pipeline.near_copies(spark, docs(spark), folder))) == 2


def test_benchmark_passages(spark, folder):
    got = dict((repr(d), t) for d, t in texts(corpus_pipeline.benchmark_passages(spark, docs(spark), folder)) if d != 10)
    assert "more19" in got["12"] and "more20" not in got["12"] and "more40" in got["12"] and got["4"] is None
    assert (10, "spam " * 300) not in texts(corpus_pipeline.benchmark_passages(spark, docs(spark), folder))


def test_token_ids(spark, folder):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted(map(tuple, corpus_pipeline.token_ids(spark, docs(spark), folder).collect()), key=repr)
    want = []
    for doc_id, text in ROWS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), ids, brute.sha(t.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=repr)


def test_quality_lets_good_documents_pass(spark, folder, monkeypatch):
    rows = spark.createDataFrame(
        [(i, ("fine words of prose " if i % 2 else "$$$ click here now ") + f"number{i}") for i in range(200)], "doc_id long, text string"
    )
    labels = rows.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    machine = factorization.fit_quality(rows.where("doc_id < 150"), labels)
    assert {r.doc_id for r in factorization.keep_good(rows, machine).collect()} == set(range(1, 200, 2))


def test_whole_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids", "text_sha256"]
    # One label only: every document is as good as that one.
    left = {r.doc_id for r in got.collect()}
    assert {0, 1, 2, 3} & left == {0} or {0, 1, 2, 3} & left == {2}
    assert {7, 11, 12, 13, None} <= left and 8 not in left
