"""SimHash near-duplicates against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from savora.llm import simhash
from tests.llm import brute

BASE = [f"w{i}" for i in range(400)]


def corpus():
    """Null, empty and blank texts, copies, a large group of near copies, a null and a repeated id, a very long text."""
    pick = random.Random(11)
    texts = [None, "", " \t\n", "a", "a b", "A\x0bB", "a b c", " ".join(BASE), " ".join(BASE).upper(), "long " * 300_000]
    for _ in range(120):
        near = list(BASE)
        for _ in range(pick.randrange(1, 3)):
            near[pick.randrange(len(near))] = f"x{pick.randrange(5)}"
        texts.append(" ".join(near))
    texts += [" ".join(pick.choices(BASE, k=pick.randrange(1, 30))) for _ in range(80)]
    rows = list(enumerate(texts, 100))
    return rows + [(None, "a b c"), (None, None), (107, "some other text of one id"), (50, "some other text of one id")]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in ("bits", "rep", "n", "mask", "key", "fingerprint", "component_id")})


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 1])
def test_groups(docs, bucket):
    got = simhash.close_groups(docs, bucket=bucket)
    want = brute.simhash(ROWS)
    assert rows(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    assert got.where(F.col("kept") != F.col("doc_id").eqNullSafe(F.col("component_id"))).count() == 0
    assert len({w[2] for w in want}) < len(want) - 60


def test_odd_distance_and_other_blocks(docs):
    got = simhash.close_groups(docs, blocks=simhash.Blocks(3, 5))
    assert rows(got, "doc_id", "component_id") == sorted(((d, c) for d, _, c in brute.simhash(ROWS, 3, 3)), key=repr)


def test_links_are_those_of_all_pairs(spark):
    pick = random.Random(2)
    center = pick.getrandbits(64)
    values = {center ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(4))) for _ in range(300)}
    values |= {pick.getrandbits(64) for _ in range(50)}
    prints = list(enumerate(sorted(values)))
    df = spark.createDataFrame([(i, simhash._signed(v)) for i, v in prints], "rep long, bits long")
    close = {(i, j) for i, x in prints for j, y in prints if i < j and (x ^ y).bit_count() <= 2}
    got = {(min(r), max(r)) for r in simhash.close_pairs(df, bucket=10**6).collect()}
    assert got == close
    crowded = {(min(r), max(r)) for r in simhash.close_pairs(df, bucket=2).collect()}
    assert crowded < close


def test_empty_table_and_dropping(docs):
    assert simhash.close_groups(docs.where("false")).count() == 0
    kept = simhash.drop_close_copies(docs)
    assert kept.columns == docs.columns
    want = {d for d, _, c in brute.simhash(ROWS) if d == c}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want
