from math import cosh, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from savora.functions import columns as fc
from savora.functions.losses import huber, log_cosh, loss


def test_ids_are_cleaned(spark):
    cases = {
        "38": "38", "38.0": "38", " 12 ": "12", "1e3": "1000", "-3.7": "-3", ".5": "0", "+5": "5",
        "abc": "0", "1d": "0", "0x1F": "0", "inf": "0", "": "0", None: "0", "nan": "0", "True": "0",
        "1_000": "0", "2f": "0", "1e400": "0", "9007199254740993": "9007199254740993",
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r.x: r.y for r in df.withColumn("y", fc.normalised_id(F.col("x"))).collect()}
    assert got == cases


def test_numeric_ids_are_cleaned(spark):
    row = spark.range(1).select(
        fc.normalised_id(F.lit(7)).alias("a"), fc.normalised_id(F.lit(7.9)).alias("b")
    )
    assert tuple(row.first()) == ("7", "7")


def test_tokens_split_like_python(spark):
    texts = [None, "", "  a  b\tc\n", "x y", "p\x1cq", "low-fat low_fat", " wide　gap"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.k for r in df.select("i", fc.tokens(F.col("t")).alias("k")).collect()}
    assert got == {i: (t or "").split() for i, t in enumerate(texts)}
    spaced = df.where("i = 5").select(fc.spaced_tokens(F.col("t"))).first()[0]
    assert spaced == ["low-fat", "low fat"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, n int")
    assert fc.with_nulls_for_nan(df).agg(F.avg("x")).first()[0] == 2.0


def test_soft_bins(spark):
    xs = [-4.0, -3.2, -3.0, 0.1, 2.9, 3.0, 5.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select("x", fc.soft_bins(F.col("x")).alias("w")).collect()
    centres = np.linspace(-3, 3, 15)
    for r in rows:
        expected = np.maximum(0, 1 - np.abs(r.x - centres) / (centres[1] - centres[0]))
        assert np.allclose(r.w, expected, atol=1e-12)
    sums = [sum(r.w) for r in rows]
    assert np.allclose(sums, [0, 0.5333333, 1, 1, 1, 1, 0], atol=1e-6)


def test_bounded_rating_never_overflows(spark):
    df = spark.createDataFrame([(-1e6,), (0.0,), (1e6,)], "x double")
    assert [r[0] for r in df.select(fc.bounded_rating(F.col("x"))).collect()] == [1.0, 3.0, 5.0]
    back = df.select(fc.bounded_rating(fc.rating_logit(F.lit(4.2)))).first()[0]
    assert back == pytest.approx(4.2)


def test_losses(spark):
    df = spark.createDataFrame([(3.5,), (-0.5,), (800.0,)], "e double")
    got = df.select(huber(F.col("e")), log_cosh(F.col("e"))).collect()
    assert [r[0] for r in got] == pytest.approx([3.0, 0.125, 799.5])
    assert got[0][1] == pytest.approx(log(cosh(3.5)))
    assert got[2][1] == pytest.approx(800 - log(2))
    named = df.agg(loss("huber", F.col("e")), loss("no such loss", F.col("e"))).first()
    assert named[0] == named[1]


def test_cosine_of_empty_direction_is_zero(spark):
    zero, one = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(3.0), F.lit(4.0))
    row = spark.range(1).select(fc.cosine(zero, one), fc.cosine(one, one)).first()
    assert tuple(row) == (0.0, pytest.approx(1.0))


def test_ablation(spark):
    df = spark.createDataFrame([([1.0], [2.0])], "meta array<float>, tag array<float>")
    assert tuple(fc.ablate(df, "meta_only").first()) == ([1.0], [0.0])
    assert tuple(fc.ablate(df, "tag_only").first()) == ([0.0], [2.0])
    with pytest.raises(ValueError):
        fc.ablate(df, "none")


def test_tag_names_only_lose_their_prefix():
    assert fc.tag_names(["pred_a", "x_pred_b", "pred_pred_c"]) == ["a", "pred_c"]


def test_equal_ids_are_read_once(spark):
    """Raw ids are counted before they are normalised, so no more of them are parsed than there are distinct ones."""
    raw = spark.createDataFrame([(x,) for x in ["1", " 1 ", "1.5", "x", None, "x", "+1e3"] * 50], "raw string")
    counted = fc.count_normalised(raw, "raw", "id")
    assert {r.id: r.n for r in counted.collect()} == {"1": 150, "0": 150, "1000": 50}
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
