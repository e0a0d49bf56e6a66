import numpy as np
import pytest
from pyspark.sql import functions as F

from savora.operators import features as ft
from savora.sources.tables import read_mapping, read_table, require_rows, write_mapping


def test_columns_to_scale(spark):
    df = spark.sql(
        "select '1' recipe_id, 'n' name, 1D bayesian_rating, 1L review_count, 1D pred_a, 1D intensity_a, "
        "1D x, 2L y, 3 as small, cast(1 as float) f, true as flag"
    )
    assert ft.standard_columns(df) == ["x", "y"]
    assert ft.minmax_columns(df) == ["intensity_a"]


def test_scaling(spark):
    rows = [(1.0, 7.0, 2.0), (2.0, 7.0, 4.0), (None, 7.0, 6.0), (6.0, 7.0, 2.0)]
    df = spark.createDataFrame(rows, "x double, same double, m double")
    got = ft.scale(df, ["x", "same"], ["m"]).collect()
    x = np.array([1.0, 2.0, 6.0])
    expected = (x - x.mean()) / x.std()
    assert [r.x for r in got if r.x is not None] == pytest.approx(list(expected))
    assert [r.same for r in got] == [0.0] * 4
    assert [r.m for r in got] == [0.0, 0.5, 1.0, 0.0]
    assert ft.scale(df, (), ["same"]).first().same == 0.0
    with pytest.raises(ValueError):
        ft.scale(df)


def test_scaling_fitted_elsewhere(spark):
    df = spark.createDataFrame([(0.0,), (10.0,)], "m double")
    fit = spark.createDataFrame([(0.0,), (20.0,)], "m double")
    assert [r.m for r in ft.scale(df, minmax=["m"], fit_on=fit).collect()] == [0.0, 0.5]


def test_vocabulary_and_ties(spark):
    df = spark.createDataFrame([("a a b",), ("c b",), (None,), ("d",)], "t string")
    assert ft.vocabulary(df, "t", 3) == ["a", "b", "c"]


def test_indicators(spark):
    df = spark.createDataFrame([(1, "low-fat x x"), (2, "low_fat"), (3, None)], "i int, t string")
    got = ft.with_indicators(df, "t", "cat").orderBy("i").collect()
    assert [(r.cat_low_fat, r.cat_x) for r in got] == [(1, 1), (1, 0), (0, 0)]
    assert got[0].t == "low-fat x x"
    long = ft.indicators_long(df, "i", "t", "cat", ft.top_tokens(df, "t"))
    assert sorted(map(tuple, long.collect())) == [(1, "cat_low_fat"), (1, "cat_x"), (2, "cat_low_fat")]


def test_tokens_that_differ_in_case_share_a_column(spark, tmp_path):
    df = spark.createDataFrame([(1, "Low x Low"), (2, "low"), (3, "x")], "i int, t string")
    wide = ft.with_indicators(df, "t", "cat")
    assert wide.columns == ["i", "t", "cat_Low", "cat_x"]
    wide.write.parquet(str(tmp_path / "wide"))
    assert [r.cat_Low for r in wide.orderBy("i").collect()] == [1, 1, 0]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "7.5 a`b")], "i int, t string").withColumn("x.y", F.lit(2.0))
    wide = ft.with_indicators(ft.scale(df, ["x.y"]), "t", "ing")
    groups = ft.feature_groups(wide.columns, ["x.y"])
    vector = F.array(*map(ft.named, groups.meta))
    assert wide.select(vector).first()[0] == [0.0, 1.0, 1.0]


def test_search_table(spark):
    df = spark.createDataFrame(
        [(0.0, None, "a_b c"), (0.3, " x  y ", None)],
        "pred_a double, tags_clean string, ingredients_clean string",
    )
    assert [tuple(r) for r in ft.search_table(df).collect()] == [
        (False, [], ["a b", "c"]),
        (True, ["x", "y"], []),
    ]


def test_groups_and_assembly(spark):
    df = spark.sql(
        "select '1' recipe_id, 'n' name, 4.5D bayesian_rating, 'text' tags_clean, 1D n1, 2D n2, "
        "0.5D pred_a, 0.25D intensity_a, 1 as cat_x, 0 as ing_y"
    )
    groups = ft.feature_groups(df.columns, ["n2", "n1"])
    assert groups.meta == ("n2", "n1", "cat_x", "ing_y") and groups.tag == ("pred_a", "intensity_a")
    row = ft.assemble(df, groups).first()
    assert (row.meta, row.tag, row.target) == ([2.0, 1.0, 1.0, 0.0], [0.5, 0.25], 4.5)
    with pytest.raises(ValueError, match="missing_one"):
        ft.feature_groups(df.columns, ["missing_one"])
    index = {r.feature: r.idx for r in ft.feature_index(df, groups).collect()}
    assert index["pred_a"] == 4 and index["n2"] == 0


def test_mapping_round_trip(spark, tmp_path):
    df = spark.sql("select 1 recipe_id, 'n' name, 't' tags_clean, 2D x, 1 as `cat_é`")
    mapping = ft.column_mapping(df)
    write_mapping(mapping, str(tmp_path / "m"))
    back = {r.feature: r.idx for r in read_mapping(spark, str(tmp_path / "m")).collect()}
    assert back == {"tags_clean": 0, "x": 1, "cat_é": 2}


def test_report(spark):
    df = spark.createDataFrame([("1", 1.0, True), ("1", 3.0, False)], "recipe_id string, x double, b boolean")
    row = ft.feature_report(df).first()
    assert (row["items"], row.numeric_columns, row.feature) == (1, 1, "x")
    assert (row["mean"], row["min"], row["max"]) == (2.0, 1.0, 3.0)
    assert row["std"] == pytest.approx(2**0.5)


def test_empty_table_is_refused(spark, tmp_path):
    path = str(tmp_path / "empty")
    spark.range(0).write.parquet(path)
    with pytest.raises(ValueError, match="empty"):
        require_rows(read_table(spark, path), path)


def test_nan_is_read_as_null(spark, tmp_path):
    path = str(tmp_path / "nan")
    spark.sql("select double('nan') x, float('nan') y, 1 z").write.parquet(path)
    assert tuple(read_table(spark, path).first()) == (None, None, 1)
    assert read_table(spark, path).where(F.col("x").isNull()).count() == 1
