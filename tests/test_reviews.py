import pytest
from pyspark.sql import functions as F

from savora.operators import reviews as rv
from savora.operators.merge import merge, overlap, validate_merge

SCHEMA = "recipe_id string, rating double, pred_a int, sim_a double"


def as_map(df, key="recipe_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_shares_and_intensities(spark):
    rows = [("1", 5.0, 1, 0.5), ("1", 3.0, 0, 0.9), ("1", None, None, 0.1), ("2", None, 0, 0.7)]
    got = as_map(rv.review_totals(spark.createDataFrame(rows, SCHEMA)))
    assert got["1"]["raw_mean_rating"] == 4.0 and got["1"]["review_count"] == 2
    assert got["1"]["pred_a"] == 0.5 and got["1"]["intensity_a"] == 0.5
    # Nothing rated and nothing tagged: the gaps are 0.
    assert got["2"]["raw_mean_rating"] == 0.0 and got["2"]["review_count"] == 0
    assert got["2"]["intensity_a"] == 0.0


def test_threshold_is_interpolated(spark):
    counts = spark.createDataFrame([(1,), (2,), (3,), (10,)], "review_count bigint")
    assert rv.count_threshold(counts).first()[0] == 1.75


def test_recipe_level(spark):
    rows = [("1", 5.0, 1, 0.5)] * 3 + [("2", 1.0, 0, 0.2)]
    got = as_map(rv.recipe_level(spark.createDataFrame(rows, SCHEMA)))
    assert set(got) == {"1"}, "an item without any tag is dropped"
    m, c = 1.5, 4.0  # threshold and global mean include the dropped item
    assert got["1"]["bayesian_rating"] == pytest.approx((3 * 5 + m * c) / (3 + m))
    assert c <= got["1"]["bayesian_rating"] <= 5


def test_single_item_and_given_threshold(spark):
    df = spark.createDataFrame([("1", 4.0, 1, 0.5)], SCHEMA)
    assert rv.recipe_level(df).first().bayesian_rating == 4.0
    assert rv.recipe_level(df, threshold=0.0).first().bayesian_rating == 4.0


def test_no_ratings_give_no_smoothed_rating(spark):
    df = spark.createDataFrame([("1", None, 1, 0.5)], SCHEMA)
    assert rv.recipe_level(df).first().bayesian_rating is None


def test_without_tags_nothing_remains(spark):
    df = spark.createDataFrame([("1", 4.0)], "recipe_id string, rating double")
    assert rv.recipe_level(df).count() == 0


def test_equal_ids_in_two_spellings(spark):
    df = spark.createDataFrame([("38", 5.0, 1, 0.5), ("38.0", 1.0, 1, 0.5)], SCHEMA)
    assert rv.recipe_level(df).count() == 2
    once = rv.recipe_level(df, normalise_first=True).collect()
    assert len(once) == 1 and once[0].raw_mean_rating == 3.0
    items = spark.createDataFrame([("38", "soup")], "recipe_id string, name string")
    assert merge(items, rv.recipe_level(df)).count() == 2, "the join repeats the item"


def test_null_ids_form_one_group(spark):
    df = spark.createDataFrame([(None, 5.0, 1, 0.5), (None, 3.0, 1, 0.5)], SCHEMA)
    got = rv.recipe_level(df).collect()
    assert len(got) == 1 and got[0].review_count == 2


def test_columns_are_ordered(spark):
    schema = "recipe_id string, rating double, pred_b int, sim_b double, pred_a int, sim_a double"
    df = spark.createDataFrame([("1", 4.0, 1, 0.1, 0, 0.2)], schema)
    assert rv.recipe_level(df).columns == [
        "recipe_id", "raw_mean_rating", "review_count", "bayesian_rating",
        "pred_a", "pred_b", "intensity_a", "intensity_b",
    ]


def test_bayesian_rating_column(spark):
    df = spark.createDataFrame([(4.0, 1), (2.0, 3)], "rating double, review_count bigint")
    got = df.select(rv.bayesian_rating(df, F.lit(3.0), "rating")).collect()
    assert got[0][0] == pytest.approx((4 + 1.5 * 3) / 2.5)


def test_merge_renames_shared_names(spark):
    left = spark.createDataFrame([("1.0", "l", 5)], "recipe_id string, x string, a int")
    right = spark.createDataFrame([("1", "r", 6)], "recipe_id string, x string, b int")
    assert merge(left, right).first().asDict() == {"recipe_id": "1", "x_x": "l", "a": 5, "x_y": "r", "b": 6}


def test_overlap(spark):
    left = spark.createDataFrame([(i,) for i in (1, 2, 2, 3)], "recipe_id int")
    right = spark.createDataFrame([("2",), ("9",)], "recipe_id string")
    assert validate_merge(left, right) == {"left_ids": 3, "right_ids": 2, "shared_ids": 1}
    with pytest.raises(ValueError):
        validate_merge(left, spark.createDataFrame([("x",)], "recipe_id string"))
    assert overlap(left, left).first().shared_ids == 3


def test_many_ids_that_are_no_numbers_on_both_sides(spark):
    left = spark.range(20_000).select(
        F.when(F.col("id") < 19_990, F.concat(F.lit("x"), "id")).otherwise(F.col("id").cast("string")).alias("recipe_id"), F.col("id").alias("l")
    )
    right = spark.range(200).select(
        F.when(F.col("id") < 195, F.concat(F.lit("y"), "id")).otherwise((F.col("id") + 19_795).cast("string")).alias("recipe_id"), F.col("id").alias("r")
    )
    joined = merge(left.repartition(8), right.repartition(4))
    counts = {r.recipe_id == "0": r.n for r in joined.groupBy((F.col("recipe_id") == "0").alias("x")).agg(F.count("*").alias("n")).select(F.when(F.col("x"), "0").otherwise("1").alias("recipe_id"), "n").collect()}
    assert counts[True] == 19_990 * 195 and counts[False] == 5
    assert joined.where("recipe_id = '0'").select("l", "r").distinct().count() == 19_990 * 195
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shuffled = merge(left, right).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in shuffled) < 0.4 * 19_990 * 195
