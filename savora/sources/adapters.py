"""The driver's test tables seen as items, reviews, sessions and queries (plain projections)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from savora.plans.skew import bounded_broadcast

TAGS = ("bulk", "open", "returned")
POLARITY = {"bulk": 0, "open": 1, "returned": -1}
NUMERIC = ("size", "price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("recipe_id"),
        F.col("p_name").alias("name"),
        F.col("p_name").alias("tags_clean"),
        F.lower(
            F.concat_ws(" ", "p_type", F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")))
        ).alias("ingredients_clean"),
        F.col("p_size").cast("bigint").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def _labelled(lines: DataFrame) -> list:
    return [
        F.col("l_partkey").cast("string").alias("recipe_id"),
        (F.lit(1) + (F.col("l_quantity").cast("bigint") - 1) % 5).cast("double").alias("rating"),
        (F.col("l_returnflag") == "R").cast("int").alias("pred_returned"),
        (F.col("l_discount") * 10).alias("sim_returned"),
        (F.col("l_linestatus") == "O").cast("int").alias("pred_open"),
        (F.col("l_tax") * 10).alias("sim_open"),
        (F.col("l_quantity") > 40).cast("int").alias("pred_bulk"),
        (F.col("l_quantity") / 50).alias("sim_bulk"),
    ]


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged reviews without their authors."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(*_labelled(lines))


def rare_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged reviews whose one tag most items lack."""
    lines = table(spark, sf_dir, "lineitem")
    rare = (F.col("l_quantity") == 50) & (F.col("l_discount") >= 0.1)
    return lines.select(
        *_labelled(lines)[:2], rare.cast("int").alias("pred_rare"), F.col("l_discount").alias("sim_rare")
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged reviews with author and time."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        *_labelled(joined),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("recipe_id"), "embedding"
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item with one of the given vectors."""
    given = table(spark, sf_dir, "embeddings")
    n = given.agg(F.count("*")).scalar()
    keyed = items(spark, sf_dir).withColumn("vec_id", F.pmod(F.col("recipe_id").cast("bigint"), n))
    return keyed.join(given.select("vec_id", "embedding"), "vec_id").drop("vec_id")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per buyer the vectors behind their purchases."""
    n = table(spark, sf_dir, "embeddings").agg(F.count("*")).scalar()
    bought = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return bought.select(
        F.col("user_id").alias("session_id"), F.pmod(F.col("event_id"), n).alias("recipe_id")
    ).distinct()


def text_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def supplier_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier asks with one of the given vectors; left out are those whose key is the vector's, which ask as it does."""
    given = table(spark, sf_dir, "embeddings")
    n = given.agg(F.count("*")).scalar()
    key = F.col("s_suppkey")
    asked = table(spark, sf_dir, "supplier").select(key.alias("query_id"), F.pmod(key, n).alias("vec_id")).where("query_id <> vec_id")
    return asked.join(bounded_broadcast(given), "vec_id").select("query_id", F.col("embedding").alias("vector"))


def item_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part whose id is divisible by 20 asks, with its name, a vector and one of the customers."""
    given = table(spark, sf_dir, "embeddings")
    n, users = (table(spark, sf_dir, t).agg(F.count("*")).scalar() for t in ("embeddings", "customer"))
    key = F.col("p_partkey").cast("bigint")
    asked = table(spark, sf_dir, "part").where(key % 20 == 0).select(
        key.alias("query_id"),
        F.col("p_name").alias("text"),
        F.pmod(key, users).cast("string").alias("user_id"),
        F.pmod(key, n).alias("vec_id"),
    )
    return asked.join(given, "vec_id").select("query_id", "text", "user_id", F.col("embedding").alias("vector"))
