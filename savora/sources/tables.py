"""Reading inputs and writing results."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from savora.functions.columns import with_nulls_for_nan
from savora.settings import Settings


def is_written(spark: SparkSession, path: str) -> bool:
    """True for a file, or for a folder whose writing job finished."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return False
    done = spark._jvm.org.apache.hadoop.fs.Path(jvm_path, "_SUCCESS")
    return fs.getFileStatus(jvm_path).isFile() or fs.exists(done)


def numbered_folders(spark: SparkSession, path: str) -> list[int]:
    """The numbers that folders below ``path`` have as names, ascending."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(jvm_path)]
    return sorted(int(n) for n in names if n.isdigit())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return with_nulls_for_nan(spark.read.parquet(path))


def require_rows(df: DataFrame, path: str) -> DataFrame:
    """Fail, naming the path, if the table is empty; reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"table is empty: {path}")
    return df


def load_inputs(spark: SparkSession, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Item metadata, raw reviews and tagged reviews. Raw reviews must exist but feed nothing."""
    paths = (settings.raw_recipes_path, settings.raw_reviews_path, settings.gold_reviews_path)
    items, reviews, labels = (require_rows(read_table(spark, p), p) for p in paths)
    return items, reviews, labels


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_mapping(mapping: DataFrame, path: str) -> None:
    """Store ``(feature, idx)`` rows, one per column of a table, as one JSON object name -> ordinal."""
    ordinals = {r.feature: r.idx for r in mapping.orderBy("idx").collect()}
    text = json.dumps(ordinals, indent=4, ensure_ascii=False)
    mapping.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    ordinals = F.from_json("value", "map<string,int>")
    return text.select(F.explode(ordinals).alias("feature", "idx"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Append one run's metrics as JSON."""
    metrics.coalesce(1).write.mode("append").json(path)
