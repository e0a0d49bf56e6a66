"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark takes a file's bytes for its rows' bytes, and a stored table can have a hundred times as many. Larger sides
    # are broadcast only where they were counted (`savora.plans.skew`).
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    # A job's shuffle files go when it ends, not when the driver collects its garbage; what is read again is staged.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options every job here relies on. Sizes are left to the cluster."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="savora-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what :func:`stage` wrote inside the block once it ends.

    For jobs that store their result: no lazy table may outlive the block, only what is staged with ``keep``.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one expensive result feeds several consumers: the input is scanned once, each
    consumer reads only its columns, and a lost executor costs no recomputation. With ``keep`` it outlives the
    innermost :func:`scratch`, as the result of that step.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    blocks = _scratch[:-1] if keep else _scratch
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
