"""Exact deduplication as a stateful stream: keyed state on disk that never expires."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from savora.llm.text import prepare, unused
from savora.session import shared_dir, stage
from savora.sources.tables import is_written

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Log changes instead of copying the files of each state, and take no disk space before it is needed.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# Below this many bytes the digests to check are broadcast instead of shuffling every text.
BROADCAST_BYTES = 32 << 20
DIGEST_BYTES = 100  # of one digest in a broadcast table, with its overhead
LOCATED_BYTES = 300  # of one digest with its locator
ROW_GROUP_BYTES = 32 << 20


def normalised(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), " \t\n\x0b\x0c\r", "")


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def digest_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256,
    with_text: bool = False,
) -> DataFrame:
    """``digest, doc_id, code_points`` of each row, and its ``text`` if asked; works on a stream as on a table."""
    text = docs[text_col].cast("string")
    return docs.select(
        digest(normalised(text)).alias("digest"),
        docs[id_col].alias("doc_id"),
        F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("code_points"),
        *([text.alias("text")] if with_text else []),
    )


LOCATOR = ("file", "row")


def located(rows: DataFrame) -> DataFrame:
    """Rows of Parquet files, or of a stream of them, with the name of the file and the row's place in it."""
    return rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def _best(*more: str) -> Column:
    """Most code points, then the smallest id; rows without an id come last."""
    return F.min(F.struct((-F.col("code_points")).alias("down"), F.col("doc_id").isNull().alias("no_id"), "doc_id", *more))


def seen(stream: DataFrame, sink: str, checkpoint: str, **trigger) -> DataFrame:
    """Run a stream of :func:`digest_rows` to its end; returns the state of each digest.

    The state of a digest is the id of the row that stays, the locator of its content if the stream is
    :func:`located`, and how many rows came. It is kept in RocksDB on the executors' disks, without watermark or time limit, and its changes
    are logged below ``checkpoint``; a restarted stream goes on where it was. Rows of one digest are
    combined before the shuffle, so a text that makes up a third of the input is no hot key. Each
    micro-batch overwrites its own folder of changed digests below ``sink``, so a repeated batch does
    no harm; the newest change counts.
    """
    spark = stream.sparkSession

    locator = [c for c in LOCATOR if c in stream.columns]
    state = stream.groupBy("digest").agg(F.count("*").alias("n"), _best(*locator).alias("best"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    schema = f"digest string, n long, best {state.schema['best'].dataType.simpleString()}, batch long"
    changes = spark.read.schema(schema).parquet(sink)
    if changes.select("batch").distinct().count() == 1:
        return changes.select("digest", "n", "best")
    last = F.max_by(F.struct("n", "best"), "batch").alias("last")
    return changes.groupBy("digest").agg(last).select("digest", "last.n", "last.best")


def _collisions(content: DataFrame, hits: DataFrame, changes: DataFrame, run: str) -> DataFrame:
    """Digests shared by texts whose bytes differ: rows of ``run`` that hit, against the content that their digests locate.

    A digest's locators are all that its state ever had, so a row is compared with what stayed when it came
    and with what took its place.
    """
    few = hits.count() * LOCATED_BYTES <= BROADCAST_BYTES
    came = content.where(F.col("run") == run).join(F.broadcast(hits) if few else hits, "digest", "left_semi")
    at = changes.select("digest", F.col("best.file").alias("file"), F.col("best.row").alias("row")).distinct()
    at = stage(at.join(F.broadcast(hits) if few else hits, "digest", "left_semi"), "locators")
    few = at.count() * LOCATED_BYTES <= BROADCAST_BYTES
    held = located(content.where(F.col("run") != run)).join(F.broadcast(at) if few else at, [*LOCATOR, "digest"], "left_semi")
    # Equal texts are combined before the shuffle, and grouping compares their bytes.
    return (
        came.unionByName(held.select(*came.columns))
        .groupBy("digest", normalised(F.col("text")).alias("norm"))
        .agg(F.count("*").alias("n"))
        .groupBy("digest")
        .agg(F.count("*").alias("texts"))
        .where("texts > 1")
        .select("digest")
    )


def exact_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None,
    folder: str | None = None, run: str = "0",
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for every row of ``docs``.

    Texts are equal if they are identical without ``[\\x20\\x09-\\x0D]``. Of equal texts the row with the
    most code points in its original text stays, then the one with the smallest id; a row without an id
    stays only if all rows of its group have none. Null and empty texts are one group. Rows that repeat
    both id and text count one by one and are kept or dropped together. An empty table gives an empty
    result; other columns are not looked at.

    Rows are stored with their digests, and the digests streamed through :func:`seen`. Where a digest was hit
    again, the full texts of the rows that hit are compared with each other and with those that the digest
    locates in earlier runs; digests of different texts, should there be any, are remembered and grouped by text. ``files_per_batch`` bounds a micro-batch.

    With a ``folder`` the stored rows and the state stay there and serve later calls, each under its own
    ``run``: the result has the rows of ``docs``, decided against all rows that ever came. What was decided
    for earlier rows is not taken back, though a later row may be longer. A call that did not end is repeated
    under its name; rows that it had stored count once.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError(f"{run!r} is no name for a folder")
    spark = prepare(docs.sparkSession)
    folder = folder or f"{shared_dir(spark)}/seen-{uuid.uuid4().hex}"
    path = f"{folder}/content/run={run}"
    if not is_written(spark, path):
        stored = digest_rows(docs, id_col, text_col, digest, with_text=True)
        # Small row groups bound the memory of a writer of long texts.
        stored.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    kind = docs.schema[id_col].dataType.simpleString()
    light = f"digest string, doc_id {kind}, code_points long, run string"
    source = spark.readStream.schema(light)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    content = spark.read.schema(f"{light}, text string").parquet(f"{folder}/content")
    rows = content.where(F.col("run") == run).select("digest", "doc_id", "code_points")
    if content.isEmpty():
        return _decide(rows.withColumns({"n": F.lit(1).cast("long"), "best": F.struct("doc_id")}))
    state = seen(located(source.parquet(f"{folder}/content")), f"{folder}/changes", f"{folder}/checkpoint")
    many = state.where("n > 1")
    changes = spark.read.parquet(f"{folder}/changes")
    found = _collisions(content, stage(many.select("digest"), "hits"), changes, run)
    found.write.mode("overwrite").parquet(f"{folder}/collided/run={run}")
    collided = spark.read.schema("digest string").parquet(f"{folder}/collided").select("digest").distinct()
    result = _decide(rows.join(many, "digest", "left"))
    if collided.isEmpty():
        return result
    # The rare way: group by the text itself.
    again = content.join(collided, "digest", "left_semi").withColumn("norm", normalised(F.col("text"))).drop("text")
    groups = again.groupBy("digest", "norm").agg(F.count("*").alias("n"), _best().alias("best"))
    exact = _decide(again.where(F.col("run") == run).join(groups, ["digest", "norm"], "left"))
    return result.join(collided, "digest", "left_anti").select(*exact.columns).unionByName(exact)


def _decide(rows: DataFrame) -> DataFrame:
    """Each row with its group's row that stays; rows in no group stay themselves."""
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id"))
    return rows.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` does not keep; all columns pass through.

    Rows that repeat both id and text stay or go together; a repeated id with another text is another row.
    """
    dropped = exact_groups(docs, id_col=id_col, text_col=text_col).where(~F.col("kept"))
    own = unused("__digest", docs.columns)
    rows = docs.withColumn(own, sha256(normalised(docs[text_col])))
    return without_rows(rows, dropped.select("doc_id", "digest"), {id_col: "doc_id", own: "digest"}).drop(own)


def without_rows(docs: DataFrame, dropped: DataFrame, keys: dict[str, str]) -> DataFrame:
    """``docs`` without the rows whose ``keys`` are those of a row of ``dropped``; nulls are equal.

    ``dropped`` is broadcast up to a checked size.
    """
    names = [unused(f"__gone_{i}", docs.columns) for i in range(len(keys))]
    gone = dropped.select(*(F.col(c).alias(n) for c, n in zip(keys.values(), names, strict=True))).distinct()
    gone = stage(gone, "dropped")
    if gone.count() * DIGEST_BYTES * len(keys) <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    same = [docs[c].eqNullSafe(F.col(n)) for c, n in zip(keys, names, strict=True)]
    return docs.join(gone, reduce(Column.__and__, same), "left_anti")
