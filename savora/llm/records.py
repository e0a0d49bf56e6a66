"""Token sequences as length-delimited binary records with masked checksums and an offset index.

A record is::

    length of the payload   8 bytes   little-endian
    masked CRC of these     4 bytes
    payload                 length    doc_id (8 bytes, signed), bytes per token (1 byte), tokens
    masked CRC of these     4 bytes
    end mark                1 byte    0x0A

All numbers are little-endian; a token takes two bytes if every id of the vocabulary fits in them, else
four. A CRC (CRC-32 as in zlib) is masked by rotating it right by 15 bits and adding 0xA282EAD8, so that
a checksum over data that holds checksums stays useful. The end mark is the line separator of Spark's text
writer, through which the files reach any store Spark can write to.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from savora.llm.fragments import word_ids
from savora.llm.text import map_batches, prepare, texts
from savora.session import stage

SHARD_BYTES = 32 << 20  # of text in one file of records
ROWS_AT_ONCE = 200
MASK = 0xA282EAD8
HEAD, END = 12, 5  # bytes of a record before and after its payload


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(doc_id: int, ids: bytes, width: int) -> bytes:
    payload = struct.pack("<qB", doc_id, width) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(content: bytes, at: int = 0) -> tuple[int, np.ndarray, int]:
    """The id and the tokens of the record at ``at``, and where the next one begins."""
    (size, check) = struct.unpack_from("<QI", content, at)
    if check != masked_crc(content[at : at + 8]):
        raise ValueError(f"broken length at byte {at}")
    payload = content[at + HEAD : at + HEAD + size]
    if len(payload) < size or struct.unpack_from("<I", content, at + HEAD + size)[0] != masked_crc(payload):
        raise ValueError(f"broken record at byte {at}")
    doc_id, width = struct.unpack_from("<qB", payload)
    return doc_id, np.frombuffer(payload, f"<u{width}", offset=9), at + HEAD + size + END


def _width(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def write_records(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode every text, append ``end_id`` and write records in ascending order of the ids.

    Files are numbered in that order. A null or empty text is the end id alone; rows without an id are not
    written, as a record needs one; of rows that repeat an id each gets its record, ordered by the hash of
    the text. An empty table gives no record. The texts are sorted before they are encoded, as ids are
    larger and a range shuffle reads its input twice. ``tokenizer`` must be one that drops white space.
    """
    rows = texts(docs, id_col, text_col).where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    width = _width(tokenizer)
    end = np.array([end_id], f"<u{width}").tobytes()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode, made = word_ids(tokenizer, f"<u{width}"), []
        # Some rows at a time, as words take more memory than their text.
        for first in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(first, ROWS_AT_ONCE)
            ids = encode.of_texts(part.column(1).to_pylist())
            made += [frame(doc_id, i + end, width) for doc_id, i in zip(part.column(0).to_pylist(), ids, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["frame"])

    ordered = rows.repartitionByRange(max(1, -(-size // shard_bytes)), "doc_id").sortWithinPartitions(
        "doc_id", F.xxhash64("text")
    )
    # A cast of bytes to string keeps them as they are.
    map_batches(ordered, make, "frame binary").select(F.col("frame").cast("string")).write.text(path, lineSep="\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(number.alias("shard"), "content")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, shard, offset, length, first, n_tokens, ids``, in file order, checksums compared.

    ``ids`` are little-endian unsigned 32-bit integers; ``first`` counts the tokens before the record in its
    file. A damaged record fails the job.
    """
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0), batch.column(1), strict=True):
                yield from _parsed(shard.as_py(), content.as_py())

    return _files(spark, path).mapInArrow(run, _READ)


_READ = "doc_id long, shard int, offset long, length long, first long, n_tokens long, ids binary"
_NAMES = [c.split()[0] for c in _READ.split(", ")]


def _parsed(shard: int, content: bytes, rows_per_batch: int = 1000) -> Iterator[pa.RecordBatch]:
    at = first = 0
    while at < len(content):
        columns: list[list] = [[] for _ in _NAMES]
        while at < len(content) and len(columns[0]) < rows_per_batch:
            doc_id, ids, after = unframe(content, at)
            row = (doc_id, shard, at, after - at, first, len(ids), ids.astype("<u4").tobytes())
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            first += len(ids)
            at = after
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _NAMES)


def with_starts(records: DataFrame) -> DataFrame:
    """``start``: the tokens of all records before, over all files in order.

    One row per file, of ``SHARD_BYTES`` of text each, is summed up in order.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = records.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    bases = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return records.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("first")).drop("base")


def write_index(spark: SparkSession, path: str, index: str) -> None:
    """``doc_id, shard, offset, length, first, n_tokens, start`` of every record, as a table beside the files."""
    rows = stage(read_records(spark, path).drop("ids"), "offsets")
    with_starts(rows).write.parquet(index)


def read_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records that rows of the index (any of them, in any order) point to: ``doc_id, ids``.

    The offsets asked of one file are joined to it in one group; a file holds ``SHARD_BYTES`` of text.
    """
    prepare(spark)
    asked = wanted.groupBy("shard").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            unframe(content, at)[:2]
            for content, offsets in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for at in offsets
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in found], pa.int64()), pa.array([i.astype("<u4").tobytes() for _, i in found], pa.binary())],
            ["doc_id", "ids"],
        )

    return map_batches(_files(spark, path).join(asked, "shard").select("content", "offsets"), make, "doc_id long, ids binary")
