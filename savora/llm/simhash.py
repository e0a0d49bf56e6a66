"""Near duplicates by SimHash: fingerprints are split into blocks, joined on blocks and compared bit by bit."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from savora.llm.components import components
from savora.llm.exact_dedup import without_rows
from savora.llm.text import LOWER, map_batches, slices, texts
from savora.plans.skew import fits_broadcast, hot_keys, salted_join
from savora.session import stage

BITS = 64
SEED = 42
SLICE_BYTES = 1 << 20  # of texts worked on at once
SHINGLES_AT_ONCE = 1 << 16
# Members of a bucket that are compared in pairs; larger buckets go through shared neighbours.
BUCKET = 32


@dataclass(frozen=True)
class Blocks:
    """Fingerprints at most ``distance`` bits apart agree in all but ``distance`` of ``count`` blocks."""

    distance: int = 2
    count: int = 4

    @property
    def masks(self) -> list[int]:
        """One mask for each choice of ``count - distance`` blocks: two close fingerprints agree under one of them."""
        edges = [BITS * i // self.count for i in range(self.count + 1)]
        block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
        return [_signed(sum(chosen)) for chosen in combinations(block, self.count - self.distance)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles, repeats included, some at a time; fewer words than ``size`` are one shingle."""
    words = text.translate(LOWER).split()
    if not words:
        return
    width = min(size, len(words))
    count = len(words) - width + 1
    for at in range(0, count, SHINGLES_AT_ONCE):
        end = min(count, at + SHINGLES_AT_ONCE)
        rows = map(b" ".join, zip(*(words[at + k : end + k] for k in range(width)), strict=True))
        yield np.fromiter(map(xxhash.xxh64_intdigest, rows, repeat(SEED)), np.uint64, end - at)


def fingerprint(text: bytes, size: int) -> int:
    """A bit is set if it is set in more than half of the hashes; no words give zero."""
    ones, count = np.zeros(BITS, np.int64), 0
    for h in shingle_hashes(text, size):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        count += len(h)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, bits`` for every row: the fingerprint as a long."""
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = batch.column(1).cast(pa.binary())
        for begin, end in slices((len(t) for t in raw.to_pylist()), SLICE_BYTES):
            made = [_signed(fingerprint(t, words)) for t in raw[begin:end].to_pylist()]
            columns = [batch.column(0)[begin:end], pa.array(made, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "bits"])

    return map_batches(rows, make, f"doc_id {kind}, bits long")


def differing_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def close_pairs(prints: DataFrame, blocks: Blocks = Blocks(), bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` between rows of ``rep, bits``, whose fingerprints are distinct.

    A bucket holds the fingerprints that agree under one mask. Members of buckets of up to ``bucket`` are
    joined and kept if they differ in ``blocks.distance`` bits at most; a pair is made under the first
    mask that it agrees under, and all of them are returned. A larger bucket would make pairs with the
    square of its size. Its members name all fingerprints within half the distance of their own instead:
    those that name the same one are close, and each is linked to the least of them. Two close ones always
    have such a neighbour in common, so nothing that is linked comes apart. Rows of one neighbour are few,
    whatever the bucket's size. Only an even distance has such neighbours; with an odd one all are joined.
    """
    masks = blocks.masks
    keys = F.posexplode(F.array(*(F.col("bits").bitwiseAND(F.lit(m)) for m in masks))).alias("mask", "key")
    members = prints.select("rep", "bits", keys)
    sizes = members.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(members.join(sizes, ["mask", "key"]), "buckets")

    half = blocks.distance // 2
    split = blocks.distance % 2 == 0
    x, y = members.alias("x"), members.alias("y")
    differ = F.col("x.bits").bitwiseXOR(F.col("y.bits"))
    # Under an earlier mask the pair is made there, unless that bucket is a large one, whose members are linked below.
    earlier = F.lit(False)
    for i, m in enumerate(masks[:-1]):
        earlier = earlier | ((F.col("x.mask") > i) & (differ.bitwiseAND(F.lit(m)) == 0))
    same = (F.col("x.mask") == F.col("y.mask")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.bits") < F.col("y.bits"))
    near = differing_bits(F.col("x.bits"), F.col("y.bits")) <= blocks.distance
    small = (F.col("x.n") <= bucket) & (F.col("y.n") <= bucket) if split else F.lit(True)
    pairs = x.join(y, same & small & near & ~earlier).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    if not split:
        return pairs
    crowded = members.where(F.col("n") > bucket).select("rep", "bits").distinct()
    flips = [_signed(sum(1 << i for i in chosen)) for k in range(half + 1) for chosen in combinations(range(BITS), k)]
    neighbours = F.transform(F.array(*map(F.lit, flips)), lambda flip: F.col("bits").bitwiseXOR(flip))
    shared = (
        crowded.select("rep", F.explode(neighbours).alias("neighbour"))
        .groupBy("neighbour")
        .agg(F.min("rep").alias("a"), F.collect_list("rep").alias("all"))
        .where(F.size("all") > 1)
        .select("a", F.explode("all").alias("b"))
        .where("a != b")
        .distinct()
    )
    return pairs.unionByName(shared)


def close_groups(
    docs: DataFrame, words: int = 3, blocks: Blocks = Blocks(), *, id_col: str = "doc_id", text_col: str = "text",
    bucket: int = BUCKET,
) -> DataFrame:
    """``doc_id, fingerprint, component_id, kept`` for every row of ``docs``.

    Words are what stands between ``[\\x20\\x09-\\x0D]``, A-Z lower-cased; shingles are ``words`` of them joined by a
    space, repeats included. A text of fewer words is one shingle; one that is null, empty or without words
    has the fingerprint zero, which is linked like any other. Rows are linked at ``blocks.distance`` or
    fewer differing bits; ``component_id`` is the smallest id that can be reached, ``kept`` marks the rows
    with that id. Rows without an id take no part: their component is null and they are kept. Rows that
    repeat an id are one node, linked with what any of them is linked with. An empty table gives an empty
    result; other columns are not looked at.

    Rows of one fingerprint are one class, named by its smallest id before anything is joined, so copies
    make no pairs. See :func:`close_pairs` for crowded buckets.
    """
    rows = stage(fingerprints(docs, words, id_col=id_col, text_col=text_col), "fingerprints")
    own = rows.where("doc_id is not null")
    prints = stage(own.groupBy("bits").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "prints")
    links = close_pairs(prints.select("rep", "bits"), blocks, bucket)
    # Rows that repeat an id tie its fingerprints together.
    repeated = own.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    ties = own.join(repeated, "doc_id", "left_semi").join(prints.select("bits", "rep"), "bits")
    links = links.unionByName(ties.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a != b").distinct())
    found = components(stage(links, "links"))
    named = prints.join(found, prints["rep"] == found["node"], "left").select(
        "bits", "n", F.coalesce("root", "rep").alias("component_id")
    )
    named = stage(named, "named")
    if fits_broadcast(named.drop("n")):
        joined = rows.join(F.broadcast(named.drop("n")), "bits", "left")
    else:
        joined = salted_join(rows, named.drop("n"), "bits", hot_keys(named, "bits", "n"), ["doc_id"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select(
        "doc_id",
        F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def drop_close_copies(docs: DataFrame, words: int = 3, blocks: Blocks = Blocks(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`close_groups` does not keep; all columns pass through."""
    dropped = close_groups(docs, words, blocks, id_col=id_col, text_col=text_col).where(~F.col("kept"))
    return without_rows(docs, dropped.select("doc_id"), {id_col: "doc_id"})
