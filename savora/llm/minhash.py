"""Near duplicates by b-bit MinHash: banded minima for candidates, packed low bits for their similarity."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from savora.llm.components import components
from savora.llm.exact_dedup import BROADCAST_BYTES, DIGEST_BYTES, without_rows
from savora.llm.text import LOWER, WordHashes, map_batches, mix, remembered, texts
from savora.session import stage

MINIMA, BITS = 128, 2
FINE = 1024  # minima of the longer signatures, for pairs that are many
LANES = 64 // BITS  # minima in a packed number
PACKED = MINIMA // LANES
LOW = 0x5555555555555555  # the lower bit of each lane


@dataclass(frozen=True)
class Near:
    """Links join sets of ``words``-word shingles with ``100 |A and B| >= percent |A or B|``."""

    words: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        """Minima in a band: as many as miss fewer than one in a million of the faintest links."""
        t = self.percent / 100
        return max(r for r in range(1, 17) if r == 1 or (1 - t**r) ** (MINIMA // r) <= 1e-6)

    @property
    def bands(self) -> int:
        return MINIMA // self.rows

    def least_matches(self, count: int, deviations: int) -> int:
        """Of ``count`` lanes so many match in a candidate: some deviations fewer than in the faintest link.

        Lanes of different minima agree by chance once in ``2**BITS``: of similarity J, J + (1 - J) / 2**BITS match.
        """
        t, chance = self.percent / 100, 1 / 2**BITS
        p = t + (1 - t) * chance
        return int(count * p - deviations * (count * p * (1 - p)) ** 0.5)


_random = np.random.default_rng(20240229)
FACTORS = _random.integers(0, 1 << 63, FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 1 << 63, FINE, dtype=np.uint64)


@remembered("minhash")
def _hashes() -> WordHashes:
    return WordHashes()


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than ``size`` are one shingle, none are none."""
    split = text.encode().translate(LOWER).split()
    if not split:
        return np.empty(0, np.uint64)
    h = _hashes().of(split)
    n = max(1, len(h) - size + 1)
    width = min(size, len(h))
    value = np.full(n, width, np.uint64)
    for k in range(width):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(value)


def minima(values: np.ndarray, count: int = MINIMA) -> np.ndarray:
    """The least value under each of the hash functions; pieces bound the memory for long texts."""
    least = np.full(count, np.uint64(2**64 - 1))
    for at in range(0, len(values), 2048):
        part = values[at : at + 2048, None] * FACTORS[:count] + OFFSETS[:count]
        least = np.minimum(least, part.min(axis=0))
    return least


def pack(least: np.ndarray) -> np.ndarray:
    """The low bits of each row of minima, ``LANES`` of them in a number."""
    lanes = (mix(least) & np.uint64(2**BITS - 1)).reshape(len(least), -1, LANES)
    return (lanes << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64).view(np.int64)


def _sketch(batch: pa.RecordBatch, near: Near) -> pa.RecordBatch:
    sets = [shingles(t, near.words) for t in batch.column(1).to_pylist()]
    least = np.stack([minima(s) for s in sets])
    key = np.zeros((len(sets), near.bands), np.uint64) + np.arange(near.bands, dtype=np.uint64)
    used = least[:, : near.bands * near.rows].reshape(len(sets), near.bands, near.rows)
    for r in range(near.rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + used[:, :, r])
    packed = pack(least)
    offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * near.bands)
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            pa.ListArray.from_arrays(offsets, pa.array(key.view(np.int64).ravel())),
            *(pa.array(packed[:, i]) for i in range(PACKED)),
        ],
        ["doc_id", "n_shingles", "set_key", "bands", *(f"s{i}" for i in range(PACKED))],
    )


def sketches(docs: DataFrame, near: Near, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, set_key, bands, s0...``: per row the size and a digest of its set, a key for each
    band of minima, and the low bits of all minima, packed."""
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    packed = ", ".join(f"s{i} long" for i in range(PACKED))
    schema = f"doc_id {kind}, n_shingles long, set_key binary, bands array<long>, {packed}"
    return map_batches(rows, lambda batch: _sketch(batch, near), schema)


def matches(left: str, right: str, name: str = "s", count: int = MINIMA) -> Column:
    """Equal lanes of two packed signatures, counted in bits."""

    def unequal(i: int) -> Column:
        x = F.col(f"{left}.{name}{i}").bitwiseXOR(F.col(f"{right}.{name}{i}"))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(LOW)))

    return F.lit(count) - reduce(Column.__add__, map(unequal, range(count // LANES)))


def similarity(left: str, right: str) -> Column:
    """Jaccard similarity estimated from the matches, corrected for those by chance."""
    chance = 1 / 2**BITS
    return (matches(left, right) / MINIMA - chance) / (1 - chance)


def _may_link(near: Near) -> Column:
    """Sizes and signatures of ``x`` and ``y`` allow for a link."""
    sizes = F.least("x.n_shingles", "y.n_shingles") * 100 >= F.greatest("x.n_shingles", "y.n_shingles") * near.percent
    return sizes & (matches("x", "y") >= near.least_matches(MINIMA, 6))


def _named(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """``id, text`` of the rows with these ids, which are broadcast up to a checked size."""
    ids = stage(ids.distinct(), "ids")
    if ids.count() * DIGEST_BYTES <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    return rows.withColumnRenamed("doc_id", "id").join(ids, "id", "left_semi")


def _details(ids: DataFrame, rows: DataFrame, near: Near) -> DataFrame:
    """``id, own, t0...``: how many shingles of each of these rows are in none of the others, and a longer
    signature. Ids of several rows are left out."""
    named = _named(ids, rows)
    kind = ids.schema["id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, near.words) for t in batch.column(1).to_pylist()]
        at = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
        every = pa.array(np.concatenate(sets).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), every], ["id", "shingle"])

    each = map_batches(named.select("id", "text"), make, f"id {kind}, shingle long")
    def long_signatures(batch: pa.RecordBatch) -> pa.RecordBatch:
        least = np.stack([minima(shingles(t, near.words), FINE) for t in batch.column(1).to_pylist()])
        columns = [pa.array(c) for c in np.ascontiguousarray(pack(least).T)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *LONG])

    signed = map_batches(named.select("id", "text"), long_signatures, f"id {kind}, " + ", ".join(f"{c} long" for c in LONG))
    single = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    once = named.groupBy("id").agg(F.count("*").alias("n")).where("n = 1").select("id")
    own = single.groupBy("id").agg(F.count("*").alias("own"))
    return signed.join(once, "id").join(own, "id", "left")


LONG = [f"t{i}" for i in range(FINE // LANES)]


def _confirmed(pairs: DataFrame, rows: DataFrame, near: Near) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough, from the texts of ``rows``."""
    pairs = stage(pairs, "pairs")
    named = _named(pairs.select(F.col("a").alias("id")).distinct().unionByName(pairs.select(F.col("b").alias("id")).distinct()), rows)
    both = pairs.join(named.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        named.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    kind = pairs.schema["a"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if text not in known:
                if len(known) >= 64:
                    known.clear()
                known[text] = shingles(text, near.words)
            return known[text]

        keep = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = of(a), of(b)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= near.percent * (len(x) + len(y) - common))
        return batch.select(["a", "b"]).filter(pa.array(keep))

    return map_batches(both.select("a", "b", "text_a", "text_b"), make, f"a {kind}, b {kind}")


def near_groups(docs: DataFrame, near: Near = Near(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are what stands between ``[\\x20\\x09-\\x0D]``, A-Z lower-cased. The set of a text are its distinct
    ``near.words``-word shingles; fewer words are one shingle, and a text that is null, empty or without
    words has an empty set and no link. Rows are linked as :class:`Near` says; ``component_id`` is the
    smallest id that can be reached, ``kept`` marks the rows with that id. Rows without an id take no part:
    their component is null and they are kept. Rows that repeat an id are told apart by their texts. An
    empty table gives an empty result; other columns are not looked at.

    Rows of equal sets are one class, named by its smallest id. Classes that share a band of minima are
    compared to one in the bucket only; after that, a bucket is gone through again only where it
    holds several components, and only between members of different ones. No bucket is cut off, and no pair
    within a component is made. Sizes and
    packed signatures thin out the pairs; the full sets decide.
    """
    rows = texts(docs, id_col, text_col)
    all_rows = stage(sketches(docs, near, id_col, text_col), "sketches")
    own = all_rows.where("doc_id is not null and n_shingles > 0")
    classes = stage(own.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    packed = [f"s{i}" for i in range(PACKED)]
    first = own.join(classes, ["set_key"]).where(F.col("doc_id") == F.col("rep"))
    reps = stage(first.select("rep", "n_shingles", "bands", *packed).dropDuplicates(["rep", "bands"]), "reps")
    signatures = reps.select("rep", "n_shingles", *packed)

    members = reps.select("rep", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(members.join(shared, "bucket"), "members")
    # The lead of a bucket meets the most others in all of its buckets, as the origin of copies does.
    met = members.groupBy("rep").agg(F.sum("n").alias("met"))
    leads = members.join(met, "rep").groupBy("bucket").agg(F.max_by("rep", F.struct("met", "rep")).alias("lead"))
    members = stage(members.join(leads, "bucket"), "members").where(F.col("rep") != F.col("lead"))
    stars = members.select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    candidates = (
        stars.join(signatures.alias("x"), F.col("a") == F.col("x.rep"))
        .join(signatures.alias("y"), (F.col("b") == F.col("y.rep")) & _may_link(near))
        .select("a", "b")
        .distinct()
    )
    links = stage(_confirmed(candidates, rows, near), "links")
    found = stage(components(links), "components")

    # What is left in buckets of three and more: members of other components than the bucket's main one.
    rest = members.where("n > 2").select("bucket", "rep")
    placed = rest.join(found, rest["rep"] == found["node"], "left").select(
        "bucket", "rep", F.coalesce("root", "rep").alias("root")
    )
    counts = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots"))
    open_ = placed.join(mixed.where("roots > 1").select("bucket", "main"), "bucket")
    # Rows share at most those shingles that are not their own, which rules out most pairs of remote copies.
    own = _details(open_.select(F.col("rep").alias("id")), rows, near)
    shared = (F.col("n_shingles") - F.coalesce("own", F.lit(0))).alias("shared")
    open_ = open_.join(reps.select("rep", "n_shingles", "bands", *packed), "rep").join(own, F.col("rep") == F.col("id"), "left").select(
        "bucket", "rep", "root", "main", "n_shingles", "bands", shared, *packed, *LONG
    )
    open_ = stage(open_, "open")
    both = F.least("x.shared", "y.shared")
    enough = both * 100 >= (F.col("x.n_shingles") + F.col("y.n_shingles") - both) * near.percent
    close = matches("x", "y", "t", FINE) >= near.least_matches(FINE, 5)
    x, y = open_.where("root != main").alias("x"), open_.alias("y")
    once = (F.col("y.root") == F.col("y.main")) | (F.col("x.rep") < F.col("y.rep"))
    # A pair is made in the least bucket that both are in; where one of them leads that, it was compared above.
    least = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.bucket")
    near_by = once & enough & _may_link(near) & F.coalesce(close, F.lit(True)) & least
    across = x.join(
        y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.root") != F.col("y.root")) & near_by
    ).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
    more = stage(_confirmed(across.distinct(), rows, near), "links")
    if not more.isEmpty():
        found = stage(components(links.unionByName(more)), "components")

    named = classes.join(found, classes["rep"] == found["node"], "left").select(
        "set_key", F.coalesce("root", "rep").alias("component_id")
    )
    empty = F.col("n_shingles") == 0
    # Empty sets all have the same digest; as none is in ``classes``, they stay alone.
    return (
        all_rows.select("doc_id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(empty | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_copies(docs: DataFrame, near: Near = Near(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`near_groups` does not keep; all columns pass through."""
    dropped = near_groups(docs, near, id_col=id_col, text_col=text_col).where(~F.col("kept"))
    return without_rows(docs, dropped.select("doc_id"), {id_col: "doc_id"})
