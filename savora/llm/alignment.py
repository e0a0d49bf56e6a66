"""Alignment of two tokenizers by the byte offsets at which tokens of both end.

The shorter list of ends drives an exponential and binary search into the longer one. Ends in both lists cut the
tokens into groups; the ranks of such an end, less those of the one before, are the numbers of tokens in its group.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savora.llm.bpe import Vocabulary
from savora.llm.text import forget_others, map_batches, remembered, slices, texts
from savora.session import stage

SLICE_BYTES = 1 << 20  # of texts worked on at once
HELD = 300_000  # fragments that a worker remembers
LONGEST = 48  # characters of a fragment that is remembered
COMBINED = 1 << 21  # links counted in a task before they are combined
# Counts of so many links, the most frequent ones, go to all workers; the counts of others are joined.
FREQUENT = 1_000_000
# No piece of either vocabulary goes on from another character to a space or a line break, and the
# byte-level pattern ends there in any case.
CUT = re.compile(r"(?<=[^\s▁])(?=[ \n].)", re.DOTALL)


def common_ends(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranks in ``short`` and in ``long``, both ascending, of what is in both.

    Each member of ``short`` gallops through ``long`` from its ``start``, a rank at or before its own: in steps
    of 1, 2, 4, ... until it is reached, and then by halving the last step. All of them do so side by side.
    """
    if not len(short) or not len(long):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    last = len(long) - 1
    low, step = np.minimum(start, last), np.ones(len(short), np.int64)
    going = np.flatnonzero(long[low] < short)
    while len(going):
        ahead = np.minimum(low[going] + step[going], last)
        less = (long[ahead] < short[going]) & (ahead < last)
        going = going[less]
        low[going] = ahead[less]
        step[going] *= 2
    # What is looked for stands at ``low`` or up to ``step`` behind it.
    high = np.minimum(low + step, last)
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) // 2
        less = long[middle] < short[going]
        low[going] = np.where(less, middle + 1, low[going])
        high[going] = np.where(less, high[going], middle)
        going = going[low[going] < high[going]]
    found = np.flatnonzero(long[low] == short)
    return found, low[found]


class Tokens:
    """The tokens of many fragments in a row: ids, bytes, and where each fragment's begin."""

    def __init__(self, ids: list[list[int]], size: np.ndarray, start: np.ndarray, flat: np.ndarray):
        self.first = np.cumsum([0, *map(len, ids)])
        self.ids = np.fromiter(chain.from_iterable(ids), np.int64, self.first[-1])
        self.size = size[self.ids]
        ends = np.cumsum(self.size)
        self.bytes = flat[np.arange(self.size.sum()) + np.repeat(start[self.ids] - ends + self.size, self.size)].tobytes()
        self.byte = np.concatenate(([0], ends))[self.first]

    def spell(self, raw: list[bytes]) -> np.ndarray:
        at = self.byte.tolist()
        return np.fromiter((self.bytes[a:b] == r for a, b, r in zip(at, at[1:], raw)), bool, len(raw))


def _named(n: int, mark: str) -> np.ndarray:
    out = np.empty(n, object)
    out[:] = [f"{i}{mark}" for i in range(n)]
    return out


def _slices_of(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the ranges that begin at ``starts``, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


NUMBERS = 5  # tokens of A (-1 if the bytes differ), of B, groups, links, distinct links
# A group with more pairs of tokens than this is counted by its distinct ids.
PAIRS_OF_GROUP = 64


class Aligner:
    """Aligned fragments, remembered; everything is forgotten once ``held`` are.

    A fragment is kept as the text of its groups, each with a semicolon behind it, and as 64-bit numbers: ``NUMBERS``
    of them, and then its distinct links and how often each occurs.
    """

    def __init__(self, byte_path: str, piece_path: str, held: int = HELD):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(byte_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        v = Vocabulary(byte_path)
        self.table_a = v.size, v.start, v.flat
        pieces = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        size = np.array([len(p) for p in pieces])
        self.table_b = size, np.cumsum(size) - size, np.frombuffer(b"".join(pieces), np.uint8)
        self.blank = self.b.piece_to_id("▁")
        self.width = len(pieces)  # a link is A's id times this plus B's
        self.names_a = [_named(len(v.size), mark) for mark in ",|"]
        self.names_b = [_named(self.width, mark) for mark in ",;"]
        self.known: dict[str, tuple[str, bytes]] = {}
        self.held = held

    def fragments(self, distinct: list[str]) -> list[tuple[str, bytes]]:
        fresh = [p for p in distinct if p not in self.known]
        if len(self.known) + len(fresh) > self.held:
            new = set(fresh)
            self.known = {p: self.known[p] for p in distinct if p not in new}
        self.known.update(zip(fresh, self._aligned(fresh), strict=True))
        found = list(map(self.known.__getitem__, distinct))
        for p in fresh:
            if len(p) > LONGEST:
                del self.known[p]
        return found

    def _aligned(self, parts: list[str]) -> list[tuple[str, bytes]]:
        if not parts:
            return []
        ids_a = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        # The library puts a space before each text.
        ids_b = self.b.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        ids_b = [b if p[0] == " " else b[1:] if b[0] == self.blank else [] for p, b in zip(parts, ids_b, strict=True)]
        raw = [p.encode() for p in parts]
        good = Tokens(ids_a, *self.table_a).spell(raw) & Tokens(ids_b, *self.table_b).spell(raw)
        if not good.all():
            ids_a, ids_b = ([x if g else [] for x, g in zip(ids, good, strict=True)] for ids in (ids_a, ids_b))
        a, b = Tokens(ids_a, *self.table_a), Tokens(ids_b, *self.table_b)
        # Both spell the same bytes in a row, so ends count from the first fragment, and each fragment's last one is common.
        short, long = (a, b) if len(a.ids) <= len(b.ids) else (b, a)
        owner = np.repeat(np.arange(len(parts)), np.diff(short.first))
        ranks = common_ends(np.cumsum(short.size), np.cumsum(long.size), long.first[owner])
        last_a, last_b = ranks if short is a else ranks[::-1]
        # Differences of ranks are the tokens of a group.
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        first_a, first_b = last_a - n_a + 1, last_b - n_b + 1
        group_of = np.searchsorted(a.first, first_a, "right") - 1
        group_at = np.searchsorted(group_of, np.arange(len(parts) + 1))
        pairs = n_a * n_b

        # The text of a group: A's tokens, then B's.
        text = np.empty(len(a.ids) + len(b.ids), object)
        place_a = np.arange(len(a.ids)) + np.repeat(first_b, n_a)
        place_b = np.arange(len(b.ids)) + np.repeat(last_a + 1, n_b)
        text[place_a] = self.names_a[0][a.ids]
        text[place_b] = self.names_b[0][b.ids]
        text[place_a[last_a]] = self.names_a[1][a.ids[last_a]]
        text[place_b[last_b]] = self.names_b[1][b.ids[last_b]]
        cut = (a.first + b.first).tolist()
        text = text.tolist()
        groups = ["".join(text[x:y]) for x, y in zip(cut, cut[1:])]

        # Links, and how often each occurs in its fragment.
        few = pairs <= PAIRS_OF_GROUP
        which = np.repeat(np.flatnonzero(few), pairs[few])
        within = _slices_of(np.zeros(few.sum(), np.int64), pairs[few])
        link = a.ids[first_a[which] + within // n_b[which]] * self.width + b.ids[first_b[which] + within % n_b[which]]
        frag, times = group_of[which], np.ones(len(link), np.int64)
        for g in np.flatnonzero(~few).tolist():
            x, times_x = np.unique(a.ids[first_a[g] : last_a[g] + 1], return_counts=True)
            y, times_y = np.unique(b.ids[first_b[g] : last_b[g] + 1], return_counts=True)
            link = np.concatenate((link, np.add.outer(x * self.width, y).ravel()))
            frag = np.concatenate((frag, np.full(len(x) * len(y), group_of[g])))
            times = np.concatenate((times, np.outer(times_x, times_y).ravel()))
        frag, link, times = _combined(frag, link, times)
        counts = np.bincount(frag, minlength=len(parts))
        numbers = np.empty((len(parts), NUMBERS), np.int64)
        numbers[:, 0] = np.where(good, np.diff(a.first), -1)
        numbers[:, 1] = np.diff(b.first)
        numbers[:, 2] = np.diff(group_at)
        total = np.concatenate(([0], np.cumsum(pairs)))
        numbers[:, 3] = total[group_at[1:]] - total[group_at[:-1]]
        numbers[:, 4] = counts
        packed, listed = numbers.tobytes(), np.stack((link, times), axis=1).tobytes()
        width = 8 * NUMBERS
        ends = (16 * np.cumsum(counts)).tolist()
        return [
            (g, packed[i * width : (i + 1) * width] + listed[x:y]) for i, (g, x, y) in enumerate(zip(groups, [0, *ends], ends))
        ]

    def texts(self, rows: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the four sizes and its groups; of all texts, the ends, links and times of distinct links."""
        cut = [CUT.split(f" {t}") if t else [] for t in rows]
        parts = list(chain.from_iterable(cut))
        distinct = list(dict.fromkeys(parts))
        number = dict(zip(distinct, range(len(distinct))))
        made = self.fragments(distinct)
        sizes = np.frombuffer(b"".join([data[: 8 * NUMBERS] for _, data in made]), np.int64).reshape(-1, NUMBERS)
        own = np.frombuffer(b"".join([data[8 * NUMBERS :] for _, data in made]), np.int64).reshape(-1, 2)
        own_at = np.cumsum(sizes[:, 4]) - sizes[:, 4]
        part = np.fromiter(map(number.__getitem__, parts), np.int64, len(parts))
        ends = np.cumsum([0, *map(len, cut)])
        row = np.repeat(np.arange(len(rows)), np.diff(ends))
        sums = np.concatenate((np.zeros((1, 5), np.int64), np.cumsum(sizes[part], axis=0)))
        totals = (sums[ends[1:]] - sums[ends[:-1]])[:, :4]
        wrong = np.concatenate(([0], np.cumsum(sizes[part, 0] < 0)))
        good = wrong[ends[1:]] == wrong[ends[:-1]]
        totals[~good] = 0
        texts = [made[i][0] for i in part.tolist()]
        groups = [
            "".join(texts[a:b])[:-1] if g else "" for a, b, g in zip(ends.tolist(), ends[1:].tolist(), good.tolist())
        ]
        # Distinct links of each text, from its distinct fragments.
        row, part = row[good[row]], part[good[row]]
        both, often = np.unique(row * max(1, len(distinct)) + part, return_counts=True)
        row, part = both // max(1, len(distinct)), both % max(1, len(distinct))
        n = sizes[part, 4]
        at = _slices_of(own_at[part], n)
        row, key, times = _combined(np.repeat(row, n), own[at, 0], own[at, 1] * np.repeat(often, n))
        return totals, groups, np.searchsorted(row, np.arange(len(rows) + 1)), key, times


def _combined(row: np.ndarray, key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows and keys, ascending, and the sums of their times."""
    order = np.lexsort((key, row))
    row, key, times = row[order], key[order], times[order]
    first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(key, prepend=-1) != 0))
    return row[first], key[first], np.add.reduceat(times, first) if len(first) else times


@remembered("alignment", 2)
def aligner_of(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


SIZES = ["n_a", "n_b", "n_groups", "n_links"]


def _batches(batch: pa.RecordBatch, byte_path: str, piece_path: str) -> Iterator[tuple]:
    column = batch.column(1)
    for begin, end in slices(pc.binary_length(column).to_pylist(), SLICE_BYTES):
        yield begin, end, aligner_of(byte_path, piece_path).texts(column[begin:end].to_pylist())


def align(
    docs: DataFrame, byte_path: str, piece_path: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups`` for every row of ``docs``.

    A are the byte-level tokens of a space and the text, B the tokens of a piece model, which puts the space
    itself; names of special tokens in a text are plain text. Offsets in bytes at which tokens of both end
    cut them into groups, written ``a1,a2|b1;a3|b2,b3``; links are all pairs of an A and a B token in one group.
    A text that is null or empty, or whose tokens of either kind do not spell a space and the text, has
    no tokens: zeros, and no groups. Repeated rows and null ids each keep their own row; an empty table gives
    none; other columns are not looked at. Both files must be at these paths on every executor.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin, end, (totals, groups, *_) in _batches(batch, byte_path, piece_path):
            columns = [pa.array(totals[:, k]) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[begin:end], *columns, pa.array(groups, pa.string())], ["doc_id", *SIZES, "groups"]
            )

    sizes = ", ".join(f"{c} long" for c in SIZES)
    return map_batches(rows, make, f"doc_id {kind}, {sizes}, groups string")


def _links(rows: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Sizes, a digest of the groups, and the distinct links of each row with how often they occur in it."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin, end, (totals, groups, ends, keys, times) in _batches(batch, byte_path, piece_path):
            offsets = pa.array(ends.astype(np.int32))
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[begin:end],
                    *(pa.array(totals[:, k]) for k in range(4)),
                    pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys, pa.int64())),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32), pa.int32())),
                ],
                ["doc_id", *SIZES, "groups_sha256", "links", "times"],
            )

    sizes = ", ".join(f"{c} long" for c in SIZES)
    return map_batches(rows, make, f"doc_id {kind}, {sizes}, groups_sha256 string, links array<long>, times array<int>")


def _counted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1) != 0)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def _documents_with(linked: DataFrame) -> DataFrame:
    """``link, n``: in how many rows each link occurs, combined in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("alignment")
        keys, times, size = [], [], 0

        def combined() -> tuple[np.ndarray, np.ndarray]:
            return _counted(np.concatenate(keys), np.concatenate(times))

        def sent(made: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(made[0], pa.int64()), pa.array(made[1], pa.int64())], ["link", "n"])

        for batch in batches:
            new = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            keys.append(new)
            times.append(np.ones(len(new), np.int64))
            size += len(new)
            if size > COMBINED:
                made = combined()
                if 2 * len(made[0]) > COMBINED:
                    yield sent(made)
                    keys, times, size = [], [], 0
                else:
                    keys, times, size = [made[0]], [made[1]], len(made[0])
        if size:
            yield sent(combined())

    partial = linked.select("links").mapInArrow(run, "link long, n long")
    return partial.groupBy("link").agg(F.sum("n").alias("n"))


def _rarest_frequent(counts: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` counts reach."""
    exponent = F.floor(F.log2("n")).cast("int")
    sizes = dict(counts.groupBy(exponent.alias("e")).agg(F.count("*").alias("n")).collect())
    e, total = max(sizes, default=0) + 1, 0
    while e > 0 and total + sizes.get(e - 1, 0) <= most:
        e -= 1
        total += sizes.get(e, 0)
    return 2**e


def link_statistics(
    docs: DataFrame, byte_path: str, piece_path: str, *, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row, of the tokens and groups
    of :func:`align`.

    The count of a pair of ids is the number of rows in which it is linked. ``n_best`` are the links whose count
    is the highest that A's id has with any id of B, ``count_sum`` is the sum over all links. ``groups_sha256`` is
    empty for a row without tokens. For null ids and such see :func:`align`.

    Texts are encoded once; their distinct links are stored. The counts of the ``frequent`` most frequent
    pairs are sent to all workers, a table of that size at most. Links of other pairs are joined with
    their counts by shuffle; none of these occurs in as many rows as a frequent pair, so no key is hot.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    linked = stage(_links(rows, byte_path, piece_path).withColumn("row", F.monotonically_increasing_id()), "linked")
    from sentencepiece import SentencePieceProcessor

    width = SentencePieceProcessor(model_file=piece_path).get_piece_size()
    counts = stage(_documents_with(linked).withColumn("a", F.floor(F.col("link") / width)), "counts")
    # One row for each id of A's vocabulary.
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = stage(
        counts.join(F.broadcast(best), "a").select("link", "n", (F.col("n") == F.col("most")).alias("best")), "counts"
    )
    least = _rarest_frequent(counts, frequent)
    table = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(table["link"].to_numpy())
    sent = spark.sparkContext.broadcast(tuple(table[c].to_numpy()[order] for c in ("link", "n", "best")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, n, best = sent.value
        column = batch.column(batch.schema.get_field_index("links"))
        links = column.flatten().to_numpy(zero_copy_only=False)
        times = batch.column(batch.schema.get_field_index("times")).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy(zero_copy_only=False))
        if len(known):
            at = np.minimum(np.searchsorted(known, links), len(known) - 1)
            hit = known[at] == links
            count = np.where(hit, n[at] * times, 0)
            good = np.where(hit & best[at], times, 0)
        else:
            hit = np.zeros(len(links), bool)
            count = good = np.zeros(len(links), np.int64)

        def total(x: np.ndarray) -> pa.Array:
            sums = np.concatenate(([0], np.cumsum(x)))
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            return pa.array(sums[ends[1:]] - sums[ends[:-1]])

        rest = ~hit
        offsets = pa.array(np.searchsorted(row[rest], np.arange(batch.num_rows + 1)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                *(batch.column(batch.schema.get_field_index(c)) for c in kept),
                total(good), total(count),
                pa.ListArray.from_arrays(offsets, pa.array(links[rest])),
                pa.ListArray.from_arrays(offsets, pa.array(times[rest])),
            ],
            [*kept, "n_best", "count_sum", "links", "times"],
        )

    kept = ["row", "doc_id", *SIZES, "groups_sha256"]
    sizes = ", ".join(f"{c} long" for c in [*SIZES])
    schema = f"row long, doc_id {kind}, {sizes}, groups_sha256 string, n_best long, count_sum long, links array<long>, times array<long>"
    found = map_batches(linked, make, schema)
    out = ["doc_id", *SIZES, "n_best", "count_sum", "groups_sha256"]
    rare = counts.where(F.col("n") < least)
    if rare.isEmpty():
        return found.select(*out)
    found = stage(found, "found")
    each = found.select("row", F.explode(F.arrays_zip("links", "times")).alias("x")).select("row", "x.links", "x.times")
    more = (
        each.join(rare, each["links"] == rare["link"])
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_count"),
        )
    )
    return found.join(more, "row", "left").select(
        "doc_id",
        *SIZES,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_count", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
