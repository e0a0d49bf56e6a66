"""Repeated byte strings: common prefixes from a Burrows-Wheeler transform, in ascending order of length.

A string of ``length`` bytes that starts at two places has the same *anchor* at both: the k-byte string in it
of the least hash, the leftmost of equals. So the windows of a text are dealt out by their anchor, and
neighbouring windows of one anchor travel as one segment. Segments whose anchor occurs once cannot repeat.
Of the others each distinct one goes, once, to the task of its anchor, which lays the segments of several
anchors end to end, derives which suffixes share ``length`` bytes, and reports the windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savora.llm.exact_dedup import BROADCAST_BYTES, DIGEST_BYTES
from savora.llm.text import map_batches, merged_runs, mix, texts
from savora.session import stage

TEXT_BYTES = 2 << 20  # laid end to end in one transform; about 80 bytes of memory for each
TASK_BYTES = 16 << 20  # of segments in one task
# Distinct segments of one anchor that go through a transform together. Beyond that, its windows are counted one
# by one over all tasks.
HOT_SEGMENTS = 2_000
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Powers:
    """Powers of a base and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self, base: int, inverse: int):
        self.base, self.inverse = base, inverse
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, x, np.uint64))))
                for x in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


POWERS = Powers(BASE, INVERSE)


def substring_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A hash of every substring of ``size`` bytes, the same wherever it stands."""
    up, down = POWERS.of(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1])))
    return mix((sums[size:] - sums[:-size]) * down[: len(raw) - size + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, from running minima of blocks in both directions."""
    if width == 1:
        return values
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def segments_of(raw: bytes, length: int) -> tuple[np.ndarray, ...]:
    """``start, windows, anchor, content`` of the segments of a text, in order.

    A segment are ``windows`` consecutive windows with one anchor; ``anchor`` and ``content`` are hashes.
    """
    k = max(1, length // 3)
    hashes = substring_hashes(np.frombuffer(raw, np.uint8), k)
    position = np.arange(len(hashes), dtype=np.uint64)
    order = hashes & np.uint64(0xFFFFFFFF00000000) | position
    at = sliding_least(order, length - k + 1) & np.uint64(0xFFFFFFFF)
    firsts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    windows = np.diff(np.concatenate((firsts, [len(at)])))
    anchor = hashes[at[firsts].astype(np.int64)].view(np.int64)
    view = memoryview(raw)
    content = [
        xxhash.xxh3_64_intdigest(view[s : s + w + length - 1]) for s, w in zip(firsts.tolist(), windows.tolist(), strict=True)
    ]
    return firsts, windows, anchor, np.array(content, np.uint64).view(np.int64)


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes in order of their first ``depth`` symbols (0 to 256), by prefix doubling."""
    n = len(symbols)
    padded = np.concatenate((symbols.astype(np.int64), np.zeros(7, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(7):
        key = key << 9 | padded[j : j + n]
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # row at which each row's group begins
    rank = np.empty(n, np.int64)
    rank[order] = first
    done = 7
    while done < depth:
        single = new & np.concatenate((new[1:], [True]))
        rows = np.flatnonzero(~single)
        if not len(rows):
            break
        at = order[rows]
        ahead = at + done
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        both = rank[at] * (n + 1) + second
        o = np.argsort(both)
        both, order[rows] = both[o], at[o]
        split = np.concatenate(([True], both[1:] != both[:-1]))
        new[rows] = split
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[rows]] = first[rows]
        done *= 2
    return order


def rows_sharing(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Rows of the suffix array that share ``length`` symbols or more with the row before.

    Common prefixes come in ascending order. Rows of other first symbols than the row before begin with 0. A
    row ``j`` of common prefix l bounds an interval of the transform; extended backward by one symbol it
    bounds intervals there, whose common prefix is l + 1 unless it is known to be less: in row LF(j), and
    in each row whose and whose predecessor's images lie on both sides of ``j``. As the images of neighbouring
    rows mostly are neighbours, the latter rows are few. Nothing is derived beyond ``length`` - 1.
    """
    n = len(order)
    row_of = np.empty(n, np.int32)
    row_of[order] = np.arange(n, dtype=np.int32)
    back = row_of[order - 1]  # LF: the row of the suffix that is one symbol longer
    image = row_of[(order + 1) % n]
    first = symbols[order]
    known = np.concatenate(([True], first[1:] != first[:-1]))
    low = np.minimum(image[1:], image[:-1])
    high = np.maximum(image[1:], image[:-1])
    wide = np.flatnonzero((high - low > 1) & ~known[1:]).astype(np.int32)
    low, high = low[wide], high[wide]
    wide += 1
    new = np.flatnonzero(known)
    for _ in range(1, length):
        if not len(new):
            break
        direct = back[new]
        # Suffixes alike beyond ``length`` stand in any order, and so do their images.
        direct = direct[~known[direct] & (image[direct - 1] < new)]
        known[direct] = True
        open_ = ~known[wide]
        wide, low, high = wide[open_], low[open_], high[open_]
        around = np.searchsorted(new, low, "right") < np.searchsorted(new, high, "right")
        across = wide[around]
        known[across] = True
        new = np.sort(np.concatenate((direct, across)))
    return np.flatnonzero(~known)


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each of the distinct ``parts``, the windows of ``length`` bytes that start in any other place, too."""
    sizes = np.array([len(p) for p in parts]) + 1
    symbols = np.frombuffer(b"\0".join([*parts, b""]), np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(sizes)
    symbols[ends - 1] = 0
    order = suffix_array(symbols, length + 1)
    rows = rows_sharing(symbols, order, length)
    starts = np.unique(np.concatenate((order[rows], order[rows - 1])))
    part = np.searchsorted(ends, starts, "right")
    inside = starts + length < ends[part]
    starts, part = starts[inside], part[inside]
    cuts = np.searchsorted(part, np.arange(len(parts) + 1))
    begins = ends - sizes
    return [starts[a:b] - begins[i] for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


SEGMENT = "anchor long, content long, windows long"
FLAGGED = f"{SEGMENT}, runs array<struct<begin:long,end:long>>"  # windows [begin, end) of a segment
RUNS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _locate(rows: DataFrame, length: int) -> DataFrame:
    """``key, start, anchor, content, windows`` of every segment of every text."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, keys = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = text.encode()
            if len(raw) >= length:
                found.append(segments_of(raw, length))
                keys += [key] * len(found[-1][0])
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 4
        start, windows, anchor, content = (pa.array(c, pa.int64()) for c in columns)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), start, anchor, content, windows], ["key", "start", "anchor", "content", "windows"]
        )

    return map_batches(rows, make, f"key binary, start long, {SEGMENT}")


def _fetch(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of ``wanted`` segments, each from the text ``at.key`` at ``at.start``."""
    asked = stage(
        wanted.groupBy(F.col("at.key").alias("key")).agg(
            F.collect_list(F.struct("anchor", "content", "windows", F.col("at.start").alias("start"))).alias("parts")
        ),
        "asked",
    )
    if asked.count() * DIGEST_BYTES <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(asked.select("key")), "key", "left_semi")
    # Of equal texts one serves; combined before the shuffle, so that copies do not meet in one task.
    joined = rows.dropDuplicates(["key"]).join(asked, "key").select("key", "text", "parts")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for text, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw = text.encode()
            for p in parts:
                out.append((p["anchor"], p["content"], p["windows"], raw[p["start"] : p["start"] + p["windows"] + length - 1]))
        columns = list(zip(*out, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "content", "windows", "bytes"]
        )

    return map_batches(joined, make, f"{SEGMENT}, bytes binary")


def _runs(windows: np.ndarray) -> list[dict]:
    return [{"begin": b, "end": e} for b, e in merged_runs(windows, 1)]


def _flag(segments: DataFrame, length: int, text_bytes: int) -> DataFrame:
    """``FLAGGED`` rows from segments that come sorted by anchor; a transform takes whole anchors."""

    def flush(held: dict[tuple, bytes]) -> pa.RecordBatch | None:
        found = repeated_windows(list(held.values()), length)
        hits = [(*name, _runs(w)) for name, w in zip(held, found, strict=True) if len(w)]
        if not hits:
            return None
        columns = zip(*hits, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), RUNS), strict=True)],
            ["anchor", "content", "windows", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, bytes] = {}
        size, last = 0, None
        for batch in batches:
            for anchor, content, windows, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= text_bytes and anchor != last:
                    if (made := flush(held)) is not None:
                        yield made
                    held, size = {}, 0
                held[anchor, content, windows] = raw
                size, last = size + len(raw), anchor
        if held and (made := flush(held)) is not None:
            yield made

    return segments.mapInArrow(run, FLAGGED)


def _count_windows(segments: DataFrame, length: int) -> DataFrame:
    """``FLAGGED`` rows of hot anchors: every window by itself, grouped by its bytes' hash and combined before
    the shuffle."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for i, raw in enumerate(batch.column(3).to_pylist()):
            view = memoryview(raw)
            out += [(i, w, xxhash.xxh3_128_digest(view[w : w + length])) for w in range(len(raw) - length + 1)]
        row = pa.array([i for i, _, _ in out])
        names = [batch.column(c).take(row) for c in range(3)]
        return pa.RecordBatch.from_arrays(
            [*names, pa.array([w for _, w, _ in out]), pa.array([h for _, _, h in out], pa.binary())],
            ["anchor", "content", "windows", "window", "hash"],
        )

    each = stage(map_batches(segments, make, f"{SEGMENT}, window long, hash binary"), "windows")
    often = each.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    run = F.struct(F.col("window").alias("begin"), (F.col("window") + 1).alias("end"))
    return each.join(often, "hash").groupBy("anchor", "content", "windows").agg(F.collect_set(run).alias("runs"))


def repeated_spans(
    docs: DataFrame, length: int = 400, *, id_col: str = "doc_id", text_col: str = "text",
    hot_segments: int = HOT_SEGMENTS, text_bytes: int = TEXT_BYTES, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """``doc_id, text, spans`` for every row of ``docs``: the maximal byte ranges of the text's UTF-8 covered
    by strings of ``length`` bytes that also start anywhere else.

    Matches never cross rows; overlapping ones in a row count, and so do those in equal rows. A null text is
    empty. Texts shorter than ``length`` have no spans. Rows are told apart by what they hold, so null and
    repeated ids do no harm; an empty table gives an empty result; other columns are not looked at.
    """
    key = F.unhex(F.md5(F.col("text").cast("binary")))
    rows = texts(docs, id_col, text_col).withColumn("key", key)
    long_rows = rows.where(F.octet_length("text") >= length).select("key", "text")
    found = stage(_locate(long_rows, length), "segments")
    name = ["anchor", "content", "windows"]
    distinct = found.groupBy(*name).agg(F.count("*").alias("n"), F.min(F.struct("key", "start")).alias("at"))
    shared = distinct.groupBy("anchor").agg(F.count("*").alias("variants"), F.sum("n").alias("total"))
    repeated = stage(distinct.join(shared.where("total > 1").drop("total"), "anchor"), "repeated")
    mixed = repeated.where("variants > 1")
    size = mixed.agg(F.sum(F.col("windows") + (length - 1))).first()[0] or 0
    fetched = stage(_fetch(long_rows, mixed, length), "fetched")
    hot = repeated.where(F.col("variants") > hot_segments).select("anchor").distinct()
    usual = fetched
    flagged = []
    if not hot.isEmpty():
        # At most one anchor in ``hot_segments`` distinct segments.
        usual = fetched.join(hot, "anchor", "left_anti")
        flagged.append(_count_windows(fetched.join(hot, "anchor", "left_semi"), length))
    sorted_ = usual.repartition(max(1, -(-size // task_bytes)), "anchor").sortWithinPartitions("anchor")
    flagged.append(_flag(sorted_, length, text_bytes))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("windows").alias("end")))
    flagged.append(repeated.where("n > 1").select(*name, whole.alias("runs")))
    runs = stage(reduce(DataFrame.unionByName, flagged), "runs")
    ranges = (
        found.join(runs, name)
        .select("key", "start", F.explode("runs").alias("run"))
        .select("key", F.struct((F.col("start") + F.col("run.begin")).alias("begin"), (F.col("start") + F.col("run.end") + (length - 1)).alias("end")).alias("r"))
    )
    # A text has at most as many ranges as bytes; equal texts have theirs once.
    per_text = ranges.groupBy("key").agg(F.collect_set("r").alias("ranges"))
    spans = _merged(per_text)
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    return rows.join(spans, "key", "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))


def _merged(per_text: DataFrame) -> DataFrame:
    """``key, spans``: overlapping and touching ranges of each text as one, ascending."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(1)
        begin, end = (column.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(2))
        row = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy(zero_copy_only=False))
        order = np.lexsort((begin, row))
        row, begin, end = row[order], begin[order], end[order]
        # The farthest end so far within a text; texts are told apart by an offset.
        offset = row * (int(end.max()) + 2)
        farthest = np.maximum.accumulate(end + offset)
        first = np.concatenate(([True], (begin + offset)[1:] > farthest[:-1]))
        at = np.flatnonzero(first)
        last = np.concatenate((at[1:], [len(row)])) - 1
        spans = pa.StructArray.from_arrays([pa.array(begin[at]), pa.array((farthest - offset)[last])], ["begin", "end"])
        offsets = np.searchsorted(row[at], np.arange(batch.num_rows + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), spans)], ["key", "spans"])

    return map_batches(per_text, make, "key binary, spans array<struct<begin:long,end:long>>")


def without_repeats(docs: DataFrame, length: int = 400, **options) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the bytes of each text that are left without its spans."""
    spans = repeated_spans(docs, length, **options)
    kind = spans.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, sizes = [], []
        for text, cut in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw, at, left = text.encode(), 0, []
            for s in cut:
                left.append(raw[at : s["begin"]])
                at = s["end"]
            kept.append(b"".join([*left, raw[at:]]))
            sizes.append(len(raw))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), batch.column(2), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )

    schema = f"doc_id {kind}, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"
    return map_batches(spans, make, schema)
