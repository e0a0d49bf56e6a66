"""Periodic runs of words, found in a grammar of the text.

Re-Pair replaces pairs of symbols that occur more than once by nonterminals, so a repeated stretch is looked
at once however often it occurs. A run crosses the boundary between the two parts of exactly one place of the
derivation tree that holds it whole; the runs across the boundary of a nonterminal are therefore computed once,
taken to all places where it is derived, and merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from savora.llm.text import map_batches, mix, slices, texts

SLICE_BYTES = 1 << 20  # of texts worked on at once
CANDIDATES = 1 << 20  # pairs of places compared at once
SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Grammar:
    """Nonterminal ``k`` has the parts ``left[k], right[k]`` (symbols below ``terminals`` are words) and once
    stands at ``at[k]``; ``top`` is what is left of the text, whose symbols begin at ``top_at``. A symbol covers
    ``length`` words."""

    terminals: int
    left: np.ndarray
    right: np.ndarray
    at: np.ndarray
    length: np.ndarray
    top: np.ndarray
    top_at: np.ndarray


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key occurs more than once, and how often it does."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    counts = np.diff(np.append(first, len(keys)))
    many = np.repeat(counts, counts)
    count = np.empty(len(keys), np.int64)
    count[order] = many
    at = np.flatnonzero(count > 1)
    return at, count[at]


def re_pair(seq: np.ndarray, terminals: int) -> Grammar:
    """Re-Pair in rounds: each replaces every occurrence of a pair that is more frequent than the pairs it
    overlaps (of equally frequent ones the order is random), until no pair occurs twice."""
    at = np.arange(len(seq))
    left, right, places = [], [], []
    length = np.ones(terminals, np.int64)
    known, known_symbols = np.empty(0, np.int64), np.empty(0, np.int64)  # pairs that have a nonterminal, ascending
    while len(seq) > 2:
        keys = seq[:-1] << 32 | seq[1:]
        where, count = _repeated(keys)
        if not len(where):
            break
        key = keys[where]
        # The frequency, and below it bits of a hash that decide between equally frequent pairs.
        rank = (np.minimum(count, (1 << 23) - 1).astype(np.uint64) << np.uint64(40)) | (
            mix(key.astype(np.uint64) * SPREAD) >> np.uint64(24)
        )
        follows = np.diff(where) == 1
        less = np.zeros(len(where), bool)
        less[1:] |= follows & ((rank[1:] < rank[:-1]) | (rank[1:] == rank[:-1]) & (key[1:] != key[:-1]))
        less[:-1] |= follows & (rank[:-1] < rank[1:])
        chosen = where[~less]
        # A word said over and over overlaps with itself: every other pair of such a row.
        new_row = np.concatenate(([True], np.diff(chosen) > 1))
        row_at = chosen[np.flatnonzero(new_row)][np.cumsum(new_row) - 1]
        chosen = chosen[(chosen - row_at) % 2 == 0]
        made, one, symbol = np.unique(keys[chosen], return_index=True, return_inverse=True)
        fresh = ~np.isin(made, known, assume_unique=True)
        left.append(made[fresh] >> 32)
        right.append(made[fresh] & 0xFFFFFFFF)
        places.append(at[chosen[one[fresh]]])
        new = len(length) + np.arange(len(left[-1]))
        length = np.concatenate((length, length[left[-1]] + length[right[-1]]))
        known, known_symbols = np.concatenate((known, made[fresh])), np.concatenate((known_symbols, new))
        order = np.argsort(known)
        known, known_symbols = known[order], known_symbols[order]
        seq = seq.copy()
        seq[chosen] = known_symbols[np.searchsorted(known, made)][symbol.ravel()]
        keep = np.ones(len(seq), bool)
        keep[chosen + 1] = False
        seq, at = seq[keep], at[keep]
    none = np.empty(0, np.int64)
    return Grammar(
        terminals, np.concatenate([none, *left]), np.concatenate([none, *right]), np.concatenate([none, *places]),
        length, seq, at,
    )


def _top_nodes(g: Grammar, cuts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``low, middle, high`` of the places that put the top symbols of each text together, two by two.

    ``cuts`` are the beginnings of the texts, with ``total`` at the end.
    """
    out = []
    begins = np.append(g.top_at, total)
    first = np.searchsorted(begins, cuts)  # no symbol spans two texts
    low, high = first[:-1], first[1:]
    while len(low):
        wide = high - low > 1
        low, high = low[wide], high[wide]
        middle = (low + high) // 2
        out.append((begins[low], begins[middle], begins[high]))
        low, high = np.concatenate((low, middle)), np.concatenate((middle, high))
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Agreement:
    """How far two places agree, by ids of all strings of 1, 2, 4, ... words that occur more than once."""

    def __init__(self, seq: np.ndarray):
        self.ids = [seq]
        width = 1
        while 2 * width <= len(seq):
            ids = self.ids[-1]
            keys = ids[:-width] << 32 | ids[width:]
            _, now = np.unique(keys, return_inverse=True)
            if now.max(initial=0) + 1 == len(now):
                break
            self.ids.append(now.ravel().astype(np.int64))
            width *= 2

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and ``b`` on are the same, ``most`` at most (``a <= b``, ``b + most`` in the text)."""
        done = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ids))):
            # The longest step may be taken several times, the others once.
            going = np.arange(len(a))
            while len(going):
                going = going[done[going] + (1 << k) <= most[going]]
                same = self.ids[k][a[going] + done[going]] == self.ids[k][b[going] + done[going]]
                going = going[same]
                done[going] += 1 << k
                if k < len(self.ids) - 1:
                    break
        return done

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and ``b`` are the same, ``most`` at most (``a - most`` in the text)."""
        done = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ids))):
            going = np.arange(len(a))
            while len(going):
                step = done[going] + (1 << k)
                going, step = going[step <= most[going]], step[step <= most[going]]
                same = self.ids[k][a[going] - step] == self.ids[k][b[going] - step]
                going = going[same]
                done[going] += 1 << k
                if k < len(self.ids) - 1:
                    break
        return done


def _crossing(
    seq: np.ndarray, agree: Agreement, low: np.ndarray, middle: np.ndarray, high: np.ndarray, least: int
) -> tuple[np.ndarray, ...]:
    """``node, start, end, period`` of the runs across ``middle`` inside ``[low, high)`` of each node.

    A run of period q reaches q words to the left of the boundary or q to its right. In the first case the
    word after the boundary stands q before it too, in the second the word before it q later.
    """
    found: list[tuple[np.ndarray, ...]] = []
    half = (high - low) // 2
    for rightward in (False, True):
        reach = np.minimum(half, (high - middle) if rightward else (middle - low))
        reach[high - low < least] = 0
        ends = np.cumsum(reach)
        begin = 0
        while begin < len(reach):
            # Some nodes at a time; one node with more candidates than that is cut by its periods.
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + CANDIDATES, "right")))
            total = int(ends[end - 1] - base)
            for at in range(0, total, CANDIDATES):
                flat = np.arange(at, min(total, at + CANDIDATES)) + base
                node = np.searchsorted(ends, flat, "right")
                q = flat - (ends[node] - reach[node]) + 1
                a = middle[node] - 1 if rightward else middle[node] - q
                same = seq[a] == seq[a + q]
                node, q, a = node[same], q[same], a[same]
                # Words that agree with those q later, from the place on and before it.
                after = agree.forward(a, a + q, high[node] - a - q)
                before = agree.backward(a, a + q, a - low[node])
                start, stop = a - before, a + q + after
                good = (stop - start >= np.maximum(least, 2 * q)) & (start < middle[node]) & (stop > middle[node])
                found.append((node[good], start[good], stop[good], q[good]))
            begin = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 4


def _derived(g: Grammar) -> tuple[np.ndarray, np.ndarray]:
    """Every place of the derivation: the nonterminal, and where it begins."""
    symbol, at = g.top, g.top_at
    out_symbol, out_at = [], []
    while True:
        inner = symbol >= g.terminals
        symbol, at = symbol[inner] - g.terminals, at[inner]
        if not len(symbol):
            break
        out_symbol.append(symbol)
        out_at.append(at)
        left, right = g.left[symbol], g.right[symbol]
        symbol, at = np.concatenate((left, right)), np.concatenate((at, at + g.length[left]))
    none = np.empty(0, np.int64)
    return np.concatenate([none, *out_symbol]), np.concatenate([none, *out_at])


def _maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs without the parts of longer ones of the same period, each with its smallest period."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        # The farthest end so far within the period: periods are told apart by an offset.
        offset = period * (int(end.max()) + 1)
        farthest = np.maximum.accumulate(end + offset)
        keep = np.concatenate(([True], (end + offset)[1:] > farthest[:-1]))
        start, end, period = start[keep], end[keep], period[keep]
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        keep = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))
        start, end, period = start[keep], end[keep], period[keep]
        order = np.lexsort((period, start))
        start, end, period = start[order], end[order], period[order]
    return start, end, period


def grammar_runs(seq: np.ndarray, cuts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, period`` of the runs of several texts in a row, by start.

    ``cuts`` are the texts' beginnings and the end of all; no word id is used in two texts, so that no pair
    of one text counts in another.
    """
    _, seq = np.unique(seq, return_inverse=True)
    seq = seq.ravel().astype(np.int64)
    g = re_pair(seq, int(seq.max(initial=-1)) + 1)
    agree = Agreement(seq)
    # Nonterminals, where they stand once.
    width = g.length[g.terminals :]
    node, start, end, period = _crossing(seq, agree, g.at, g.at + g.length[g.left], g.at + width, least)
    # To all places where they are derived.
    symbol, at = _derived(g)
    used = np.isin(symbol, node)
    symbol, at = symbol[used], at[used]
    order = np.argsort(node, kind="stable")
    ranked = node[order]
    first, last = np.searchsorted(ranked, symbol, "left"), np.searchsorted(ranked, symbol, "right")
    times = last - first
    which = order[np.arange(times.sum()) + np.repeat(first - np.cumsum(times) + times, times)]
    moved = np.repeat(at, times) - g.at[node[which]]
    _, top_start, top_end, top_period = _crossing(seq, agree, *_top_nodes(g, cuts, len(seq)), least)
    return _maximal(
        np.concatenate((start[which] + moved, top_start)),
        np.concatenate((end[which] + moved, top_end)),
        np.concatenate((period[which], top_period)),
    )


def _regions(seq: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``begin, end`` of the maximal stretches of words in strings of ``size`` words that occur again in the same text.

    Strings are compared by a hash; two that share one by chance only make a stretch longer.
    """
    n = len(seq) - size + 1
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    own = text[:n] == text[size - 1 :]
    value = text[:n].astype(np.uint64)
    for k in range(size):
        value = (value ^ seq[k : k + n].astype(np.uint64)) * SPREAD
        value ^= value >> np.uint64(29)
    where = np.flatnonzero(own)
    value = value[where]
    ranked = np.sort(value)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    near = np.minimum(np.searchsorted(twice, value), len(twice) - 1)
    begin = where[twice[near] == value]
    # Stretches that touch are one, unless another text begins there.
    cut = (np.diff(begin) > size) | (text[begin[1:]] != text[begin[:-1]])
    first = begin[np.concatenate(([True], cut))]
    last = begin[np.concatenate((cut, [True]))] + size
    return first, last


def runs_of(texts_words: list[list[bytes]], least: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``start, length, period`` of the runs of each text."""
    counts = np.array([len(w) for w in texts_words])
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for words in texts_words for w in words), np.int64, counts.sum())
    text = np.repeat(np.arange(len(counts)), counts)
    # In a run of ``least`` words or of twice its period, each word is in a string of half as many that occurs again.
    begin, end = _regions(seq, text, max(1, least // 2))
    none = np.empty(0, np.int64)
    out = [(none, none, none)] * len(counts)
    wide = end - begin >= max(2, least)
    begin, end = begin[wide], end[wide]
    if not len(begin):
        return out
    size = end - begin
    cuts = np.concatenate(([0], np.cumsum(size)))
    place = np.arange(cuts[-1]) + np.repeat(begin - cuts[:-1], size)
    # Stretches are told apart, so that each has a grammar of its own rules.
    part = np.repeat(np.arange(len(size)), size)
    start, stop, period = grammar_runs(part * len(ids) + seq[place], cuts, least)
    offset = np.concatenate(([0], np.cumsum(counts)))
    owner = text[place[start]]
    at = place[start] - offset[owner]
    edges = np.searchsorted(owner, np.arange(len(counts) + 1))
    for i in np.unique(owner).tolist():
        a, b = edges[i], edges[i + 1]
        out[i] = at[a:b], (stop - start)[a:b], period[a:b]
    return out


def _kept(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    """The words that are in no run after its first period."""
    start, length, period = runs
    if not len(start):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    gone = np.cumsum(step[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def word_runs(
    docs: DataFrame, least: int = 12, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    Words are what stands between ``[\\x20\\x09-\\x0D]``, numbered from 0. A run is a stretch of consecutive words with
    smallest period q (words q apart are identical) of at least ``max(least, 2 q)`` words that no neighbouring word
    extends; ``runs`` are ``start, length, period`` by start, then period. ``collapsed`` are the words that no run
    contains after its first q words, joined by a space. A text that is null, empty or without words has no
    runs and an empty collapsed text. Repeated rows and null ids each keep their own row; an empty table gives
    an empty result; other columns are not looked at.

    A grammar is built of those stretches only whose strings of ``least // 2`` words occur again in the same
    text: a run lies in one of them as a whole. Texts are worked on about 1 MB at a time; one that is longer takes memory in
    proportion to its repeated stretches.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = batch.column(1).cast(pa.binary())
        for begin, end in slices(pc.binary_length(raw).to_pylist(), SLICE_BYTES):
            words = [t.split() for t in raw[begin:end].to_pylist()]
            runs = runs_of(words, least)
            offsets = np.concatenate(([0], np.cumsum([len(r[0]) for r in runs]))).astype(np.int32)
            fields = [pa.array(np.concatenate([r[k] for r in runs]), pa.int64()) for k in range(3)]
            flat = pa.StructArray.from_arrays(fields, fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[begin:end],
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), flat),
                    pa.array([_kept(w, r) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    schema = "runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_batches(rows, make, f"doc_id {kind}, n_words long, {schema}")
