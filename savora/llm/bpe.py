"""Byte-level BPE with forced boundaries: fragments that no merge can join are encoded on their own.

Two bytes that stand side by side in no token are never joined by a merge, so a text may be cut between
them, its fragments encoded independently of each other, and their ids put in a row. The vocabulary's
splitting pattern looks at neighbouring characters, too; of the forced boundaries those are used where it
cuts in any case, or goes on alike on both sides.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savora.llm.fragments import byte_of_char
from savora.llm.text import WHITE, lists, map_batches, remembered, slices, texts

SLICE_BYTES = 1 << 20  # of texts worked on at once
HELD_BYTES = 96 << 20  # of fragments and ids that a worker remembers
ENTRY_BYTES = 180  # of a remembered fragment besides its bytes
LONGEST = 48  # bytes of a fragment that is remembered
AT_ONCE = 10_000  # fragments handed to the library in one call, as its results are large


def _byte_set(members) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(members)] = True
    return flags


SPACE = _byte_set(WHITE)
LETTER = _byte_set([*range(65, 91), *range(97, 123)])
VISIBLE = _byte_set(set(range(33, 127)) - {ord("'")})
# First bytes of two-byte characters that are no white space, and of longer ones that are none.
PLAIN_2, PLAIN_3 = _byte_set(range(0xC3, 0xE0)), _byte_set(range(0xE4, 0xF0))


class Vocabulary:
    """What cutting and decoding need of a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = byte_of_char()
        special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        tokens = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items()} | special
        self.adjoin = np.zeros((256, 256), bool)
        for token in tokens:
            pair = np.frombuffer(token, np.uint8)
            self.adjoin[pair[:-1], pair[1:]] = True
        by_id = {i: t for t, i in tokens.items()}
        rows = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.flat = np.frombuffer(b"".join(rows), np.uint8)
        self.size = np.array([*map(len, rows), 0])  # the last stands for ids beyond the vocabulary
        self.start = np.cumsum(self.size) - self.size

    def boundaries(self, raw: bytes, letters: bool) -> np.ndarray:
        """Places in ``raw`` to cut at, in ascending order.

        Between two bytes that adjoin in no token, if

        * white space follows a character that is none: the pattern ends a piece there; or
        * with ``letters``, an ASCII letter follows a visible ASCII character: a piece ends there or is a row
          of letters, cut in two. Places just after an apostrophe are left alone because of ``'ll`` and the like.
        """
        b = np.frombuffer(raw, np.uint8)
        if len(b) < 2:
            return np.empty(0, np.int64)
        if letters:
            at = np.flatnonzero(LETTER[b[1:]] & VISIBLE[b[:-1]]) + 1
            at = at[(at < 2) | (b[at - 2] != ord("'"))]
        else:
            at = np.flatnonzero(SPACE[b[1:]]) + 1
            before, second, third = b[at - 1], b[np.maximum(at - 2, 0)], b[np.maximum(at - 3, 0)]
            wide = PLAIN_2[second] | (second >= 128) & (second < 192) & PLAIN_3[third]
            at = at[VISIBLE[before] | (before == ord("'")) | (before >= 128) & wide]
        return at[~self.adjoin[b[at - 1], b[at]]]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens one after the other. Unknown ids are left out."""
        ids = np.where((ids >= 0) & (ids < len(self.size)), ids, len(self.size) - 1)
        size = self.size[ids]
        places = np.arange(size.sum()) + np.repeat(self.start[ids] - np.cumsum(size) + size, size)
        return self.flat[places].tobytes()


@remembered("bpe", 2)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Ids of fragments as packed numbers; those of short fragments are remembered up to a size."""

    def __init__(self, path: str, held_bytes: int = HELD_BYTES):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocabulary = vocabulary_of(path)
        self.known: dict[bytes, bytes] = {}
        self.held, self.held_bytes = 0, held_bytes

    def texts(self, raw: list[bytes]) -> list[np.ndarray]:
        """Ids of each text: cut where white space begins, then what is new within words."""
        fragments, counts = self._cut(raw, False)
        fresh = set(fragments).difference(self.known)
        made = self._encoded(list(fresh))
        size = sum(map(len, made)) + sum(map(len, made.values())) + ENTRY_BYTES * len(made)
        if self.held + size > self.held_bytes:
            self.known, self.held = {f: self.known[f] for f in set(fragments).difference(made)}, 0
            self.held = sum(ENTRY_BYTES + len(f) + len(i) for f, i in self.known.items())
        self.known.update(made)
        self.held += size
        ids = list(map(self.known.__getitem__, fragments))
        for f in made:
            if len(f) > LONGEST:
                self.held -= ENTRY_BYTES + len(f) + len(self.known.pop(f))
        ends = np.cumsum(counts).tolist()
        return [np.frombuffer(b"".join(ids[a:b]), "<i4") for a, b in zip([0, *ends], ends)]

    def _cut(self, raw: list[bytes], letters: bool) -> tuple[list[bytes], np.ndarray]:
        """All fragments in a row, and how many there are of each text."""
        joined = b"".join(raw)
        ends = np.cumsum([0, *map(len, raw)])
        cuts = np.unique(np.concatenate((ends, self.vocabulary.boundaries(joined, letters))))
        at = cuts.tolist()
        return [joined[a:b] for a, b in zip(at, at[1:])], np.diff(np.searchsorted(cuts, ends))

    def _encoded(self, fresh: list[bytes]) -> dict[bytes, bytes]:
        parts, counts = self._cut(fresh, True)
        distinct = list(set(parts))
        ids: dict[bytes, bytes] = {}
        for at in range(0, len(distinct), AT_ONCE):
            some = distinct[at : at + AT_ONCE]
            made = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)]
            packed = np.fromiter(chain.from_iterable(made), "<i4").tobytes()
            ends = (np.cumsum([0, *map(len, made)]) * 4).tolist()
            ids.update(zip(some, [packed[a:b] for a, b in zip(ends, ends[1:])], strict=True))
        ends = np.cumsum(counts).tolist()
        return {f: b"".join([ids[p] for p in parts[a:b]]) for f, a, b in zip(fresh, [0, *ends], ends)}


@remembered("bpe", 2)
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


def _encoded_slices(batch: pa.RecordBatch, path: str) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The first row and the ids of some rows at a time, so that memory does not grow with the batch."""
    raw = batch.column(1).cast(pa.binary())
    for begin, end in slices(pc.binary_length(raw).to_pylist(), SLICE_BYTES):
        yield begin, encoder_of(path).texts(raw[begin:end].to_pylist())


def _decoded(ids: list[np.ndarray], path: str) -> pa.Array:
    run = vocabulary_of(path).decode
    # What is no UTF-8 becomes U+FFFD.
    return pa.array([run(i).decode("utf-8", "replace") for i in ids], pa.string())


def encode(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` for every row: the ids of the whole text as an array.

    A null or empty text has none. Names of special tokens in a text are those tokens. Repeated rows and
    null ids each keep their own row; an empty table gives none; other columns are not looked at.
    ``vocabulary`` is a file that every executor has at this path.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin, ids in _encoded_slices(batch, vocabulary):
            columns = [batch.column(0)[begin : begin + len(ids)], lists(ids, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    return map_batches(rows, make, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids, text`` from ``doc_id, ids``; null ids are an empty text, unknown ones are left out."""
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column = batch.column(1)
        for begin, end in slices(column.value_lengths().to_pylist(), SLICE_BYTES // 4):
            part = batch.slice(begin, end - begin)
            ids = [i.values.to_numpy(zero_copy_only=False) for i in part.column(1)]
            yield pa.RecordBatch.from_arrays([*part.columns, _decoded(ids, vocabulary)], ["doc_id", "ids", "text"])

    return map_batches(rows, make, f"doc_id {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, text`` of :func:`encode` and :func:`decode`, without sending the ids to the JVM in between."""
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin, ids in _encoded_slices(batch, vocabulary):
            columns = [batch.column(0)[begin : begin + len(ids)], lists(ids, pa.int32()), _decoded(ids, vocabulary)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"])

    return map_batches(rows, make, f"doc_id {kind}, ids array<int>, text string")
