"""Benchmark decontamination with a generalised suffix automaton over words of the test items."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from savora.session import stage
from savora.llm.text import WORD_BYTES, map_batches, prepare, remembered, texts, unused, words

# Words of items in one automaton, about 100 bytes of memory each in every Python worker. More items
# make further blocks, each a pass over the documents.
BLOCK_WORDS = 200_000
# Longer items are cut into pieces that overlap by a window less one word, which loses no window.
PIECE_WORDS = 5_000
WORD = re.compile(rb"[^ ]+")
SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
ARRAY = ArrayType(StructType([StructField("begin", LongType()), StructField("end", LongType())]))
NAMES = ArrayType(StringType())


class Automaton:
    """Suffix automaton of several word sequences.

    A state stands for substrings of lengths ``(longest[suffix link], longest]`` that end at the same
    places. Transitions are one dictionary keyed ``state << 32 | word``.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.step: dict[int, int] = {}
        self.longest, self.link, self.out = [0], [-1], [[]]
        coded = [(item, [self.ids.setdefault(w, len(self.ids)) for w in seq]) for item, seq in items]
        for _, seq in coded:
            last = 0
            for w in seq:
                last = self._append(last, w)
        self.items: dict[int, set[str]] = {}
        whole: dict[int, list[tuple[int, str]]] = {}
        for item, seq in coded:
            state = 0
            for n, w in enumerate(seq, 1):
                state = self.step[state << 32 | w]
                if n >= window:
                    # The state of the prefix holds longer strings; its last ``window`` words lie up the links.
                    self.items.setdefault(self._at(state, window), set()).add(item)
            if 0 < len(seq) < window:
                whole.setdefault(self._at(state, len(seq)), []).append((len(seq), item))
        order = sorted(range(len(self.longest)), key=self.longest.__getitem__)
        # Short items that end wherever a state's strings end: its own and those up its links.
        self.short: list[tuple] = [()] * len(order)
        self.full = [0] * len(order)
        for s in order[1:]:
            above = self.link[s]
            self.short[s] = self.short[above] + tuple(whole.get(s, ()))
            if self.longest[s] >= window:
                self.full[s] = s if self.longest[above] < window else self.full[above]
        self.out = None

    def _at(self, state: int, length: int) -> int:
        while self.longest[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _new(self, longest: int, link: int) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.out.append([])
        return len(self.longest) - 1

    def _go(self, state: int, w: int, to: int) -> None:
        if (state << 32 | w) not in self.step:
            self.out[state].append(w)
        self.step[state << 32 | w] = to

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of ``q`` for the strings that come through ``p``."""
        copy = self._new(self.longest[p] + 1, self.link[q])
        for x in self.out[q]:
            self._go(copy, x, self.step[q << 32 | x])
        self.link[q] = copy
        while p >= 0 and self.step.get(p << 32 | w) == q:
            self.step[p << 32 | w] = copy
            p = self.link[p]
        return copy

    def _append(self, last: int, w: int) -> int:
        q = self.step.get(last << 32 | w)
        if q is not None:  # an earlier item has this substring
            return q if self.longest[q] == self.longest[last] + 1 else self._split(last, w, q)
        new, p = self._new(self.longest[last] + 1, 0), last
        while p >= 0 and (p << 32 | w) not in self.step:
            self._go(p, w, new)
            p = self.link[p]
        if p >= 0:
            q = self.step[p << 32 | w]
            self.link[new] = q if self.longest[q] == self.longest[p] + 1 else self._split(p, w, q)
        return new

    def scan(self, seq: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges ``[begin, end)`` of the hits, merged, and the items that occur."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        step, longest, link, window, short = self.step.get, self.longest, self.link, self.window, self.short
        state = length = 0
        for end, w in enumerate(map(self.ids.get, seq), 1):
            if w is None:
                state = length = 0
                continue
            to = step(state << 32 | w)
            while to is None and state:
                state = link[state]
                length = longest[state]
                to = step(state << 32 | w)
            if to is None:
                continue
            state = to
            length += 1
            hit = 0
            if length >= window:
                hit = window
                found |= self.items[self.full[state]]
            if short[state]:
                for n, item in short[state]:
                    if n <= length:
                        found.add(item)
                        hit = max(hit, n)
            if hit:
                begin = end - hit
                while spans and begin <= spans[-1][1]:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, end))
        return spans, found


@remembered("decontaminate")
def _automaton(items: tuple, window: int) -> Automaton:
    return Automaton([(item, seq.split(b" ")) for item, seq in items], window)


def _blocks(items: DataFrame, window: int, id_col: str, text_col: str, block_words: int) -> tuple[DataFrame, int]:
    """``block, item, words`` of the items' pieces, stored in order of the block, and the number of blocks."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seq = words(text)
            for at in range(0, max(1, len(seq) - window + 1), PIECE_WORDS) if seq else ():
                part = seq[at : at + PIECE_WORDS + window - 1]
                rows.append((item, at, len(part), b" ".join(part)))
        return pa.RecordBatch.from_pylist(
            [dict(zip(("item", "at", "n", "words"), r, strict=True)) for r in rows],
            pa.schema([("item", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("words", pa.binary())]),
        )

    named = texts(items, id_col, text_col).select(F.col("doc_id").cast("string").alias("item"), "text")
    pieces = map_batches(named.where("item is not null"), cut, "item string, at long, n long, words binary")
    total = pieces.agg(F.sum("n").alias("n")).first()["n"] or 0
    count = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item", "at"), F.lit(count))
    numbered = pieces.select(block.alias("block"), "item", "words").sortWithinPartitions("block")
    return stage(numbered, "blocks"), count


def _block(pieces: DataFrame, number: int) -> tuple:
    """One block; it goes to the workers, which build its automaton."""
    rows = pieces.where(F.col("block") == number).select("item", "words").collect()
    return tuple((r["item"], bytes(r["words"])) for r in rows)


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _scan(df: DataFrame, text_col: str, blocks: tuple[DataFrame, int], window: int, finish, schema) -> DataFrame:
    """``finish(batch, found)`` on every batch of ``df``; ``found`` has words, spans and items of each row.

    One block at a time is in the memory of the driver and the workers; between blocks the rows are stored with what
    was found.
    """
    spark = df.sparkSession
    text_at = df.columns.index(text_col)
    spans_col, items_col = (unused(name, df.columns) for name in ("__spans", "__items"))
    carried = StructType([*df.schema.fields, StructField(spans_col, ARRAY), StructField(items_col, NAMES)])
    pieces, count = blocks
    for k in range(count):
        sent = spark.sparkContext.broadcast(_block(pieces, k))
        first, last = k == 0, k == count - 1

        def make(batch: pa.RecordBatch, sent=sent, first=first, last=last) -> pa.RecordBatch:
            automaton = _automaton(sent.value, window)
            rows = [words(t or "") for t in batch.column(text_at).to_pylist()]
            found = [(len(seq), *automaton.scan(seq)) for seq in rows]
            if not first:
                old = [[(x["begin"], x["end"]) for x in s] for s in batch.column(spans_col).to_pylist()]
                names = batch.column(items_col).to_pylist()
                found = [
                    (n, _union(spans + before), items.union(known))
                    for (n, spans, items), before, known in zip(found, old, names, strict=True)
                ]
                batch = batch.select(batch.schema.names[:-2])
            if last:
                return finish(batch, found)
            return pa.RecordBatch.from_arrays(
                [*batch.columns, _span_column(found), _name_column(found)],
                [*batch.schema.names, spans_col, items_col],
            )

        df = map_batches(df, make, schema if last else carried)
        if not last:
            df = stage(df, "scanned")
            sent.destroy()
    return df


def _span_column(found) -> pa.Array:
    return pa.array([[{"begin": b, "end": e} for b, e in s] for _, s, _ in found], SPANS)


def _name_column(found) -> pa.Array:
    return pa.array([sorted(names) for _, _, names in found], pa.list_(pa.string()))


def overlaps(
    docs: DataFrame, items: DataFrame, window: int = 10, *, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items`` for every row of ``docs``.

    ``spans`` are the maximal ranges ``[begin, end)`` of words inside an occurrence of a window, a window
    being ``window`` consecutive words of an item, or a whole shorter item. ``items`` are the names of the
    items with an occurring window, sorted as strings. A text that is null or without words has no spans;
    an item without words or without a name has no window; equal items are all named; repeated rows and
    null ids each keep their own row. No items: no spans. Other columns are not looked at.

    The automaton streams each text once and keeps the longest matching suffix; the documents are never
    shuffled. Items beyond ``block_words`` words are scanned for in further blocks.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def finish(batch: pa.RecordBatch, found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([sum(e - b for b, e in s) for _, s, _ in found], pa.int64()),
                _span_column(found),
                _name_column(found),
            ],
            ["doc_id", "n_words", "n_hit", "spans", "items"],
        )

    return _scan(
        rows, "text", _blocks(items, window, item_id, item_text, block_words), window, finish,
        f"doc_id {kind}, n_words long, n_hit long, spans array<struct<begin:long,end:long>>, items array<string>",
    )


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    raw = text.encode()
    at = [(m.start(), m.end()) for m in WORD.finditer(raw.translate(WORD_BYTES))]
    kept, done = [], 0
    for begin, end in spans:
        kept.append(raw[done : at[begin][0]])
        done = at[end - 1][1]
    return (b"".join(kept) + raw[done:]).decode()


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, min_span: int = 1, *,
    text_col: str = "text", length_col: str | None = "n_chars", item_id: str = "item_id",
    item_text: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with every hit span of ``min_span`` words or more cut out of the text.

    A document whose spans cover more than ``max_coverage`` of its words goes altogether. Spans are those
    of :func:`overlaps`; what stands between words goes with the span only if it lies inside. All columns
    pass through, ``length_col`` (if there is one) is set to the new length of changed texts. Texts without
    spans, also null and empty ones, are returned as they are.
    """
    prepare(docs.sparkSession)
    text_at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def finish(batch: pa.RecordBatch, found) -> pa.RecordBatch:
        column = batch.column(text_at)
        rows = column.to_pylist()
        keep = [sum(e - b for b, e in s) <= max_coverage * n for n, s, _ in found]
        cut = [[x for x in s if x[1] - x[0] >= min_span] for _, s, _ in found]
        new = [_without(t, s) if s and k else t for t, s, k in zip(rows, cut, keep, strict=True)]
        arrays = batch.columns
        arrays[text_at] = pa.array(new, column.type)
        if length_at is not None:
            old = batch.column(length_at)
            sizes = [len(t) if s else n for t, s, n in zip(new, cut, old.to_pylist(), strict=True)]
            arrays[length_at] = pa.array(sizes, pa.int64()).cast(old.type)
        return pa.RecordBatch.from_arrays(arrays, schema=batch.schema).filter(pa.array(keep))

    blocks = _blocks(items, window, item_id, item_text, block_words)
    return _scan(docs, text_col, blocks, window, finish, docs.schema)
