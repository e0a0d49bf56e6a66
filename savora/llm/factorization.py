"""Factorisation machines over hashed words and text statistics: quality and toxicity of documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from savora.llm.text import WordHashes, flat, lists, map_batches, prepare, remembered, unused, words

# Bytes by kind; everything else (letters, what is beyond ASCII) is not counted.
KINDS = {
    "upper": range(65, 91),
    "digit": range(48, 58),
    "space": (9, 10, 11, 12, 13, 32),
    "stop": b".!?",
    "mark": b",;:'\"()-",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
}
KIND_OF = np.zeros((256, len(KINDS)), np.int64)
for _k, _members in enumerate(KINDS.values()):
    KIND_OF[list(_members), _k] = 1
BINS = 32  # slots of one statistic
# Deviations between the shares of two classes from which a word is an input; of a hundred thousand words that
# mean nothing a few are that far apart. Of some million pairs of words as few are PAIR_APART apart.
TOLD_APART, PAIR_APART = 3.5, 5.5
# Words in the first share of the sampled texts are looked at in pairs, those in the second are inputs in any case.
PAIRED, FREQUENT = 0.05, 0.5


@dataclass(frozen=True)
class Design:
    """Which inputs a machine has. Word slots come first, then ``BINS`` slots for each statistic."""

    word_bits: int = 18
    statistics: bool = True
    # Words count as one each, or share a length of one, so that long texts weigh no more.
    unit_length: bool = True

    @property
    def word_slots(self) -> int:
        return 1 << self.word_bits

    @property
    def slots(self) -> int:
        return self.word_slots + BINS * (len(KINDS) + 9)


@dataclass(frozen=True)
class Machine:
    """``bias + <w, x> + sum of <v_i, v_j> x_i x_j`` over the slots kept in ``slots``."""

    design: Design
    slots: np.ndarray
    bias: float
    w: np.ndarray
    v: np.ndarray


@remembered("factorization")
def _hashes() -> WordHashes:
    return WordHashes()


def _log_bin(x: np.ndarray, most: int = BINS - 1) -> np.ndarray:
    return np.minimum(np.log2(x + 1).astype(np.int64), most)


def _statistics(rows: list[str], lengths: list[int | None]) -> np.ndarray:
    """A bin per row and statistic, on scales of powers of two; shares are counted in 1/1024."""
    out = np.zeros((len(rows), len(KINDS) + 9), np.int64)
    for i, text in enumerate(rows):
        raw = text.encode()
        kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ KIND_OF
        run, lines = raw.split(), raw.split(b"\n")
        n, n_lines = max(1, len(run)), len(lines)
        distinct = len(set(run))
        repeats = sum(map(bytes.__eq__, run, run[1:]))
        known = lengths[i]
        shares = [*kinds / max(1, len(raw)), distinct / n, repeats / n, 1 - len(set(lines)) / n_lines]
        out[i, : len(shares)] = _log_bin(1024 * np.array(shares))
        sizes = np.array([len(run), n_lines, len(raw) / n, n / n_lines, len(raw), known or 0])
        out[i, len(shares) :] = _log_bin(sizes)
        if known is None:
            out[i, -1] = BINS - 1
    return out


def inputs(rows: list[str], lengths: list, design: Design, index: np.ndarray | None = None):
    """Row numbers and slots of the distinct inputs of each text, in order of the rows.

    ``index`` renumbers the slots; those it maps below 0 are left out.
    """
    split = [words(t) for t in rows]
    slots = (_hashes().of(flat(split)) & np.uint64(design.word_slots - 1)).astype(np.int64)
    at = np.repeat(np.arange(len(rows)), [len(s) for s in split])
    if design.statistics:
        bins = _statistics(rows, lengths)
        base = design.word_slots + BINS * np.arange(bins.shape[1])
        slots = np.concatenate((slots, (base + bins).ravel()))
        at = np.concatenate((at, np.repeat(np.arange(len(rows)), bins.shape[1])))
    size = design.slots
    if index is not None:
        slots, size = index[slots], len(index)
        at, slots = at[slots >= 0], slots[slots >= 0]
    pairs = np.unique(at * size + slots)
    return pairs // size, pairs % size


def _values(at: np.ndarray, slots: np.ndarray, design: Design, n_rows: int) -> np.ndarray:
    """The x of each input: 1, or for words with ``unit_length`` one over the root of their number."""
    x = np.ones(len(slots))
    if design.unit_length:
        word = slots < design.word_slots
        count = np.bincount(at[word], minlength=n_rows)
        x[word] = 1 / np.sqrt(count[at[word]])
    return x


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums per row; ``at`` ascends."""
    out = np.zeros((n, *values.shape[1:]))
    if len(at):
        firsts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        out[at[firsts]] = np.add.reduceat(values, firsts)
    return out


def scores(rows: list[str], lengths: list, machine: Machine, index: np.ndarray) -> np.ndarray:
    """Probabilities. Pairs cost no more than single inputs: their sum is half of (square of the sum of
    v x, less the sum of the squares of v x), per factor."""
    at, kept = inputs(rows, lengths, machine.design, index)
    x = _values(at, machine.slots[kept], machine.design, len(rows))
    vx = machine.v[kept] * x[:, None]
    linear = _sums(at, machine.w[kept] * x, len(rows))
    pairs = (_sums(at, vx, len(rows)) ** 2 - _sums(at, vx**2, len(rows))).sum(axis=1) / 2
    return 1 / (1 + np.exp(-np.clip(machine.bias + linear + pairs, -30, 30)))


def _index(machine: Machine) -> np.ndarray:
    index = np.full(machine.design.slots, -1, np.int64)
    index[machine.slots] = np.arange(len(machine.slots))
    return index


def with_score(
    docs: DataFrame, machine: Machine, *, text_col: str = "text", length_col: str | None = "n_chars", name: str = "score"
) -> DataFrame:
    """``docs`` and a column ``name``: the probability of label 1. All rows and columns pass through.

    A null text counts as empty; an empty text is scored by its statistics (without them, by the bias).
    ``length_col`` is metadata and may hold nulls or be missing.
    """
    prepare(docs.sparkSession)
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    text_at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None
    sent = docs.sparkSession.sparkContext.broadcast((machine, _index(machine)))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = batch.column(length_at).to_pylist() if length_at is not None else [None] * batch.num_rows
        rows = [t or "" for t in batch.column(text_at).to_pylist()]
        made = scores(rows, known, *sent.value)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], [*batch.schema.names, name])

    return map_batches(docs, make, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def fit(
    docs: DataFrame, labels: DataFrame, design: Design, *, id_col: str = "doc_id", text_col: str = "text",
    length_col: str | None = "n_chars", label_col: str = "label", rows_per_class: int = 3000,
    factors: int = 8, epochs: int = 30, seed: int = 1,
) -> Machine:
    """Learn from at most ``rows_per_class`` labelled documents of each class, chosen by the hash of their id.

    ``labels`` has ``id_col`` and ``label_col`` (0 or 1); rows with a null are left out, of several labels
    for an id the largest counts. Inputs of the machine are words whose shares in the two classes differ by more
    than chance allows for, words of pairs that do so together, frequent words, and all statistics; there is no bound on their
    number. Words seen by chance would else be learned by heart. Without documents of both classes the machine returns the share of label 1,
    or one half if there is none at all.
    """
    prepare(docs.sparkSession)
    known = (
        labels.select(labels[id_col].alias("__id"), labels[label_col].cast("int").alias("label"))
        .where("__id is not null and label in (0, 1)").groupBy("__id").agg(F.max("label").alias("label"))
    )
    order = F.xxhash64(F.col("__id").cast("string"), F.lit(seed))
    some = [known.where(F.col("label") == c).orderBy(order, "__id").limit(rows_per_class) for c in (0, 1)]
    sample = some[0].unionByName(some[1])
    length = docs[length_col] if length_col in docs.columns else F.lit(None)
    rows = docs.select(
        docs[id_col].alias("__id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
        length.cast("long").alias("length"),
    ).join(F.broadcast(sample), "__id").drop("__id")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, slots = inputs(batch.column(0).to_pylist(), batch.column(1).to_pylist(), design)
        cuts = np.searchsorted(at, np.arange(batch.num_rows + 1))
        per_row = [slots[a:b] for a, b in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([batch.column(2), lists(per_row, pa.int64())], ["label", "slots"])

    # Bounded: a row per sampled document, with the slots of its distinct words.
    seen = map_batches(rows, make, "label int, slots array<bigint>").toArrow()
    y = seen["label"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        share = np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6)
        none = np.empty(0, np.int64)
        return Machine(design, none, float(np.log(share / (1 - share))), np.empty(0), np.empty((0, factors)))
    per_row = seen["slots"].combine_chunks()
    offsets = per_row.offsets.to_numpy()
    slots = per_row.values.to_numpy()[offsets[0] : offsets[-1]]
    # In an order that does not depend on how the rows were dealt out.
    at = np.repeat(np.arange(len(y)), np.diff(offsets))
    rank = np.lexsort((_fingerprints(at, slots, len(y)), y))
    return _train(design, np.argsort(rank)[at], slots, y[rank], factors, epochs, seed)


def _fingerprints(at: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, (slots * 2654435761 % (1 << 32)).astype(float), minlength=n)


def _apart(one: np.ndarray, zero: np.ndarray, n_one: int, n_zero: int) -> np.ndarray:
    """By how many deviations the shares ``one / n_one`` and ``zero / n_zero`` differ, corrected for whole counts."""
    both, step = (one + zero) / (n_one + n_zero), 1 / n_one + 1 / n_zero
    spread = np.sqrt(np.maximum(both * (1 - both), 1e-12) * step)
    return (np.abs(one / n_one - zero / n_zero) - step / 2) / spread


def _telling_pairs(words: np.ndarray, at: np.ndarray, slots: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Those of ``words`` that tell the classes apart together with another one of them."""
    code = np.full(int(slots.max(initial=0)) + 1, -1, np.int64)
    code[words] = np.arange(len(words))
    use = code[slots] >= 0
    seen = np.zeros((len(positive), len(words)), np.float32)
    seen[at[use], code[slots[use]]] = 1
    telling = np.zeros(len(words), bool)
    n_one, n_zero = positive.sum(), (~positive).sum()
    for low in range(0, len(words), 512):
        part = seen[:, low : low + 512]
        one, zero = part[positive].T @ seen[positive], part[~positive].T @ seen[~positive]
        apart = _apart(one, zero, n_one, n_zero) > PAIR_APART
        apart[np.arange(len(apart)), low + np.arange(len(apart))] = False
        telling[low : low + 512] |= apart.any(axis=1)
    return words[telling]


def _train(design, at, slots, y, factors, epochs, seed) -> Machine:
    n, positive = len(y), y == 1
    one = np.bincount(slots[positive[at]], minlength=design.slots)
    zero = np.bincount(slots[~positive[at]], minlength=design.slots)
    told = np.flatnonzero(_apart(one, zero, positive.sum(), n - positive.sum()) > TOLD_APART)
    share = (one + zero)[: design.word_slots] / n
    # Of texts of m words there are at most m / PAIRED such words.
    paired, frequent = np.flatnonzero(share >= PAIRED), np.flatnonzero(share >= FREQUENT)
    statistics = np.flatnonzero((one + zero)[design.word_slots :]) + design.word_slots
    kept = np.unique(np.concatenate((told, _telling_pairs(paired, at, slots, positive), frequent, statistics)))
    index = np.full(design.slots, -1, np.int64)
    index[kept] = np.arange(len(kept))
    use = index[slots] >= 0
    at, slots = at[use], slots[use]
    x = np.zeros((n, len(kept)), np.float32)
    x[at, index[slots]] = _values(at, slots, design, n)
    random = np.random.default_rng(seed)
    w, v, bias = np.zeros(len(kept)), random.normal(0, 0.01, (len(kept), factors)), 0.0
    grown_w, grown_v, grown_b = np.full_like(w, 1e-8), np.full_like(v, 1e-8), 1e-8
    weight = np.where(positive, n / (2 * positive.sum()), n / (2 * (n - positive.sum())))
    rate, shrink, size = 0.1, 1e-4, 128
    for _ in range(epochs):
        for part in np.array_split(random.permutation(n), -(-n // size)):
            b = x[part].astype(float)
            s = b @ v
            z = bias + b @ w + (s**2 - (b**2) @ (v**2)).sum(axis=1) / 2
            g = weight[part] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
            dw = b.T @ g + shrink * w
            dv = b.T @ (g[:, None] * s) - ((b**2).T @ g)[:, None] * v + shrink * v
            db = g.sum()
            grown_w, grown_v, grown_b = grown_w + dw**2, grown_v + dv**2, grown_b + db**2
            w, v, bias = w - rate * dw / np.sqrt(grown_w), v - rate / 4 * dv / np.sqrt(grown_v), bias - rate * db / np.sqrt(grown_b)
    return Machine(design, kept, float(bias), w, v)


QUALITY = Design(statistics=True, unit_length=True)
TOXICITY = Design(statistics=False, unit_length=False)


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", **options) -> Machine:
    """Words, structure of the text and its length; label 1 is a good document."""
    return fit(docs, labels, QUALITY, label_col=label_col, **options)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", **options) -> Machine:
    """Terms and their pairs; label 1 is a toxic document."""
    return fit(docs, labels, TOXICITY, label_col=label_col, **options)


def keep_good(docs: DataFrame, machine: Machine, threshold: float = 0.5, **columns) -> DataFrame:
    """The rows of ``docs`` scored ``threshold`` or more."""
    name = unused("__score", docs.columns)
    return with_score(docs, machine, name=name, **columns).where(F.col(name) >= threshold).drop(name)
