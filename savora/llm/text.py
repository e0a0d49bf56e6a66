"""What the text operators share: column selection, Arrow batches, word splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from savora.session import configure

# A batch of long texts stays small enough for a Python worker.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

WHITE = b" \t\n\x0b\x0c\r"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Lower-case A-Z; every other ASCII byte that is no letter or digit becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` only, so that other columns cannot clash; a null text is empty."""
    prepare(docs.sparkSession)
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, or the first longer form of it that is no column."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


_memories: list[tuple[str, Callable[[], None]]] = []


def remembered(owner: str, maxsize: int = 1) -> Callable:
    """``lru_cache`` for what Python workers keep between tasks of the module ``owner``."""

    def wrap(function: Callable) -> Callable:
        cached = lru_cache(maxsize)(function)
        _memories.append((owner, cached.cache_clear))
        return cached

    return wrap


def forget_others(owner: str) -> None:
    """Workers are used again by later stages; each keeps the memory of one operator at a time."""
    for name, clear in _memories:
        if name != owner:
            clear()


def map_batches(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch] | None], schema: str
) -> DataFrame:
    """``make`` on every non-empty Arrow batch; it returns a batch, or yields several."""
    owner = make.__module__.rpartition(".")[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(owner)
        for batch in batches:
            if batch.num_rows:
                made = make(batch)
                for part in [made] if made is None or isinstance(made, pa.RecordBatch) else made:
                    if part is not None and part.num_rows:
                        yield part

    return df.mapInArrow(run, schema)


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of ``most`` bytes in all, or of one row that is longer."""
    begin = end = total = 0
    for size in sizes:
        if end > begin and total + size > most:
            yield begin, end
            begin, total = end, 0
        end += 1
        total += size
    if end > begin:
        yield begin, end


def words(text: str) -> list[bytes]:
    """Runs of digits, a-z (A-Z lower-cased) and anything beyond ASCII."""
    return text.encode().translate(WORD_BYTES).split()


class WordHashes(dict):
    """64-bit hash of a word, remembered; forgets everything once it holds ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a common finaliser of multiplications and shifts)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def lists(values: list, kind: pa.DataType) -> pa.ListArray:
    """A list column from NumPy arrays, without a Python object per value."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def merged_runs(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal runs covered by ``[s, s + width)`` for ascending ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > width) + 1
    firsts = starts[np.concatenate(([0], cut))]
    lasts = starts[np.concatenate((cut - 1, [len(starts) - 1]))]
    return list(zip(firsts.tolist(), (lasts + width).tolist(), strict=True))


def flat(parts) -> list:
    return list(chain.from_iterable(parts))
