"""Helpers of the text operators: Arrow text buffers, byte-class words, word hashes.

Words of class ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` are runs of ASCII letters,
digits and every byte of a non-ASCII character, so they can be found on UTF-8
bytes with one table look-up a byte.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a task turns into numpy arrays at once: they take some 30 times as much, which a worker keeps for its next tasks.
CHUNK_BYTES = 256 << 10
#: Rows and bytes of an Arrow batch; Spark's 10,000 rows and 64 MB would not fit a small worker.
BATCH_ROWS = 1024
BATCH_BYTES = 1 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IS_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of an Arrow batch, unless the session asks for fewer.

    The settings are read when a plan runs, which is after the operator returns, so
    they stay set; README names them.
    """
    rows, size = (f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes"))
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    # Spark writes its default with a unit
    held = spark.conf.get(size).lower().removesuffix("b")
    if not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))


def small_table(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A frame of a few rows that the driver holds. It goes to the JVM as Arrow: a list would have every executor keep a further pool of Python workers, for RDDs."""
    return spark.createDataFrame(pa.table(columns))


def kept(documents: DataFrame, keep: list[str] | None, added: Iterable[str]) -> list[str]:
    """The columns to keep, all by default, but those whose names an operator adds: its own take their place."""
    own = {c.lower() for c in added}
    return [c for c in (documents.columns if keep is None else keep) if c.lower() not in own]


def unused(documents: DataFrame, name: str) -> str:
    """``name``, lengthened until no column has it: for an operator's inner columns."""
    taken = {c.lower() for c in documents.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the n+1 bounds of its rows (null: empty)."""
    if texts.null_count:
        texts = texts.fill_null("")
    offset_type = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, offset_type, n + 1, texts.offset * np.dtype(offset_type).itemsize).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return raw, bounds - bounds[0]


def chunked(column: pa.ChunkedArray | pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of rows of about ``limit`` bytes; a longer text stands alone."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw, bounds = text_buffer(array)
    low, n = 0, len(bounds) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1)
        high = min(high, n)
        yield low, high, raw[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


def text_runs(column: pa.ChunkedArray | pa.Array, limit: int = CHUNK_BYTES) -> Iterator[list[str]]:
    """The texts as Python strings (null: empty), some ``limit`` bytes at a time; a longer text stands alone."""
    for low, high, _, _ in chunked(column, limit):
        yield [t or "" for t in column.slice(low, high - low).to_pylist()]


def find_words(raw: np.ndarray, bounds: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of words, and each row's first word (n+1 entries); ``is_word`` tells for a lower-cased byte whether it is of a word."""
    low = LOWER[raw]
    inside = is_word[low]
    before = np.zeros(len(low), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(low), bool)
    after[:-1] = inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(low))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return low, starts, ends, np.searchsorted(starts, bounds)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as asked for."""

    def __init__(self) -> None:
        self.n = 0
        self.up = self.down = np.zeros(0, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
            self.n = size
        return self.up[:n], self.down[:n]


POWERS = Powers()


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, equal for equal bytes wherever the word stands."""
    up, down = POWERS.of(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of every (start, length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    offsets = np.cumsum(lengths) - lengths
    return np.repeat(starts - offsets, lengths) + np.arange(total)
