"""Fill-in-middle transformation: cuts found by rank queries on a wavelet matrix over character classes.

Every byte of a run of texts has a class: it continues a character, or starts one,
and then perhaps a word or a line. A wavelet matrix of the classes answers how
many bytes of a class stand before any place; sums of such ranks count the
characters, words or lines of a text, and bisection on them finds the byte at
which the k-th unit starts. All texts of a run are answered together.

Two seeded hashes of a document's id give its cuts, a third decides whether it is
transformed, a fourth the order of the parts. psm is prefix, suffix, middle; spm is
suffix, prefix, middle; plain texts stay as they are.

Defined results: null and empty texts are plain and empty; texts that hold one of
the marks are plain, so that ``restored`` is exact; a null id hashes as an empty
one; rows that repeat an id are cut by the same hashes; columns named as the
result's own are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import chunked, kept, small_batches, unused

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
SEED = "1"
#: Of 100 documents, so many are transformed, and of 100 of these, so many have the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
ADDED = ("n", "form", "prefix_chars", "middle_chars", "fim")

#: Classes of a byte.
INSIDE, CHARACTER, WORD, LINE, LINE_WORD = range(5)
LEVELS = 3
#: The classes at which a unit starts.
UNITS = {"character": (CHARACTER, WORD, LINE, LINE_WORD), "word": (WORD, LINE_WORD), "line": (LINE, LINE_WORD)}

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def classes(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The class of every byte of the texts between ``bounds``."""
    starts = (raw & 0xC0) != 0x80
    space = _SPACE[raw]
    first = np.zeros(len(raw), bool)
    first[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    after_space, after_line = first.copy(), first
    after_space[1:] |= space[:-1]
    after_line[1:] |= raw[:-1] == 10
    word = starts & ~space & after_space
    return np.where(after_line, np.where(word, LINE_WORD, LINE), np.where(word, WORD, starts)).astype(np.uint8)


class Bits:
    """A bit vector that counts the ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class WaveletMatrix:
    """Symbols under 2 ** levels, one bit vector a level, zeros before ones."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS) -> None:
        self.rows: list[tuple[int, Bits, int]] = []
        for shift in reversed(range(levels)):
            ones = (symbols >> shift & 1).astype(bool)
            self.rows.append((shift, Bits(ones), len(ones) - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of ``symbol`` stand before each place."""
        low, high = np.zeros(1, np.int64), at
        for shift, bits, zeros in self.rows:
            if symbol >> shift & 1:
                low, high = zeros + bits.ones(low), zeros + bits.ones(high)
            else:
                low, high = low - bits.ones(low), high - bits.ones(high)
        return high - low

    def ranks(self, symbols: Sequence[int], at: np.ndarray) -> np.ndarray:
        return sum((self.rank(s, at) for s in symbols), np.zeros(len(at), np.int64))


def unit_counts(matrix: WaveletMatrix, bounds: np.ndarray, unit: str) -> np.ndarray:
    """The number of units of every text."""
    return np.diff(matrix.ranks(UNITS[unit], bounds))


def unit_offsets(matrix: WaveletMatrix, bounds: np.ndarray, unit: str, k: np.ndarray) -> np.ndarray:
    """Where each text's unit number k (from 0) starts: 0 for the first, the text's end if it has no such unit."""
    low, high = bounds[:-1].copy(), bounds[1:].copy()
    wanted = matrix.ranks(UNITS[unit], low) + k
    while (open_ := low < high).any():
        # the units that start at or before the middle tell on which side the start lies
        mid = (low + high) // 2
        reached = matrix.ranks(UNITS[unit], np.minimum(mid + 1, bounds[-1])) > wanted
        high = np.where(open_ & reached, mid, high)
        low = np.where(open_ & ~reached, mid + 1, low)
    return np.where(k == 0, bounds[:-1], low)


def _hashes(doc_id: str, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers of the id."""
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(sha, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "character", keep: list[str] | None = None, marks: Sequence[str] = MARKS, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST, seed: str = SEED) -> DataFrame:
    """The documents with n (units), form, prefix_chars and middle_chars (units; null if plain) and fim, the output text."""
    small_batches(documents.sparkSession)
    columns = kept(documents, keep, ADDED)
    inner = [unused(documents, f"_h{i}") for i in range(5)]
    *hashed, body = inner
    p_mark, s_mark, m_mark = (m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [batch.column(c).to_numpy() for c in hashed]
            for low, high, raw, bounds in chunked(batch.column(body)):
                h1, h2, h3, h4 = (x[low:high] for x in h)
                matrix = WaveletMatrix(classes(raw, bounds))
                n = unit_counts(matrix, bounds, unit)
                one, two = h1 % (n + 1), h2 % (n + 1)
                first, second = np.minimum(one, two), np.maximum(one, two)
                cut, end = (unit_offsets(matrix, bounds, unit, k) for k in (first, second))
                data, forms, outs = raw.tobytes(), [], []
                plain = (n == 0) | (h3 % 100 >= transformed)
                spm = h4 % 100 < suffix_first
                for i, (a, p, m, b) in enumerate(zip(bounds[:-1].tolist(), cut.tolist(), end.tolist(), bounds[1:].tolist(), strict=True)):
                    whole = data[a:b]
                    if plain[i] or any(mark in whole for mark in (p_mark, s_mark, m_mark)):
                        plain[i] = True
                        forms.append("plain")
                        outs.append(whole)
                    elif spm[i]:
                        forms.append("spm")
                        outs.append(b"".join((s_mark, data[m:b], p_mark, data[a:p], m_mark, data[p:m])))
                    else:
                        forms.append("psm")
                        outs.append(b"".join((p_mark, data[a:p], s_mark, data[m:b], m_mark, data[p:m])))
                part = batch.slice(low, high - low)
                numbers = [pa.array(n), pa.array(forms), pa.array(first, mask=plain), pa.array(second - first, mask=plain), pa.array(outs, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *numbers], [*columns, *ADDED])

    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType([*(documents.schema[c] for c in columns), *map(T.StructField, ADDED, kinds)])
    given = documents.select(*columns, *(c.alias(name) for c, name in zip(_hashes(doc_id, seed), hashed, strict=True)), F.coalesce(F.col(text), F.lit("")).alias(body))
    return given.mapInArrow(run, schema)


def restored(fim: Column | str = "fim", form: Column | str = "form", marks: Sequence[str] = MARKS) -> Column:
    """The text that an output and its form come from; exact, as transformed texts hold no mark and no mark overlaps another."""
    fim, form = (F.col(c) if isinstance(c, str) else c for c in (fim, form))
    between = lambda a, b: F.substring_index(F.substring_index(fim, b, 1), a, -1) if b else F.substring_index(fim, a, -1)
    p, s, m = marks
    psm = F.concat(between(p, s), between(m, ""), between(s, m))
    spm = F.concat(between(p, m), between(m, ""), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(fim)
