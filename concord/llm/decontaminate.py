"""Benchmark decontamination by Wu-Manber search over word sequences.

The symbols of the search are words. A benchmark item gives windows of ten
consecutive words (an item of one to nine words is one window). Windows of equal
length m form a group with a shift table over blocks of two words: a block that
ends j words into some window allows a shift of m - j, an unknown block the
largest. Positions with shift zero look up the windows that end in that block in
a suffix-hash bucket; the surviving windows are compared word by word, first by
hash and then byte by byte, so a result never rests on a hash alone.

Tasks run the scan for many positions at once (one lane for each stretch of a
document), over whole texts. A Spark job cuts the benchmark into blocks of a
bounded number of windows and bytes, also within long items; the driver takes one
block at a time and broadcasts its tables. Up to CHAINED_BLOCKS blocks are scanned
in one pass over the documents. Where there are more, the documents are numbered
and written once, every pass writes only what it found, by number, and the
findings are joined to the documents at the end; texts are not written again.

Defined results: a null or wordless text has no words and no hits; items with
null id or no words are ignored; equal item ids are one item; repeated document
rows come out as often as they went in; other columns are kept as they are, but
those with the names of the result's own, which these replace.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import chunked, find_words, kept, ragged, small_batches, small_table, word_hashes
from concord.session import written

WINDOW_WORDS = 10
#: Windows of one broadcast block (about 100 bytes each, so some 20 MB), and bytes of their words.
BLOCK_WINDOWS, BLOCK_BYTES = 200_000, 32 << 20
#: Blocks scanned in one pass over the documents.
CHAINED_BLOCKS = 4
#: Words of a stretch, into which long items are cut.
STRETCH_WORDS = 5000
_LANE = 256
_K = np.uint64(0xA0761D6478BD642F)
_C = np.uint64(0xE7037ED1A0B428DB)


class _Group:
    """Tables for windows of m words."""

    def __init__(self, m: int, hashes: np.ndarray, ids: np.ndarray) -> None:
        self.m, self.block = m, min(2, m)
        self.bits = int(min(22, max(12, np.ceil(np.log2(len(ids) * m + 1)) + 3)))
        self.shift = np.full(1 << self.bits, m - self.block + 1, np.int8)
        for end in range(self.block, m + 1):
            keys = self.key(hashes[:, end - 2] if self.block == 2 else None, hashes[:, end - 1])
            np.minimum.at(self.shift, keys, np.int8(m - end))
        last = self.key(hashes[:, m - 2] if self.block == 2 else None, hashes[:, m - 1])
        order = np.argsort(last, kind="stable")
        self.hashes, self.ids = hashes[order], ids[order]
        self.bucket = np.searchsorted(last[order], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def key(self, previous: np.ndarray | None, last: np.ndarray) -> np.ndarray:
        mixed = last * _C if previous is None else (previous * _K + last) * _C
        return ((mixed ^ (mixed >> np.uint64(31))) * _K >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last words of windows that agree in every word's hash, and the rows of the windows."""
        begin, end = first[:-1] + self.m - 1, first[1:]
        keep = begin < end
        begin, end = begin[keep], end[keep]
        if not len(begin):
            return begin, begin
        lanes = -(-(end - begin) // _LANE)
        at = np.repeat(begin, lanes) + _LANE * ragged(np.zeros(len(lanes), np.int64), lanes)
        stop = np.minimum(at + _LANE, np.repeat(end, lanes))
        found: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        while len(at):
            key = self.key(h[at - 1] if self.block == 2 else None, h[at])
            step = self.shift[key]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
                keys.append(key[zero])
            at = at + np.maximum(step, 1)
            alive = at < stop
            at, stop = at[alive], stop[alive]
        if not found:
            none = np.zeros(0, np.int64)
            return none, none
        last, key = np.concatenate(found), np.concatenate(keys)
        low, size = self.bucket[key].astype(np.int64), (self.bucket[key + 1] - self.bucket[key]).astype(np.int64)
        last, row = np.repeat(last, size), ragged(low, size)
        for j in range(self.m):
            same = h[last - self.m + 1 + j] == self.hashes[row, j]
            last, row = last[same], row[same]
        return last, row


class WindowSearch:
    """Wu-Manber tables of one block of benchmark windows."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]) -> None:
        patterns = list(windows)
        self.items = [sorted(windows[p]) for p in patterns]
        words = [w for p in patterns for w in p]
        lengths = np.array([len(w) for w in words], np.int64)
        self.text = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        self.word_start, self.word_length = ends - lengths, lengths
        hashes = word_hashes(self.text, self.word_start, ends) if words else np.zeros(0, np.uint64)
        sizes = np.array([len(p) for p in patterns], np.int64)
        self.first_word = np.cumsum(sizes) - sizes
        self.groups = []
        for m in np.unique(sizes):
            ids = np.flatnonzero(sizes == m)
            at = self.first_word[ids][:, None] + np.arange(m)
            self.groups.append(_Group(int(m), hashes[at], ids))

    def _same_bytes(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, last: np.ndarray, pattern: np.ndarray, m: int) -> np.ndarray:
        """Direct comparison of each window's words with the text's."""
        if not len(last):
            return np.zeros(0, bool)
        mine = ((last - m + 1)[:, None] + np.arange(m)).ravel()
        theirs = (self.first_word[pattern][:, None] + np.arange(m)).ravel()
        length = ends[mine] - starts[mine]
        same = length == self.word_length[theirs]
        length = np.where(same, length, 0)
        equal = low[ragged(starts[mine], length)] == self.text[ragged(self.word_start[theirs], length)]
        wrong = np.concatenate([[0], np.cumsum(~equal)])
        bounds = np.concatenate([[0], np.cumsum(length)])
        same &= wrong[bounds[1:]] == wrong[bounds[:-1]]
        return same.reshape(-1, m).all(axis=1)

    def scan(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[set[str]]]:
        """Per row: number of words, hit words as [start, end) runs in one flat array, items with occurrences."""
        low, starts, ends, first = find_words(raw, bounds)
        n = len(bounds) - 1
        edge = np.zeros(len(starts) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(n)]
        h = word_hashes(low, starts, ends)
        for group in self.groups:
            last, row = group.candidates(h, first)
            pattern = group.ids[row]
            same = self._same_bytes(low, starts, ends, last, pattern, group.m)
            last, pattern = last[same], pattern[same]
            np.add.at(edge, last - group.m + 1, 1)
            np.add.at(edge, last + 1, -1)
            document = np.searchsorted(first, last, side="right") - 1
            for d, p in set(zip(document.tolist(), pattern.tolist(), strict=True)):
                items[d].update(self.items[p])
        hit = np.concatenate([[0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]])
        runs: list[np.ndarray] = []
        for d in range(n):
            inside = hit[first[d] + 1 : first[d + 1] + 1] if items[d] else np.zeros(0, np.int8)
            change = np.flatnonzero(np.diff(np.concatenate([[0], inside, [0]])))
            runs.append(change.astype(np.int32))
        return np.diff(first), runs, items


def in_blocks(benchmark: DataFrame, item_id: str, item_text: str, words: int = WINDOW_WORDS, windows: int = BLOCK_WINDOWS, size: int = BLOCK_BYTES) -> DataFrame:
    """(item, words, block): the lower-cased words of each item, in stretches that hold each of its windows once.

    A block is about as many stretches as hold ``windows`` windows or ``size`` bytes,
    whichever are fewer, whatever the table's partitions.
    """
    spark = benchmark.sparkSession
    small_batches(spark)
    length = min(STRETCH_WORDS, windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = 0.0
        for batch in batches:
            items, found, before, shares = [], [], [], []
            for low, high, raw, bounds in chunked(batch.column(1)):
                lower, starts, ends, first = find_words(raw, bounds)
                data = lower.tobytes()
                for k in range(high - low):
                    a, b = int(first[k]), int(first[k + 1])
                    for at in range(a, max(b - words + 1, a + (b > a)), length):
                        to = min(b, at + length + words - 1)
                        part = b" ".join(data[x:y] for x, y in zip(starts[at:to].tolist(), ends[at:to].tolist(), strict=True))
                        share = max(max(1, to - at - words + 1) / windows, len(part) / size)
                        items.append(batch.column(0)[low + k].as_py())
                        found.append(part)
                        before.append(filled)
                        shares.append(share)
                        filled += share
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(found, pa.binary()), pa.array(before, pa.float64()), pa.array(shares, pa.float64())], ["item", "words", "before", "share"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null")
    cut = written(rows.mapInArrow(run, "item string, words binary, before double, share double").withColumn("part", F.spark_partition_id()), "stretches")
    totals = cut.groupBy("part").agg(F.sum("share").alias("share")).orderBy("part").collect()  # a row per partition of the benchmark
    at = np.cumsum([0.0, *(r["share"] for r in totals)])
    offsets = small_table(spark, part=pa.array([r["part"] for r in totals], pa.int32()), offset=pa.array(at[: len(totals)]))
    return cut.join(F.broadcast(offsets), "part").select("item", "words", F.floor(F.col("offset") + F.col("before")).alias("block"))


def windows_of(rows: Iterable[tuple[str, bytes]], words: int = WINDOW_WORDS) -> dict[tuple[bytes, ...], set[str]]:
    """The distinct windows of a block's stretches, each with the ids of its items."""
    block: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in rows:
        found = text.split(b" ")
        for i in range(max(1, len(found) - words + 1)):
            block.setdefault(tuple(found[i : i + words]), set()).add(item)
    return block


def _merge_runs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not len(a) or not len(b):
        return a if len(a) else b
    pairs = np.concatenate([a, b]).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    at = np.flatnonzero(new)
    return np.stack([pairs[at, 0], reach[np.concatenate([at[1:] - 1, [len(pairs) - 1]])]], axis=1).ravel()


_FOUND = ("_n_words", "_runs", "_items")
_ADDED = ("n_words", "n_hit", "items", "hit_runs", "contaminated")


def _n_hit(runs: str) -> Column:
    total = F.aggregate(F.sequence(F.lit(0), (F.size(runs) / 2).cast("int") - 1), F.lit(0).cast("long"), lambda s, i: s + F.element_at(runs, i * 2 + 2) - F.element_at(runs, i * 2 + 1))
    return F.when(F.size(runs) > 0, total).otherwise(F.lit(0).cast("long"))


def find_passages(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``documents`` (the columns ``keep``, all by default) with what stands in the benchmark.

    Adds n_words, n_hit (long), items (array of item ids as strings, sorted),
    hit_runs (array of [start, end) word positions) and contaminated.
    """
    spark = documents.sparkSession
    small_batches(spark)
    keep = kept(documents, keep, _ADDED)
    blocks = in_blocks(benchmark, item_id, item_text, windows=block_windows)
    numbers = [r["block"] for r in blocks.select("block").distinct().orderBy("block").collect()]  # one for each block

    def tables(at: list[int]) -> Iterator:
        for number in at or [None]:
            rows = blocks.where(F.col("block") == number).select("item", "words").collect() if number is not None else []
            yield spark.sparkContext.broadcast(WindowSearch(windows_of((r["item"], bytes(r["words"])) for r in rows)))

    def scanned(df: DataFrame, own: list[str], at: list[int]) -> DataFrame:
        found = [T.StructField("_n_words", T.LongType()), T.StructField("_runs", T.ArrayType(T.IntegerType())), T.StructField("_items", T.ArrayType(T.StringType()))]
        schema = T.StructType([*(df.schema[c] for c in own), *found])
        return df.select(*dict.fromkeys([*own, text])).mapInArrow(_scanner(list(tables(at)), text, own), schema)

    plain = documents.select(*dict.fromkeys([*keep, text]))
    inner = [f"_c{i}" for i in range(len(plain.columns))]  # no clash with the names of this module
    text, outer, plain = inner[plain.columns.index(text)], plain.columns, plain.toDF(*inner)
    own = [inner[outer.index(c)] for c in keep]
    if len(numbers) <= CHAINED_BLOCKS:
        df = scanned(plain, own, numbers)
    else:
        rows = written(plain.withColumn("_row", F.monotonically_increasing_id()), "documents")
        passes = [numbers[k : k + CHAINED_BLOCKS] for k in range(0, len(numbers), CHAINED_BLOCKS)]
        hits = None
        for at in passes[1:]:
            found = written(scanned(rows, ["_row"], at).where(F.size("_items") > 0).drop("_n_words"), "passages")
            hits = found if hits is None else hits.unionByName(found)
        joined = hits.groupBy("_row").agg(F.collect_list("_runs").alias("_more_runs"), F.flatten(F.collect_list("_items")).alias("_more_items"))
        df = scanned(rows, [*own, "_row"], passes[0]).join(joined, "_row", "left")
        runs = F.when(F.col("_more_runs").isNull(), F.col("_runs")).otherwise(_merged(F.concat(F.array("_runs"), "_more_runs")))
        df = df.withColumn("_runs", runs).withColumn("_items", F.array_distinct(F.concat("_items", F.coalesce("_more_items", F.array().cast("array<string>")))))
    return df.select(
        *(F.col(c).alias(outer[inner.index(c)]) for c in own),
        F.col("_n_words").alias("n_words"),
        _n_hit("_runs").alias("n_hit"),
        F.array_sort("_items").alias("items"),
        F.col("_runs").alias("hit_runs"),
        (F.size("_items") > 0).alias("contaminated"),
    )


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _merged(lists: pd.Series) -> pd.Series:
    """Runs of several passes as one list of runs; only rows that more than one pass hit get here."""
    out = []
    for several in lists:
        runs = np.zeros(0, np.int32)
        for more in several if several is not None else ():
            runs = _merge_runs(runs, np.asarray(more, np.int32))
        out.append(runs)
    return pd.Series(out)


def _scanner(tables: list, text: str, keep: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches: list[WindowSearch] = [t.value for t in tables]
        for batch in batches:
            counts, runs, items = [np.zeros(0, np.int64)], [], []
            for _, _, raw, bounds in chunked(batch.column(text)):
                n, r, found = searches[0].scan(raw, bounds)
                for search in searches[1:]:
                    _, more_runs, more = search.scan(raw, bounds)
                    r = [_merge_runs(x, y) for x, y in zip(r, more_runs, strict=True)]
                    found = [x | y for x, y in zip(found, more, strict=True)]
                counts.append(n)
                runs += r
                items += found
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            columns = [batch.column(c) for c in keep]
            columns.append(pa.array(np.concatenate(counts), pa.int64()))
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *runs]), pa.int32())))
            columns.append(pa.array([sorted(x) for x in items], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(columns, [*keep, *_FOUND])

    return scan


def items_digest(items: str = "items") -> Column:
    return F.sha2(F.array_join(F.col(items), ","), 256)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    plain = [f"_c{i}" for i in range(len(documents.columns))]
    renamed = documents.toDF(*plain)
    found = find_passages(renamed, benchmark, text=plain[documents.columns.index(text)])
    return found.where(~F.col("contaminated")).select(*plain).toDF(*documents.columns)
