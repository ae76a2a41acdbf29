"""Phrase collocation mining: Misra-Gries summaries per hash partition, then exact counts of the survivors.

Pass one hashes every phrase of one to five words with its language. Tasks send
summaries (distinct hashes with counts) of some million occurrences each, cut by
the leading bits of the hash into partitions. A partition's summaries are merged
into one of a capacity above its mass divided by the threshold: whenever more
hashes are held, all counters lose what the first one beyond the capacity has. A
loss of c takes c from more than mass / threshold counters, so all losses are under
the threshold and every phrase that occurs as often as the threshold keeps a
counter. Hashes whose counter could reach it with the losses added are marked in a
bit table of a fixed size.

Pass two counts the phrases whose bits are set by their words, not their hashes:
tasks send tables of counts by partition, which are merged; phrases below the
threshold go. Parts of a frequent phrase are
as frequent, so the table has the counts of every cut's two parts.

Defined results: null texts have no words; a null language is ``und``; rows that
repeat an id count as often as they stand there; ties go to the smallest cut and
then by score, count and phrase; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import chunked, find_words, ragged, small_batches, word_hashes
from concord.session import written

THRESHOLD, LONGEST, FIRST = 100, 5, 2000
UNKNOWN = "und"
#: Occurrences that a task summarises at once, and counters that a merge holds besides its capacity.
MAPPED, PENDING = 1 << 22, 1 << 20
#: Bytes of text whose phrases make about one hash partition, and leading bits of the hash that partitions take at most.
PARTITION_BYTES, PART_BITS = 16 << 20, 17
#: Bits of the table of survivors at most (16 MB, which the driver holds and broadcasts).
TABLE_BITS = 27
#: Rows of counts that a task of pass two holds before it sends them, as tables by partition.
HELD = 1 << 18

_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(10, 14)]] = True
_INSIDE = ~_BREAKS
_INSIDE[[9, 32]] = False
_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


class MisraGries:
    """Counters of frequent items; each is too low by at most ``error``."""

    def __init__(self, capacity: int, pending: int = PENDING) -> None:
        self.capacity, self.pending, self.error = capacity, pending, 0
        self.items, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._n = 0

    def add(self, items: np.ndarray, counts: np.ndarray) -> None:
        """Merge another summary, given as distinct items and counts."""
        self._new.append((items, counts))
        self._n += len(items)
        if self._n >= self.pending:
            self.settle()

    def settle(self) -> None:
        items = np.concatenate([self.items, *(i for i, _ in self._new)])
        counts = np.concatenate([self.counts, *(c for _, c in self._new)]).astype(np.int64)
        self._new, self._n = [], 0
        order = np.argsort(items)
        items, counts = items[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else np.zeros(0, np.int64)
        items, counts = items[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(items) > self.capacity:
            at = len(items) - self.capacity - 1
            loss = int(np.partition(counts, at)[at])
            self.error += loss
            stay = counts > loss
            items, counts = items[stay], counts[stay] - loss
        self.items, self.counts = items, counts


def pack(numbers: np.ndarray) -> bytes:
    """Byte planes of unsigned numbers, compressed: sorted hashes as differences, and small counts, take few bytes."""
    return zstandard.compress(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


class Phrases:
    """The words of a run of texts and the hashes of the phrases that start at each."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, seeds: np.ndarray) -> None:
        self.low, self.starts, self.ends, first = find_words(raw, bounds, _INSIDE)
        self.row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
        breaks = np.cumsum(_BREAKS[self.low], dtype=np.int64)
        n = len(self.starts)
        piece = breaks[self.starts] if n else np.zeros(0, np.int64)
        new = np.ones(n + 1, bool)
        new[1:-1] = (piece[1:] != piece[:-1]) | (self.row[1:] != self.row[:-1])
        edges = np.flatnonzero(new)
        #: The word after the last one of each word's piece.
        self.stop = np.repeat(edges[1:], np.diff(edges))
        self.words = word_hashes(self.low, self.starts, self.ends)
        self.seeds = seeds

    def hashes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length the words at which a phrase starts, and the phrases' hashes."""
        at = np.arange(len(self.words))
        h = _mixed(self.words + self.seeds[self.row])
        yield 1, at, h
        for n in range(2, LONGEST + 1):
            fits = at + n <= self.stop[at]
            at, h = at[fits], h[fits]
            h = _mixed(h * _STEP + self.words[at + n - 1])
            yield n, at, h

    def word_ids(self) -> np.ndarray:
        """A number for every word, equal for equal words only."""
        _, first, ids = np.unique(self.words, return_index=True, return_inverse=True)
        lengths, same = self.ends - self.starts, first[ids]
        if np.array_equal(lengths, lengths[same]) and np.array_equal(self.low[ragged(self.starts, lengths)], self.low[ragged(self.starts[same], lengths)]):
            return ids
        seen: dict[bytes, int] = {}  # two words with one hash
        return np.array([seen.setdefault(self.low[a:b].tobytes(), len(seen)) for a, b in zip(self.starts, self.ends, strict=True)])

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """The words with one space after each, and where they start (one entry more)."""
        lengths = self.ends - self.starts
        at = np.concatenate([[0], np.cumsum(lengths + 1)])
        out = np.full(at[-1], 32, np.uint8)
        out[ragged(at[:-1], lengths)] = self.low[ragged(self.starts, lengths)]
        return out, at


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 7)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Phrases, list[str], np.ndarray]]:
    """Phrases of runs of texts, with the run's languages and the number of each row's."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        seeds = np.array([_seed(x) for x in names], np.uint64)
        for low, high, raw, bounds in chunked(batch.column("text")):
            yield Phrases(raw, bounds, seeds[codes[low:high]]), names, codes[low:high]


def _summaries(documents: DataFrame, bits: int, part_bits: int) -> DataFrame:
    """(part, mass, items, counts): summaries by partition; the rows with a mass come before those with counters when sorted by ``kind``."""
    shift, inner = np.uint64(64 - bits), np.uint64(bits - part_bits)

    def send(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate(held)
        held.clear()
        hashes.sort()
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        items, counts = hashes[first], np.diff(np.append(first, len(hashes)))
        parts, begins = np.unique(items >> inner, return_index=True)
        rows: list[list] = [[], [], [], [], []]
        for part, a, b in zip(parts.tolist(), begins.tolist(), [*begins[1:].tolist(), len(items)], strict=True):
            for values in ((part, 0, int(counts[a:b].sum()), None, None), (part, 1, 0, pack(np.diff(items[a:b], prepend=np.uint64(part) << inner)), pack(counts[a:b]))):
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["part", "kind", "mass", "items", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for phrases, _, _ in _runs(batches):
            for _, _, h in phrases.hashes():
                held.append(h >> shift)
                n += len(h)
            if n >= MAPPED:
                yield from send(held)
                n = 0
        if n:
            yield from send(held)

    return documents.mapInArrow(run, "part int, kind int, mass long, items binary, counts binary")


def _survivors(summaries: DataFrame, bits: int, part_bits: int, table_bits: int, threshold: int) -> DataFrame:
    """(part, survivors, marks): a partition's slice of the bit table, compressed."""
    inner, coarse = np.uint64(bits - part_bits), np.uint64(bits - table_bits)
    slice_bits = table_bits - part_bits

    def close(part: int, summary: MisraGries) -> pa.RecordBatch:
        summary.settle()
        alive = summary.items[summary.counts + summary.error >= threshold]
        marks = np.zeros(1 << slice_bits, bool)
        marks[((alive & ((np.uint64(1) << inner) - np.uint64(1))) >> coarse).astype(np.int64)] = True
        marked = zstandard.compress(np.packbits(marks, bitorder="little").tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(alive)], pa.int64()), pa.array([marked], pa.binary())], ["part", "survivors", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None
        for batch in batches:
            for r in range(len(batch)):
                p, kind, m, items, counts = (batch.column(c)[r].as_py() for c in ("part", "kind", "mass", "items", "counts"))
                if p != part:
                    if summary:
                        yield close(part, summary)
                    part, mass, summary = p, 0, None
                if kind == 0:
                    mass += m
                    continue
                summary = summary or MisraGries(mass // threshold + 1)
                summary.add(np.cumsum(unpack(items), dtype=np.uint64) + (np.uint64(part) << inner), unpack(counts).astype(np.int64))
        if summary:
            yield close(part, summary)

    dealt = summaries.repartitionById(1 << part_bits, "part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(run, "part int, survivors long, marks binary")


def _total(parts: list[pa.Table]) -> pa.Table:
    keys = ["part", "lang", "words", "phrase"]
    return pa.concat_tables([p.select([*keys, "f"]) for p in parts]).group_by(keys, use_threads=False).aggregate([("f", "sum")]).rename_columns([*keys, "f"])


def _sent(counts: pa.Table) -> pa.RecordBatch:
    """A row for each partition: its counts as a compressed table."""
    counts = counts.sort_by("part")
    parts, begins = np.unique(counts["part"].to_numpy(), return_index=True)
    rows = []
    for a, b in zip(begins.tolist(), np.append(begins[1:], len(counts))[: len(begins)].tolist(), strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, counts.schema.remove(0), options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(counts.slice(a, b - a).drop_columns(["part"]))
        rows.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int32)), pa.array(rows, pa.binary())], ["part", "data"])


def phrase_counts(documents: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD) -> DataFrame:
    """(lang, words, phrase, f): all phrases of one to five words that occur ``threshold`` times or more, and words 0 with the number of all words."""
    spark = documents.sparkSession
    small_batches(spark)
    given = documents.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    octets = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # hashes so wide that few phrases share one by chance; partitions by bytes, a power of two
    bits = min(62, max(32, int(octets).bit_length() + 10))
    table_bits = min(TABLE_BITS, bits)
    part_bits = min(PART_BITS, max(3, int(octets // PARTITION_BYTES).bit_length()))
    slices = _survivors(_summaries(given, bits, part_bits), bits, part_bits, table_bits, threshold)
    marks = np.zeros(1 << table_bits >> 3, np.uint8)
    width = len(marks) >> part_bits
    for row in slices.select("part", "marks").collect():
        marks[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(zstandard.decompress(row["marks"]), np.uint8)
    table = spark.sparkContext.broadcast(zstandard.compress(marks.tobytes(), 1))
    shift = np.uint64(64 - table_bits)

    def counted(phrases: Phrases, names: list[str], codes: np.ndarray, marked: np.ndarray) -> Iterator[pa.Table]:
        text_of, at_of = phrases.joined()
        ids = phrases.word_ids()
        everywhere = np.bincount(codes[phrases.row], minlength=len(names))
        present = np.flatnonzero(everywhere)
        yield pa.table({"part": pa.array(np.zeros(len(present), np.int32)), "lang": pa.array([names[i] for i in present], pa.string()), "words": pa.array(np.zeros(len(present), np.int32)), "phrase": pa.array([""] * len(present), pa.string()), "f": pa.array(everywhere[present])})
        group = codes[phrases.row].astype(np.int64)  # of phrases that are equal in language and all words so far
        alive = np.ones(len(ids), bool)
        width = int(ids.max()) + 1 if len(ids) else 1
        for n, at, h in phrases.hashes():
            slot = (h >> shift).astype(np.int64)
            # what begins with a rare phrase is rare
            stay = alive[at] & ((marked[slot >> 3] >> (slot & 7).astype(np.uint8) & 1) > 0)
            at, slot = at[stay], slot[stay]
            alive = np.zeros(len(ids), bool)
            if not len(at):
                return
            alive[at] = True
            _, first, inverse, f = np.unique(group[at] * width + ids[at + n - 1], return_index=True, return_inverse=True, return_counts=True)
            group[at] = inverse
            rep = at[first]
            low, high = at_of[rep], at_of[rep + n] - 1
            flat = text_of[ragged(low, high - low)].tobytes()
            offsets = np.concatenate([[0], np.cumsum(high - low)]).astype(np.int64)
            phrase = pa.Array.from_buffers(pa.large_string(), len(rep), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat)]).cast(pa.string())
            langs = pa.DictionaryArray.from_arrays(pa.array(codes[phrases.row[rep]].astype(np.int32)), pa.array(names, pa.string())).cast(pa.string())
            yield pa.table({"part": pa.array((slot[first] >> (table_bits - part_bits)).astype(np.int32)), "lang": langs, "words": pa.array(np.full(len(rep), n, np.int32)), "phrase": phrase, "f": pa.array(f.astype(np.int64))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(zstandard.decompress(table.value), np.uint8)
        held: list[pa.Table] = []
        n = settled = 0
        for phrases, names, codes in _runs(batches):
            for part in counted(phrases, names, codes, marked):
                held.append(part)
                n += len(part)
            if n - settled >= HELD:
                held = [_total(held)]
                n = settled = len(held[0])
                if settled >= HELD:
                    yield _sent(held[0])
                    held, n, settled = [], 0, 0
        if held:
            yield _sent(_total(held))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        n = settled = 0
        for batch in batches:
            for part, data in zip(batch.column("part"), batch.column("data"), strict=True):
                table = pa.ipc.open_stream(data.as_buffer()).read_all()
                held.append(table.append_column("part", pa.repeat(part, len(table))))
                n += len(table)
                if n - settled >= max(HELD, settled):
                    held = [_total(held)]
                    n = settled = len(held[0])
        if held:
            counts = _total(held)
            stay = pc.or_(pc.greater_equal(counts["f"], threshold), pc.equal(counts["words"], 0))
            yield from counts.filter(stay).select(["lang", "words", "phrase", "f"]).to_batches(1 << 16)

    parts = given.mapInArrow(run, "part int, data binary")
    return parts.repartitionById(1 << part_bits, "part").mapInArrow(merge, "lang string, words int, phrase string, f long")


def collocations(documents: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of each language whose parts attract each other most."""
    counts = written(phrase_counts(documents, text, lang, threshold), "phrases")
    phrases = counts.where("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"))
    # f of a longer phrase is at most that of the phrases within, so one word more at a time finds all that contain one as often
    shorter = F.expr("explode(array(substring_index(phrase, ' ', words - 1), substring_index(phrase, ' ', 1 - words)))").alias("phrase")
    inside = phrases.where("words >= 3").select("lang", shorter, "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    apart = phrases.join(inside, ["lang", "phrase"], "left").where("longer is null or longer < a").select("lang", "words", "phrase", "a")
    at_each = apart.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = at_each.select("lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - words)").alias("right"))
    parts = counts.where("words >= 1")
    sized = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # decimals of 38 digits hold the products; the quotient is at most 1000 n / threshold
    score = F.expr("cast(1000 as decimal(4,0)) * cast(cast(a as decimal(16,0)) * cast(n as decimal(18,0)) as decimal(34,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    scored = sized.join(counts.where("words = 0").select("lang", F.col("f").alias("n")), "lang").withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("cut.a"), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")
