"""Best-fit packing of tokenised documents with certified partitions.

Documents become token sequences (ids, then one end id). A document longer than
the capacity is cut into pieces of exactly the capacity, except the first piece,
which takes the remainder. Pieces are dealt at random into partitions of a
bounded number of rows; each partition is packed by best-fit decreasing and
certified when its number of bins equals a lower bound from dual-feasible
functions over its lengths. Afterwards the documents in bins that are not full
of uncertified partitions, and in the loosest bin of each certified one, are
exchanged: dealt anew among fewer partitions and packed again. An exchange counts only
if it saves bins, and the loop ends when it saves none or nothing is left open, after
as many exchanges as that takes.

Every partition holds about PARTITION_ROWS rows whatever the input, so more
documents mean more partitions, not larger ones. The driver sees four numbers a
round.

Defined results: null and empty texts are the end id alone; repeated rows are
packed each by itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import small_batches, text_runs
from concord.llm.tokens import PieceTable, piece_table
from concord.session import written

CAPACITY = 2048
END_ID = 0
PARTITION_ROWS = 20_000


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``length`` ids."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = ([0] if first else []) + list(range(first, length, capacity))
    return [(s, (first if s == 0 and first else capacity)) for s in starts]


def pieces_of(documents: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids (little-endian uint32)."""
    small_batches(documents.sparkSession)
    end = int(end_id).to_bytes(4, "little")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(PieceTable, tokenizer_path)
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, values in enumerate(v for texts in text_runs(batch.column(1)) for v in table.values(texts)):
                data = b"".join(values) + end
                for p, (s, n) in enumerate(cut(len(data) // 4, capacity)):
                    part = data[4 * s : 4 * (s + n)]
                    row.append(k)
                    piece.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([T.StructField("doc_id", documents.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema = schema.add("ids", T.BinaryType())
    return documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(tokenise, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; longest first, each into the fullest bin that takes it."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, made = 0, 0  # bit s: some bin has s ids of space left
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = spaces >> need
        if fitting:
            space = need + (fitting & -fitting).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            b, space = made, capacity
            made += 1
        bins[i], offsets[i] = b, capacity - space
        if left := space - need:
            by_space[left].append(b)
            spaces |= 1 << left
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions over the lengths.

    The first counts lengths above capacity - k as whole bins and drops those below
    k; the second rounds to multiples of 1/k (exact multiples of capacity/(k+1) keep
    their share).
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // capacity)
    many, total = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * x)])
    k = np.arange(1, capacity // 2 + 1)
    whole = many[capacity + 1] - many[capacity - k + 1]
    middle = total[capacity - k + 1] - total[k]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    for k in range(1, 101):
        scaled = (k + 1) * x
        share = np.where(scaled % capacity == 0, k * x, scaled // capacity * capacity)
        best = max(best, -(-int((count * share).sum()) // (k * capacity)))
    return best


_PACKED = "key long, length long, part long, bin long, offset long, fill long, bins long, bound long"


def _pack_partitions(rows: DataFrame, capacity: int) -> DataFrame:
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "key"], ignore_index=True)
        lengths = group["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        return group.assign(bin=bins, offset=offsets, fill=fill, bins=int(bins.max()) + 1, bound=lower_bound(lengths, capacity))[["key", "length", "part", "bin", "offset", "fill", "bins", "bound"]]

    return rows.groupBy("part").applyInPandas(pack, _PACKED)


def pack(pieces: DataFrame, capacity: int = CAPACITY, partition_rows: int = PARTITION_ROWS, seed: int = 11) -> DataFrame:
    """``pieces`` (with a column length) with sequence_id and offset."""
    keyed = written(pieces.withColumn("_key", F.monotonically_increasing_id()), "pieces")
    rows, total = keyed.select(F.col("_key").alias("key"), "length"), keyed.count()
    closed: list[DataFrame] = []

    def deal(open_rows: DataFrame, n: int, turn: int) -> tuple[DataFrame, int]:
        parts = max(1, -(-n // partition_rows))
        return written(_pack_partitions(open_rows.withColumn("part", F.pmod(F.xxhash64("key", F.lit(seed + turn)), F.lit(parts))), capacity), f"packed{turn}"), parts

    def close(done: DataFrame, first: int) -> None:
        # partitions are numbered on over all exchanges
        closed.append(done.select("key", (F.shiftleft(F.col("part") + F.lit(first), 24) + F.col("bin")).alias("sequence_id"), "offset"))

    (packed, dealt), turn, first = deal(rows, total, 0), 0, 0
    while True:
        # open: the bins that are not full of partitions with a gap, and the loosest bin of the certified ones
        loosest = packed.groupBy("part").agg(F.min_by("bin", F.struct("fill", "bin")).alias("loosest"))
        tagged = packed.join(loosest, "part").withColumn("open", (F.col("fill") < capacity) & ((F.col("bins") > F.col("bound")) | (F.col("bin") == F.col("loosest"))))
        n, bins, parts = tagged.where("open").agg(F.count("*"), F.count_distinct("part", "bin"), F.count_distinct("part")).first()
        if bins < 2 or (parts == 1 and turn):
            close(packed, first)
            break
        again, dealt_again = deal(tagged.where("open").select("key", "length"), n, turn + 1)
        if again.agg(F.count_distinct("part", "bin")).first()[0] >= bins:
            close(packed, first)
            break
        close(tagged.where("not open"), first)
        packed, turn, first, dealt = again, turn + 1, first + dealt, dealt_again
    where = closed[0]
    for more in closed[1:]:
        where = where.unionByName(more)
    return keyed.join(where.withColumnRenamed("key", "_key"), "_key").drop("_key")


def pack_documents(documents: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of every piece of every document."""
    return pack(pieces_of(documents, tokenizer_path, doc_id, text, capacity, end_id, with_ids), capacity)
