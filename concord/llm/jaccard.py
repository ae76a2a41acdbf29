"""Near duplicates by the Jaccard similarity of their sets of five-word shingles.

Two texts are linked if their sets' exact Jaccard similarity is at least 0.8.
Texts with the same set are one node from the start. SimHash links come first: the
fingerprints of the five-word shingles that differ in few bits are found by the
generalised pigeonhole principle (``concord.llm.simhash``), and a link counts if
the two whole sets confirm it. A fingerprint's distance does not follow from the
similarity, so links that no radius holds come from the sets themselves: all order
their shingles alike, rare ones first, and two sets of the similarity share one of
the first fifth of each. These keys lose no link; nodes that SimHash linked already
are not compared again, and keys that many nodes share are not turned into all of
their pairs (``concord.operators.similar``). A set's size and a sketch of
parity bits, as many as the set has shingles at least, tell beforehand which candidates
cannot reach the similarity, exactly.

Which shingles are rare is told by counts, over all texts, of CELLS cells that they
are hashed to. Any order is exact; this one keeps common passages out of the keys.

Defined results: null, empty and wordless texts have the empty set and are linked
with each other; a text of fewer than five words has one shingle, all of its words.
A table without the id's or the text's column raises a ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import chunked, small_batches
from concord.llm.simhash import DISTANCE, SEED, fingerprint, links, shingle_hashes
from concord.operators.similar import groups_of_pairs, linked_groups
from concord.session import written

SHINGLE_WORDS = 5
#: Least Jaccard similarity of linked texts, as a fraction.
SIMILAR = (4, 5)
#: Least bits of a sketch, 64 a long.
SKETCH = 64
#: Cells in which shingles are counted, and pieces that a task's counts are sent in.
CELLS, PIECES = 1 << 18, 64


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set's first shingles by their cells' counts, of which two sets of the least similarity share one."""
    up, down = SIMILAR
    n = len(shingles)
    order = np.lexsort((shingles, counts[(shingles % np.uint64(CELLS)).astype(np.int64)]))
    # what is shared is at least up / down of either set
    return shingles[order[: n + up * n // -down + 1]] if n else shingles


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity of the shingles in each of so many cells: the power of two that is at least their number."""
    n = max(SKETCH, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else SKETCH
    cells = np.bincount((shingles % np.uint64(n)).astype(np.int64), minlength=n)
    return np.packbits(cells & 1, bitorder="little").view(np.uint64)


def _described(hashes: np.ndarray, shingles: np.ndarray) -> list[int]:
    """Fingerprint, size and sketch in one array."""
    return [fingerprint(hashes), len(shingles), *sketch(shingles).tolist()]


def _hashes(column: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, end row, each row's shingle hashes with repeats) of runs of rows."""
    for low, high, raw, bounds in chunked(column):
        data = raw.tobytes()
        yield low, high, [np.array(shingle_hashes(data[a:b], SHINGLE_WORDS), np.uint64) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _sets(documents: DataFrame, text: str, keep: list[str], name: str, of) -> DataFrame:
    """The columns ``keep``, the set's digest (node) and ``of`` each text's hashes and set."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, hashed in _hashes(batch.column(text)):
                nodes, values = [], []
                for hashes in hashed:
                    shingles = np.unique(hashes)
                    nodes.append(xxhash.xxh64_intdigest(shingles.tobytes(), SEED))
                    values.append(np.asarray(of(hashes, shingles), np.uint64))
                part = batch.slice(low, high - low)
                node = pa.array(np.array(nodes, np.uint64).view(np.int64))
                sizes = np.cumsum([0, *map(len, values)])
                flat = np.concatenate(values).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), node, pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat))], [*keep, "node", name])

    schema = T.StructType([*(documents.schema[c] for c in keep), T.StructField("node", T.LongType()), T.StructField(name, _LONGS)])
    return documents.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def cell_counts(documents: DataFrame, text: str = "text") -> np.ndarray:
    """The texts' shingles in each of CELLS cells, over all of them."""
    small_batches(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, _, hashed in _hashes(batch.column(0)):
                total += np.bincount((np.concatenate(hashed) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array([part.tobytes() for part in np.split(total, PIECES)], pa.binary())], ["piece", "counts"])

    def add(piece: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(part, np.int64) for part in piece["counts"])
        return pd.DataFrame({"piece": piece["piece"][:1], "counts": [total.tobytes()]})

    kind = "piece int, counts binary"
    pieces = documents.select(text).mapInArrow(count, kind).groupBy("piece").applyInPandas(add, kind).collect()
    out = np.zeros((PIECES, CELLS // PIECES), np.int64)
    for r in pieces:
        out[r["piece"]] = np.frombuffer(r["counts"], np.int64)
    return out.ravel()


_LONGS = T.ArrayType(T.LongType())


def fingerprint_pairs(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of nodes (node, fp) that connect those whose fingerprints differ in at most ``distance`` bits."""
    least = written(prints.groupBy("fp").agg(F.min("node").alias("node")), "fingerprints")
    between = links(least.select("fp"), distance).join(least.toDF("a", "x"), "a").join(least.toDF("b", "y"), "b").select("x", "y")
    equal = prints.join(least.toDF("fp", "x"), "fp").where("node <> x").select("x", F.col("node").alias("y"))
    return between.unionByName(equal).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def keep_one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", direct: int | None = None, distance: int = DISTANCE) -> DataFrame:
    """Exactly one row of each group of linked texts, with its own columns: one with the group's smallest id (nulls last)."""
    if missing := [c for c in (doc_id, text) if c not in documents.columns]:
        raise ValueError(f"no column {', '.join(missing)}")
    plain = [f"_c{i}" for i in range(len(documents.columns))]
    key, body = (plain[documents.columns.index(c)] for c in (doc_id, text))
    numbered = documents.toDF(*plain).withColumn("_row", F.monotonically_increasing_id())
    # the row number is written with its row, so that it stays the same
    rows = written(_sets(numbered, body, [*plain, "_row"], "about", _described), "shingled")
    first = F.min(F.struct(F.col(key).isNull().alias("nameless"), F.col(key).alias("id"), F.col("_row").alias("row"))).alias("first")
    told = F.struct(F.get("about", F.lit(1)).alias("size"), F.slice("about", F.lit(3), F.size("about") - 2).alias("bits")).alias("sketch")
    # texts of one set may repeat its shingles differently
    heads = written(rows.groupBy("node").agg(F.min("about").alias("about"), first).select("node", F.get("about", F.lit(0)).alias("fp"), told, "first"), "heads")

    def sets_of(wanted: DataFrame) -> DataFrame:
        # written, so that its size is known and the texts are not shuffled for a few rows
        one = written(heads.join(wanted, "node", "left_semi").select(F.col("first.row").alias("_row")), "wanted")
        return _sets(rows.join(one, "_row", "left_semi"), body, [], "shingles", lambda hashes, shingles: shingles)

    near = groups_of_pairs(fingerprint_pairs(heads.select("node", "fp"), distance), heads, sets_of, SIMILAR)
    counts = rows.sparkSession.sparkContext.broadcast(cell_counts(rows, body))
    rarest = _sets(rows, body, ["_row"], "keys", lambda hashes, shingles: prefix(shingles, counts.value))
    # rows that go are fewer than those that stay, so texts meet their numbers: often few enough to be sent to all tasks
    repeats = written(_others(rows, heads), "repeats")
    nodes = written(rarest.join(repeats, "_row", "left_anti").select("node", "keys"), "nodes")
    counts.destroy()
    labels = linked_groups(nodes, sets_of, SIMILAR, direct, heads, near)
    stay = heads.join(labels, "node", "left").groupBy(F.coalesce("group", "node").alias("group")).agg(F.min("first").alias("first"))
    gone = written(_others(rows, stay), "gone")
    return rows.join(gone, "_row", "left_anti").select(*plain).toDF(*documents.columns)


def _others(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """The numbers of the rows that are none of ``firsts``."""
    return rows.select("_row").join(firsts.select(F.col("first.row").alias("_row")), "_row", "left_anti")
