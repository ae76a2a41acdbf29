"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint bit is one where it is one in over half of a text's shingle hashes.
Equal fingerprints are one node from the start, so exact copies cost nothing
further. For distinct fingerprints, correlated bits are grouped into partitions,
and each partition i gets a threshold t_i by dynamic programming over estimated
candidate counts, such that the sum of (t_i + 1) is the distance + 1: two
fingerprints within the distance then agree up to t_i bits in some partition. A
partition with threshold t is probed by all ways to leave out t of its bits, so
that every probe is an equality of masked bits; t = -1 leaves a partition out.

Fingerprints that share a masked value are compared in one task, if they are at
most BUCKET. Larger buckets are split: their other bits are cut in parts (one more
than the distance), one of which any linked pair must share, until the buckets
fit or so few free bits remain that they must. Nothing is capped. A
bucket gives a spanning forest of its links, not all pairs, and the forests are
joined by connected components.

Defined results: null, empty and wordless texts have fingerprint zero and are
linked like others; null ids are ignored for a component's smallest id; repeated
rows come out as often as they went in; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import chunked, small_batches, small_table
from concord.operators.components import connected_components
from concord.session import written

BITS = 64
SHINGLE_WORDS = 3
DISTANCE = 3
SEED = 42
#: Distinct fingerprints that one task compares with each other.
BUCKET = 2048
_ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(data: bytes, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of the word shingles of a text; bytes.split() splits at exactly 0x20 and 0x09-0x0D."""
    found = data.translate(_ASCII_LOWER).split()
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return [digest(b" ".join(found), SEED)] if found else []
    text = b" ".join(found)
    length = np.fromiter(map(len, found), np.int64, len(found))
    end = np.cumsum(length + 1) - 1
    start = end - length
    return [digest(text[a:b], SEED) for a, b in zip(start[: 1 - words].tolist(), end[words - 1 :].tolist(), strict=True)]


def fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint of one text's shingle hashes, repeats included."""
    ones = np.zeros(BITS, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[low : low + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(raw: np.ndarray, bounds: np.ndarray, words: int = SHINGLE_WORDS) -> np.ndarray:
    data = raw.tobytes()
    hashes: list[int] = []
    sizes = np.zeros(len(bounds) - 1, np.int64)
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        found = shingle_hashes(data[a:b], words)
        hashes += found
        sizes[k] = len(found)
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        h = np.array(hashes, np.uint64)
        at = (np.cumsum(sizes) - sizes)[full]
        for byte in range(8):
            part = (h >> np.uint64(8 * byte)).astype(np.uint8)
            bits = np.unpackbits(part[:, None], axis=1, bitorder="little").astype(np.int32)
            ones = np.add.reduceat(bits, at, axis=0)
            value = np.packbits(2 * ones > sizes[full][:, None], axis=1, bitorder="little")[:, 0]
            out[full] |= value.astype(np.uint64) << np.uint64(8 * byte)
    return out


def with_fingerprints(documents: DataFrame, text: str = "text", keep: list[str] | None = None, words: int = SHINGLE_WORDS) -> DataFrame:
    """The columns ``keep`` (all by default) and fp, the fingerprint as a signed 64-bit number."""
    small_batches(documents.sparkSession)
    keep = list(documents.columns) if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [fingerprints(raw, bounds, words) for _, _, raw, bounds in chunked(batch.column(text))]
            values = np.concatenate(fp).view(np.int64) if fp else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(values)], [*keep, "fp"])

    schema = T.StructType([*(documents.schema[c] for c in keep), T.StructField("fp", T.LongType())])
    return documents.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


# --- the plan of partitions and thresholds ---------------------------------


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bit_agreement(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits that are one together, over all of them."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS)), 0
        for frame in frames:
            v = frame["fp"].to_numpy(np.int64).view(np.uint64)
            bits = np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(v)
        yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1), "n": np.append(total.ravel(), n).astype(np.int64)})

    rows = fps.select("fp").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in rows:
        flat[r["cell"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal width, the most correlated ones together."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, groups = set(range(BITS)), []
    for g in range(parts):
        width = len(left) // (parts - g)
        rest = sorted(left)
        seed = max(rest, key=lambda b: (correlation[b, rest].sum(), -b))
        group = [seed]
        left.discard(seed)
        while len(group) < width:
            rest = sorted(left)
            best = rest[int(np.argmax(correlation[np.ix_(group, rest)].sum(axis=0)))]
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def estimated_candidates(n: int, same_pairs: float, agree: np.ndarray, t: int) -> float:
    """Pairs within t bits in a partition: the exact number of equal pairs, widened as for independent bits."""
    distance = np.zeros(t + 1)
    distance[0] = 1.0
    for a in agree:
        distance[1:] = distance[1:] * a + distance[:-1] * (1 - a)
        distance[0] *= a
    grown = distance.sum() / max(distance[0], 1e-300)
    return min(n * (n - 1) / 2, max(same_pairs, n * (n - 1) / 2 * distance[0]) * grown)


def allocate(costs: list[list[float]], budget: int) -> list[int]:
    """Thresholds of least total cost; costs[i][t + 1] is partition i's cost at threshold t, and the t + 1 sum up to ``budget``."""
    best = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for extra in range(min(len(cost) - 1, budget - spent) + 1):
                if spent + extra not in step or total + cost[extra] < step[spent + extra][0]:
                    step[spent + extra] = (total + cost[extra], [*chosen, extra - 1])
        best = step
    return best[budget][1]


def plan_probes(fps: DataFrame, distance: int = DISTANCE) -> list[int]:
    """Masks such that fingerprints within ``distance`` bits agree in all bits of at least one mask."""
    n, together = bit_agreement(fps)
    p = np.diag(together) / max(n, 1)
    agree = p * p + (1 - p) * (1 - p)
    layouts = {m: group_bits(n, together, m) for m in range(2, distance + 2)}
    groups = [(m, i, g) for m, layout in layouts.items() for i, g in enumerate(layout)]
    # exact equal pairs of every partition of every layout, in one pass over all fingerprints
    keys = F.explode(F.array(*(F.struct(F.lit(k).alias("g"), F.col("fp").bitwiseAND(F.lit(_signed(_mask(g)))).alias("v")) for k, (_, _, g) in enumerate(groups))))
    counted = fps.select(keys.alias("x")).groupBy("x.g", "x.v").count().groupBy("g").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs"))
    pairs = {r["g"]: float(r["pairs"]) for r in counted.collect()}
    best: tuple[float, list[int]] | None = None
    for m, layout in layouts.items():
        costs = []
        for k, (mm, _, g) in enumerate(groups):
            if mm == m:
                # a probe row costs about as much as 20 comparisons
                costs.append([0.0] + [estimated_candidates(n, pairs.get(k, 0.0), agree[g], t) + 20.0 * n * comb(len(g), t) for t in range(distance + 1)])
        thresholds = allocate(costs, distance + 1)
        total = sum(c[t + 1] for c, t in zip(costs, thresholds, strict=True))
        masks = [_mask([b for b in g if b not in out]) for g, t in zip(layout, thresholds, strict=True) if t >= 0 for out in combinations(g, t)]
        if best is None or total < best[0]:
            best = (total, masks)
    assert best is not None
    return best[1]


def split_mask(mask: int, distance: int = DISTANCE) -> list[int]:
    """Larger masks for a bucket: its free bits in distance + 1 parts, one of which a linked pair shares."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | _mask(free[i :: distance + 1]) for i in range(distance + 1)]


# --- probing and verification ------------------------------------------------


def linked_forest(fp: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Edges (indices) of a spanning forest of the links among distinct fingerprints."""
    edges: list[tuple[int, int]] = []
    left = np.arange(len(fp))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[at]) <= distance
            if near.any():
                new = left[near].tolist()
                edges += [(at, x) for x in new]
                queue += new
                left = left[~near]
    return edges


def _verify(frames: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by (mask, value): compares the fingerprints of each run; runs may cross batches."""
    held: pd.DataFrame | None = None

    def edges(frame: pd.DataFrame) -> pd.DataFrame:
        mask, value = frame["mask"].to_numpy(), frame["value"].to_numpy()
        fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
        new = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]))
        size = np.diff(np.append(new, len(fp)))
        a, b = [], []
        small = size <= 8
        run = np.repeat(np.arange(len(size)), size)
        for step in range(1, 8):
            i = np.flatnonzero((run[step:] == run[:-step]) & small[run[step:]])
            if not len(i):
                break
            i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= distance]
            a.append(fp[i])
            b.append(fp[i + step])
        for r in np.flatnonzero(~small):
            part = fp[new[r] : new[r] + size[r]]
            pairs = linked_forest(part, distance)
            if pairs:
                ends = np.array(pairs)
                a.append(part[ends[:, 0]])
                b.append(part[ends[:, 1]])
        none = np.zeros(0, np.uint64)
        out = pd.DataFrame({"a": np.concatenate([none, *a]).view(np.int64), "b": np.concatenate([none, *b]).view(np.int64)})
        return out.drop_duplicates()

    for frame in frames:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if not len(frame):
            continue
        last = frame.iloc[-1]
        same = ((frame["mask"] == last["mask"]) & (frame["value"] == last["value"])).to_numpy()
        cut = int(np.argmax(same))
        held = frame.iloc[cut:]
        if cut:
            yield edges(frame.iloc[:cut])
    if held is not None and len(held):
        yield edges(held)


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, masks: list[int] | None = None) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints (column fp) exactly as all links do."""
    spark = fps.sparkSession
    masks = plan_probes(fps, distance) if masks is None else masks
    probes = F.explode(F.array(*(F.lit(_signed(m)) for m in masks)))
    rows = fps.select("fp", probes.alias("mask")).withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found: list[DataFrame] = []
    while True:
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("size")).where("size > 1")
        sized = written(rows.join(sizes, ["mask", "value"]), "probes")
        fit = sized.where(F.col("size") <= bucket).select("mask", "value", "fp").repartition(n, "mask", "value").sortWithinPartitions("mask", "value")
        found.append(fit.mapInPandas(lambda frames: _verify(frames, distance), "a long, b long"))
        large = sized.where(F.col("size") > bucket)
        # as many masks as were probed at most, not as many as rows
        crowded = [r["mask"] % (1 << 64) for r in large.select("mask").distinct().collect()]
        if not crowded:
            break
        cut = [(_signed(m), _signed(x)) for m in crowded for x in split_mask(m, distance)]
        smaller = small_table(spark, mask=pa.array([m for m, _ in cut], pa.int64()), smaller=pa.array([x for _, x in cut], pa.int64()))
        rows = large.join(F.broadcast(smaller), "mask").select("fp", F.col("smaller").alias("mask"), F.col("fp").bitwiseAND(F.col("smaller")).alias("value")).distinct()
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


def near_duplicate_groups(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, distance: int = DISTANCE, words: int = SHINGLE_WORDS) -> DataFrame:
    """The columns ``keep`` (the id by default) with fingerprint (16 hex digits) and component_id."""
    keep = [doc_id] if keep is None else keep
    rows = written(with_fingerprints(documents, text, list(dict.fromkeys([*keep, doc_id])), words), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min(doc_id).alias("least")), "nodes")
    component = connected_components(links(nodes.select("fp"), distance))
    joined = nodes.join(component, F.col("fp") == F.col("node"), "left").withColumn("component", F.coalesce("component", "fp"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = joined.select("fp", "component").join(least, "component").select("fp", "component_id")
    return rows.join(labelled, "fp").select(*keep, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Exactly one row of each group of linked fingerprints, with its own columns: one with the group's smallest id (nulls last)."""
    plain = [f"_c{i}" for i in range(len(documents.columns))]
    key, body = (plain[documents.columns.index(c)] for c in (doc_id, text))
    numbered = documents.toDF(*plain).withColumn("_row", F.monotonically_increasing_id())
    # the row number is written with its row, so that it stays the same
    rows = written(with_fingerprints(numbered, body, [*plain, "_row"], words), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min(F.struct(F.col(key).isNull().alias("nameless"), F.col(key).alias("id"), F.col("_row").alias("row"))).alias("first")), "nodes")
    component = connected_components(links(nodes.select("fp"), distance))
    stay = nodes.join(component, F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("component", "fp").alias("group")).agg(F.min("first").alias("first"))
    return rows.join(stay.select(F.col("first.row").alias("_row")), "_row", "left_semi").select(*plain).toDF(*documents.columns)
