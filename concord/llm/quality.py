"""Quality rules with an isolation forest on their statistics.

One pass over the whole texts gives each document's rule statistics (words,
symbols, repeated lines and repeated five-word windows, and some ratios). An
isolation forest is grown on the good ones (quality 1) of the labelled documents
that pass the base rules: as the method has it, every tree has its own TREE_ROWS
rows, drawn from all of them. Its splits may fall as far outside their values as
all labelled rows spread, so that short path lengths mark statistics that good
documents do not have. The threshold is the lowest score at which no more than
CLEAN_LOSS of all good ones would go; its place in the order is found by counting
the scores by digits, so that no rows are gathered.

Words are runs of other bytes than 0x20 and 0x09-0x0D, which is where
bytes.split() splits. Defined results: null and empty texts have no words and
fail the base rule; with too few labelled rows no document fails by the forest;
repeated rows come out as often as they went in; null label values are unlabelled,
and an id with several labels counts as good only if all of them are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import kept, small_batches, text_runs
from concord.session import written

#: Characters counted as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
TREES, TREE_ROWS = 100, 256
CLEAN_LOSS = 0.002
LEAST_LABELLED = 50
FEATURES = ["word_chars", "symbols", "dup_lines", "repeat", "distinct", "ends"]
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SPACE = b" \t\n\r\x0b\x0c"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window found twice or more in the text, the first find included."""
    windows = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    ids = np.fromiter((first.setdefault(w, len(first)) for w in windows), np.int64, len(windows))
    twice = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts and the forest's features of one text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    chars = len(text) - sum(data.count(b) for b in _SPACE)
    symbols = sum(data.count(b) for b in SYMBOLS.encode())
    lines = [x for x in data.split(b"\n") if x.strip(_SPACE)]
    duplicate = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    each = max(n, 1)
    ends = sum(data.count(b) for b in b".!?")
    features = [chars / each, symbols / each, duplicate / max(len(lines), 1), repeat / each, np.log1p(len(set(words))) - np.log1p(n), ends / each]
    return [n, chars, symbols, duplicate, repeat], features


def with_statistics(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default), the base counts, features and base_failed, which replace columns of these names."""
    small_batches(documents.sparkSession)
    keep = kept(documents, keep, [*_COUNTS, "features", "base_failed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = [], []
            for value in (t for texts in text_runs(batch.column(text)) for t in texts):
                c, f = statistics(value)
                counts.append(c)
                features.append(f)
            columns = np.array(counts, np.int64).reshape(-1, len(_COUNTS))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(columns[:, k]) for k in range(len(_COUNTS))), pa.array(features, pa.list_(pa.float64()))], [*keep, *_COUNTS, "features"])

    schema = T.StructType([*(documents.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in _COUNTS), T.StructField("features", T.ArrayType(T.DoubleType()))])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return documents.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema).withColumn("base_failed", failed)


@dataclass
class IsolationForest:
    """Trees as arrays: a node's feature (-1: leaf), split, children and, in leaves, the depth with its correction."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    scale: float
    threshold: float = np.inf

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; more for shorter paths."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            while True:
                f = self.feature[t][at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= self.split[t][at]
                at = np.where(inner, self.left[t][at] + right, at)
            total += self.depth[t][at]
        return 2.0 ** (-total / len(self.feature) / self.scale)


def _mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, spread: np.ndarray | None = None, seed: int = 3) -> IsolationForest:
    """Trees over random subsamples; splits may fall outside a node's values by ``spread`` (a number a feature).

    So rows that lie beyond all rows of the sample, also in a feature that is
    constant there, are parted from them early.
    """
    rng = np.random.default_rng(seed)
    size = min(TREE_ROWS, len(x))
    return grow_each([x[rng.choice(len(x), size, replace=False)] for _ in range(TREES)], spread, seed)


def grow_each(drawn: list[np.ndarray], spread: np.ndarray | None = None, seed: int = 3) -> IsolationForest:
    """``grow`` on rows that were drawn for each tree, as many for one as for another."""
    spread = np.zeros(drawn[0].shape[1]) if spread is None else spread
    rng = np.random.default_rng(seed)
    size = len(drawn[0])
    limit = int(np.ceil(np.log2(max(size, 2))))
    trees = []
    for own in drawn:
        feature, split, left, depth = [-1], [0.0], [0], [0.0]
        todo = [(0, own, 0)]
        while todo:
            node, rows, d = todo.pop()
            if not len(rows):
                depth[node] = float(d)
                continue
            low, high = rows.min(axis=0) - spread, rows.max(axis=0) + spread
            usable = np.flatnonzero(high > low)
            if d >= limit or len(rows) < 2 or not len(usable):
                depth[node] = d + _mean_path(len(rows))
                continue
            f = int(rng.choice(usable))
            at = rng.uniform(low[f], high[f])
            feature[node], split[node], left[node] = f, at, len(feature)
            for part in (rows[rows[:, f] < at], rows[rows[:, f] >= at]):
                feature.append(-1)
                split.append(0.0)
                left.append(0)
                depth.append(float(d + 1))
                todo.append((len(feature) - 1, part, d + 1))
        trees.append((np.array(feature), np.array(split), np.array(left), np.array(depth)))
    feature, split, left, depth = (list(p) for p in zip(*trees, strict=True))
    return IsolationForest(feature, split, left, depth, max(_mean_path(size), 1e-9))


def _place(n: int, clean_loss: float) -> int:
    """The threshold's place in the ascending order of n good rows' scores."""
    return n - 1 - int(clean_loss * n)


def calibrate(scores: np.ndarray, good: np.ndarray, clean_loss: float = CLEAN_LOSS) -> float:
    """The lowest threshold above which at most ``clean_loss`` of the good rows score."""
    clean = np.sort(scores[good])
    if len(clean) < LEAST_LABELLED:
        return np.inf
    return float(clean[_place(len(clean), clean_loss)])


def calibrate_all(scores: DataFrame, n: int, clean_loss: float = CLEAN_LOSS) -> float:
    """``calibrate`` over a table of n good rows: each pass counts them by the next 16 of their scores' bits (not negative, so these order them)."""
    place, settled = _place(n, clean_loss), 0
    for shift in (48, 32, 16, 0):
        open_ = scores if shift == 48 else scores.where(F.shiftright("bits", shift + 16) == settled)
        digits = open_.groupBy(F.shiftright("bits", shift).bitwiseAND(F.lit(0xFFFF)).alias("digit")).count().orderBy("digit").collect()
        for r in digits:
            if place < r["count"]:
                break
            place -= r["count"]
        settled = settled << 16 | r["digit"]
    return float(np.array(settled, np.int64).view(np.float64))


def draw(good: DataFrame, n: int, trees: int = TREES, size: int = TREE_ROWS) -> list[np.ndarray]:
    """For each tree, the features of ``size`` of the n rows (_id, features): those that come first in a random order of its own."""
    size = min(size, n)
    first = Window.partitionBy("tree").orderBy("place")
    each = good.select("_id", "features", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    each = each.withColumn("place", F.xxhash64("tree", "_id", "features"))
    share = (size + 8 * size**0.5) / n
    while True:
        # rows far down the order need not be sorted; if too few are left, more are let through
        near = each if share >= 1 else each.where(F.col("place") < int(share * (1 << 64)) - (1 << 63))
        rows = near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= size).select("tree", "nth", "features").toPandas()
        if len(rows) == trees * size:
            x = np.stack(rows.sort_values(["tree", "nth"])["features"].to_list())
            return list(x.reshape(trees, size, -1))
        share *= 4


def _scored(rows: DataFrame, names: list[str], shared: Broadcast) -> DataFrame:
    """The columns ``names``, the score of the column features (anomaly), its bits, and whether it is regular."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest: IsolationForest | None = shared.value
        for batch in batches:
            at = batch.schema.get_field_index("features")
            x = np.array(batch.column(at).flatten()).reshape(batch.num_rows, len(FEATURES))
            anomaly = forest.scores(x) if forest is not None and batch.num_rows else np.zeros(batch.num_rows)
            regular = anomaly <= (np.inf if forest is None else forest.threshold)
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(anomaly), pa.array(anomaly.view(np.int64)), pa.array(regular)], [*names, "anomaly", "bits", "regular"])

    schema = T.StructType([*(rows.schema[c] for c in names), T.StructField("anomaly", T.DoubleType()), T.StructField("bits", T.LongType()), T.StructField("regular", T.BooleanType())])
    return rows.select(*names, "features").mapInArrow(score, schema)


def fit(statistics_of: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> IsolationForest | None:
    """Forest and threshold of all labelled rows that pass the base rules; None if too few of them are good."""
    spark = statistics_of.sparkSession
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
    passed = statistics_of.where("not base_failed").select(F.col(doc_id).alias("_id"), "features").join(known, "_id")
    rows = written(passed.select("_id", "features", (F.col("quality") > 0).alias("good")), "labelled")
    told = rows.agg(F.count_if("good").alias("n"), *(F.stddev_pop(F.get("features", F.lit(k))).alias(f) for k, f in enumerate(FEATURES))).first()
    n = told["n"]
    if n < LEAST_LABELLED:
        return None
    good = rows.where("good")
    # the last digits depend on the order of the sums
    forest = grow_each(draw(good, n), np.array([float(f"{told[f]:.6g}") for f in FEATURES]))
    scores = written(_scored(good, [], spark.sparkContext.broadcast(forest)).select("bits"), "scores")
    forest.threshold = calibrate_all(scores, n)
    return forest


def judge(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (the id by default), the base counts, base_failed, anomaly (0 to 1) and kept."""
    spark = documents.sparkSession
    keep = [doc_id] if keep is None else keep
    rows = written(with_statistics(documents, text, list(dict.fromkeys([*keep, doc_id]))), "statistics")
    shared = spark.sparkContext.broadcast(fit(rows, labels, doc_id))
    names = [*keep, *_COUNTS, "base_failed"]
    judged = _scored(rows, names, shared)
    return judged.select(*names, "anomaly", (~F.col("base_failed") & F.col("regular")).alias("kept"))
