"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's vector counts its byte bigrams and trigrams (ASCII letters lower-cased,
all else but letters and non-ASCII bytes taken as a blank), hashed to DIMENSIONS
cells, with log term frequencies, inverse document frequencies of all labelled
documents, and length one. Each language's vectors of a bounded sample are
clustered (spherical k-means) into several centroids; a text takes the language
of the centroid with the largest cosine. A document is rejected if it has no
letter, or if its cosine falls below what the sample's documents with about as
many n-grams reach, less a margin.

Learning uses only rows whose crc32(id as text) mod 4 is not 2 and whose language
is known. The sample is bounded by SAMPLE_ROWS in all; document frequencies and
counts cover every labelled row.

Defined results: null texts, and texts without a letter, are "und", score 0,
rejected; with no labelled rows every text is "und"; repeated rows come out as
often as they went in; a null id counts as held out from learning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import LOWER, chunked, kept, small_batches, unused
from concord.session import written

DIMENSIONS = 4096
#: Labelled rows that centroids are clustered from, in all.
SAMPLE_ROWS = 2000
CENTROIDS = 4
FOLDS, HELD_OUT_FOLD = 4, 2
#: A text is rejected below this share of the least cosine of the sample's texts of its size.
MARGIN = 0.6
#: Texts of fewer than 2 ** SHORT n-grams are never rejected for their cosine.
SHORT = 6
UNKNOWN = "und"
_CLASS = np.where((LOWER >= 97) & (LOWER <= 122), LOWER, np.where(np.arange(256) >= 128, np.arange(256), 32)).astype(np.int64)


def cells(raw: np.ndarray) -> np.ndarray:
    """Hashed cells of a text's n-grams; those that are all blank are left out."""
    c = _CLASS[raw]
    if len(c) < 2:
        return np.zeros(0, np.int64)
    two = c[:-1] * 256 + c[1:]
    three = two[:-1] * 256 + c[2:]
    grams = np.concatenate([two[two != 0x2020] + (1 << 24), three[three != 0x202020]])
    return (grams * 0x9E3779B1 >> 7) % DIMENSIONS


def counts_of(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts of cells, a row per text."""
    out = np.zeros((len(bounds) - 1, DIMENSIONS), np.float32)
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        out[k] = np.bincount(cells(raw[a:b]), minlength=DIMENSIONS)
    return out


def normalised(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def clusters(v: np.ndarray, k: int, seed: int = 5, rounds: int = 12) -> np.ndarray:
    """Spherical k-means centroids of the rows of v."""
    rng = np.random.default_rng(seed)
    centres = v[rng.choice(len(v), min(k, len(v)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(v @ centres.T, axis=1)
        sums = np.stack([v[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


@dataclass
class LanguageModel:
    idf: np.ndarray
    centres: np.ndarray
    languages: list[str]
    #: Least cosine accepted, by the logarithm of the number of n-grams.
    least: np.ndarray

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, cosine, and whether it is accepted."""
        cosine = normalised(counts, self.idf) @ self.centres.T
        best = np.argmax(cosine, axis=1)
        score = np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0)
        size = np.minimum(np.log2(counts.sum(axis=1) + 1).astype(int), len(self.least) - 1)
        return best, score, score >= self.least[size]


def is_held_out(doc_id: str | Column) -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(True))


def fit(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """A model from the labelled rows outside the held-out fold; None without any."""
    small_batches(documents.sparkSession)
    learning = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(~is_held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))

    per_lang = {r["lang"]: r["n"] for r in learning.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per_lang:
        return None
    quota = max(1, sample_rows // len(per_lang))
    share = F.lit(0.0)
    for name, n in per_lang.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, quota / n))).otherwise(share)
    taken = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share * (1 << 20)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sampled texts' counts, and a last row with the document frequencies of the task."""
        frequency, rows = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            use, names = batch.column(2).to_numpy(zero_copy_only=False).astype(bool), batch.column(1)
            for low, high, raw, bounds in chunked(batch.column(0), 1 << 18):
                counts = counts_of(raw, bounds)
                frequency += (counts > 0).sum(axis=0)
                rows += high - low
                at = np.flatnonzero(use[low:high])
                if len(at):
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(at + low)), pa.array([0] * len(at), pa.int64()), pa.array([counts[k].tobytes() for k in at], pa.binary())], ["lang", "n", "cells"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([rows], pa.int64()), pa.array([frequency.tobytes()], pa.binary())], ["lang", "n", "cells"])

    found = written(learning.select("text", "lang", taken.alias("taken")).mapInArrow(vectors, "lang string, n long, cells binary"), "langid")

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for frame in frames:
            for size, data in zip(frame["n"], frame["cells"], strict=True):
                total += np.frombuffer(data, np.int64)
                n += size
        yield pd.DataFrame({"cell": np.arange(DIMENSIONS + 1), "n": np.append(total, n)})

    frequency = np.zeros(DIMENSIONS + 1, np.int64)
    for r in found.where("lang is null").select("n", "cells").mapInPandas(add, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        frequency[r["cell"]] = r["n"]
    idf = (np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1).astype(np.float32)

    sample = found.where("lang is not null").select("lang", "cells").limit(2 * sample_rows + 64 * len(per_lang)).toPandas().sort_values(["lang", "cells"])
    counts = {name: np.stack([np.frombuffer(c, np.float32) for c in part["cells"]]) for name, part in sample.groupby("lang")}
    names, centres = [], []
    for name, c in counts.items():
        found_centres = clusters(normalised(c, idf), CENTROIDS)
        names += [name] * len(found_centres)
        centres.append(found_centres)
    model = LanguageModel(idf, np.concatenate(centres).astype(np.float32), names, np.zeros(32))
    every = np.concatenate(list(counts.values()))
    _, score, _ = model.predict(every)
    size = np.minimum(np.log2(every.sum(axis=1) + 1).astype(int), 31)
    least, seen = np.zeros(32), np.inf
    for k in range(31, -1, -1):  # longer texts are never asked for less than shorter ones
        if (size == k).sum() >= 5:
            seen = min(seen, float(score[size == k].min()))
        least[k] = MARGIN * seen if np.isfinite(seen) else 0.0
    sizes = np.flatnonzero(np.bincount(size, minlength=32) >= 5)
    if len(sizes):
        least[sizes[-1] + 1 :] = least[sizes[-1]]  # longer than any judged: asked for as much as the longest that were
        least[: max(sizes[0], SHORT)] = 0.0  # too short to judge by
    model.least = least
    return model


def identify(documents: DataFrame, model: LanguageModel | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with lang_pred, score and rejected, which replace columns of these names."""
    spark = documents.sparkSession
    small_batches(spark)
    keep, has = kept(documents, keep, ("lang_pred", "score", "rejected")), unused(documents, "_lettered")
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel | None = shared.value
        for batch in batches:
            n = batch.num_rows
            lang, score, rejected = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
            lettered = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            if m is not None:
                names = np.array(m.languages, object)
                for low, high, raw, bounds in chunked(batch.column(text), 1 << 18):
                    best, cosine, accepted = m.predict(counts_of(raw, bounds))
                    at = np.flatnonzero(lettered[low:high])
                    lang[low + at], score[low + at], rejected[low + at] = names[best[at]], cosine[at], ~accepted[at]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], [*keep, "lang_pred", "score", "rejected"])

    schema = T.StructType([*(documents.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias(has)
    return documents.select(*dict.fromkeys([*keep, text]), has_letter).mapInArrow(predict, schema)


def drop_rejected(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the model accepts, with their own columns."""
    plain = [f"_c{i}" for i in range(len(documents.columns))]
    key, body, label = (plain[documents.columns.index(c)] for c in (doc_id, text, lang))
    renamed = documents.toDF(*plain)
    return identify(renamed, fit(renamed, key, body, label), body).where("not rejected").select(*plain).toDF(*documents.columns)
