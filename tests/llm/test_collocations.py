"""Collocations against counting every phrase, summaries against their guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from helpers import AWKWARD, documents, prose
from pyspark.sql import functions as F

from concord.llm import collocations
from concord.session import table


def pieces(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", lower)]


def brute(rows, threshold, first):
    """rows of (lang, text)"""
    f, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            words[lang] += len(w)
            for n in range(1, 6):
                f[lang].update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        held = Counter()
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for k in range(len(p) - n + 1):
                    held[p[k : k + n]] = max(held[p[k : k + n]], a)
        kept = []
        for p, a in candidates.items():
            if held[p] >= a:
                continue
            score, _, left, right = min((1000 * a * words[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_against_counting(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    given = [(r.lang, r.text) for r in docs.collect()]
    for threshold, first in ((100, 2000), (6, 50)):
        want = brute(given, threshold, first)
        assert rows_of(collocations.collocations(docs, threshold=threshold, first=first)) == want
    assert len(want) > 100


def test_awkward_texts_ties_and_overlaps(spark):
    rng = random.Random(5)
    texts = [*AWKWARD, "a a a a a a a", "x\ty  z, x y\rz", "Ab aB AB ab.ab;ab", "é ß é ß é ß", *(prose(k, 60) for k in range(40))]
    texts += [" ".join(rng.choice("p q r s".split()) for _ in range(50)) for _ in range(20)]
    docs = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "fr").when(F.col("doc_id") % 3 == 1, "en")).withColumn("f", F.lit(1)).withColumn("words", F.lit("x"))
    want = brute([(r.lang, r.text) for r in docs.collect()], 3, 100_000)
    assert {lang for lang, *_ in want} == {"fr", "en", "und"}
    assert rows_of(collocations.collocations(docs, threshold=3, first=100_000)) == want


def test_products_beyond_64_bits(spark):
    # n, a, l and r of this size come from no small fixture, so the counts are given
    counts = spark.createDataFrame([("en", 0, "", 9 * 10**15), ("en", 1, "a", 3 * 10**12 + 1), ("en", 1, "b", 2 * 10**12 + 7), ("en", 2, "a b", 10**12 + 3)], "lang string, words int, phrase string, f long")
    given = collocations.phrase_counts
    try:
        collocations.phrase_counts = lambda *a, **b: counts
        r = collocations.collocations(counts).first()
    finally:
        collocations.phrase_counts = given
    assert r.score == 1000 * (10**12 + 3) * 9 * 10**15 // ((3 * 10**12 + 1) * (2 * 10**12 + 7))


def test_empty_table(spark):
    assert collocations.collocations(documents(spark, ["x"]).limit(0)).count() == 0
    assert collocations.collocations(documents(spark, [None, ""])).count() == 0


def test_every_frequent_item_keeps_a_counter():
    rng = np.random.default_rng(1)
    for threshold in (5, 20):
        stream = np.concatenate([rng.integers(0, 50_000, 60_000), np.repeat(rng.integers(0, 50_000, 40), threshold)]).astype(np.uint64)
        rng.shuffle(stream)
        summary = collocations.MisraGries(len(stream) // threshold + 1, pending=3000)
        for part in np.array_split(stream, 50):
            summary.add(*np.unique(part, return_counts=True))
        summary.settle()
        assert 0 < summary.error < threshold and len(summary.items) <= summary.capacity
        held = dict(zip(summary.items.tolist(), summary.counts.tolist(), strict=True))
        for item, f in Counter(stream.tolist()).items():
            assert f - summary.error <= held.get(item, 0) <= f
            assert f < threshold or held[item] + summary.error >= threshold


def test_words_with_one_hash_are_told_apart():
    class Clash(collocations.Phrases):
        pass

    data = b"aa bb aa cc"
    phrases = Clash(np.frombuffer(data, np.uint8), np.array([0, len(data)]), np.zeros(1, np.uint64))
    phrases.words = np.zeros(4, np.uint64)
    assert phrases.word_ids().tolist() == [0, 1, 0, 2]
