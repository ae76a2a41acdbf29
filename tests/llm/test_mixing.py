"""Mixes against targets shared by hand and a sorted draw."""

import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import AWKWARD, documents, prose
from pyspark.sql import functions as F
from test_native import no_python

from concord.llm import mixing
from concord.session import table


def shared(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """The contract's rounds: what goes beyond a source's limit is shared anew by weight."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = sum(max(0, target[s] - most * sizes[s]) for s in open_)
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def checked(found, texts):
    """texts: {doc_id: (source, text)}"""
    size = {k: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for k, (_, t) in texts.items()}
    sizes, longest = Counter(), Counter()
    for k, (s, _) in texts.items():
        sizes[s] += size[k]
        longest[s] = max(longest[s], size[k])
    target, taken = shared(sizes), Counter()
    assert Counter(r.doc_id for r in found) == Counter(list(texts))
    for r in found:
        source = texts[r.doc_id][0]
        assert (r["size"], r.source_size) == (size[r.doc_id], sizes[source]) and r.target == pytest.approx(target[source])
        assert 0 <= r.copies <= 2 and (r["size"] or not r.copies)
        taken[source] += r.copies * r["size"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6
    return taken


@pytest.mark.parametrize("power,fine", [(0.5, 20_000), (0.0, 1), (1.0, 3)])
def test_targets_and_limits(spark, power, fine):
    rng = random.Random(2)
    texts = [*AWKWARD, *(prose(k, rng.choice([1, 5, 40, 400])) for k in range(300))]
    source = lambda k: None if k % 11 == 0 else "big" if k % 3 else f"s{k % 7}"
    rows = {k: (source(k), t) for k, t in enumerate(texts)}
    docs = documents(spark, texts).drop("source").join(spark.createDataFrame([(k, s) for k, (s, _) in rows.items()], "doc_id long, source string"), "doc_id")
    found = mixing.mix(docs, power=power, fine=fine)
    assert no_python(found)
    first = found.collect()
    checked(first, rows)
    again = mixing.mix(docs.repartition(7), power=power, fine=fine).collect()
    assert {r.doc_id: r.copies for r in first} == {r.doc_id: r.copies for r in again}


def test_order_is_pareto(spark):
    """Sorted by the odds' ratio, the drawn are the first ones of their source."""
    texts = [prose(k, 1 + k % 50) for k in range(400)]
    found = mixing.mix(documents(spark, texts)).withColumn("draw", F.xxhash64(F.lit(mixing.SEED), "doc_id", "text")).collect()
    total = sum(r["size"] for r in found)
    # the share of 1.5 is under the limit of 2; the factor is found by bisection
    low, high = 0.0, 10.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(2, mid * r["size"] ** 0.5) * r["size"] for r in found) < 1.5 * total else (low, mid)
    ratios = []
    for r in found:
        expected = min(2, low * r["size"] ** 0.5)
        p, u = expected % 1, (((r.draw % 2**64) >> 11) + 0.5) / 2**53
        if p > 1e-9:
            ratios.append((u / (1 - u) / (p / (1 - p)), r.copies - int(expected)))
        else:
            assert r.copies == expected
    drawn = [c for _, c in sorted(ratios)]
    assert drawn == sorted(drawn, reverse=True) and 0 < sum(drawn) < len(drawn)


def test_inclusion_follows_the_odds(spark):
    """Over many seeds a document is taken about as often as expected."""
    docs = documents(spark, [prose(k, 10 if k % 2 else 90) for k in range(400)])
    n = 2
    copies = defaultdict(float)
    for seed in range(n):
        for r in mixing.mix(docs, seed=seed, share=0.5).collect():
            copies[r["size"]] += r.copies / n / 200
    # a power of a half: nine times the size, three times the copies
    assert copies[90] / copies[10] == pytest.approx(3, rel=0.35)


def test_given_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    checked(mixing.mix(docs, keep=["doc_id"]).collect(), {r.doc_id: (r.source, r.text) for r in docs.collect()})


def test_repeated_rows_clashes_and_empty_table(spark):
    docs = documents(spark, ["one two three"] * 400 + [None] * 3, [5] * 400 + [None] * 3).withColumn("target", F.lit("own")).withColumn("key", F.lit("k"))
    found = mixing.mix(docs, fine=10).collect()
    assert sum(r.copies for r in found) == 600 and max(r.copies for r in found) == 2 and len(found) == 403
    assert found[0].target == 1800.0 and found[0].key == "k"
    assert mixing.mixed(docs).count() == 600 and "key" in mixing.mixed(docs).columns
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.where("text is null")).select("copies", "target").distinct().collect() == [(0, 0.0)]
