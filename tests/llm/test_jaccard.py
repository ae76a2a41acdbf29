import random

import numpy as np
import pytest
from helpers import AWKWARD, documents, prose
from pyspark.sql import functions as F

import corpus_pipeline
from concord.llm import jaccard, simhash
from concord.operators import similar


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def survivors(texts):
    """Least place of every group, by brute force."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a and b and 5 * len(a & b) >= 4 * len(a | b)):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return sorted(set(root))


def copies(seed, words, changes, n):
    rng, base = random.Random(seed), prose(seed, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.sample(range(len(w)), changes):
            w[at] = f"changed{rng.randrange(1000)}"
        out.append(" ".join(w))
    return out


def test_stage_links_similar_texts(spark, sf_dir):
    # four words of 400: a Jaccard similarity of about 0.9 with the unchanged text, beyond 3 bits of 64 for most
    texts = [*AWKWARD, *(t for seed in range(20) for t in (prose(100 + seed, 400), *copies(100 + seed, 400, 4, 1)))]
    docs = documents(spark, texts)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect())
    assert kept == survivors(texts)
    assert len(kept) <= len(AWKWARD) + 20


@pytest.mark.parametrize("direct", [None, 0, 2000])
def test_crowded_keys_against_brute_force(spark, direct):
    texts = [t for seed, changes in enumerate((1, 2, 3, 4, 5)) for t in copies(seed, 120, changes, 12)]
    random.Random(1).shuffle(texts)
    found = jaccard.keep_one_of_each(documents(spark, texts), direct=direct)
    assert sorted(r.doc_id for r in found.collect()) == survivors(texts)


def test_sketches_never_exceed_the_difference():
    rng = random.Random(3)
    for n in (0, 1, 5, 200, 3000):
        a = {rng.randrange(1 << 63) for _ in range(n)}
        b = {x for x in a if rng.random() < 0.9} | {rng.randrange(1 << 63) for _ in range(n // 9)}
        x, y = (jaccard.sketch(np.array(sorted(s), np.uint64)) for s in (a, b))
        assert int(np.bitwise_count(x ^ y).sum()) <= len(a ^ b)


def test_stage_takes_nulls_repeats_and_other_columns(spark, sf_dir):
    docs = documents(spark, ["a b c d e f"] * 3 + [None, "", None], [4, 4, None, None, 9, 8]).withColumn("node", F.lit("own")).withColumn("keys", F.lit(1))
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.node) for r in kept.collect()) == [(4, "own"), (8, "own")]
    assert jaccard.keep_one_of_each(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no column text"):
        jaccard.keep_one_of_each(docs.drop("text"))


def test_recall_on_planted_pairs(spark):
    """Pairs at 0.80 to 0.85: every one is linked."""
    texts, pairs = [], 0
    for seed in range(60):
        base = prose(1000 + seed, 150).split()
        for changes in (3, 4):
            other = list(base)
            for at in random.Random(seed).sample(range(0, 150, 12), changes):
                other[at] = f"new{seed}"
            a, b = shingles(" ".join(base)), shingles(" ".join(other))
            if 0.80 <= len(a & b) / len(a | b) < 0.85:
                texts += [" ".join([*base]), " ".join(other)]
                pairs += 1
                break
    kept = jaccard.keep_one_of_each(documents(spark, texts)).count()
    assert pairs >= 30 and kept == pairs


def test_no_link_is_left_to_chance(spark):
    """Pairs of 10 and 8 shingles, a similarity of exactly 0.8, which share none of 24 keys of 5 hashed minima."""
    texts = [t for seed in (15161, 54419, 56045) for t in (prose(seed, 14), " ".join(prose(seed, 14).split()[:12]))]
    kept = jaccard.keep_one_of_each(documents(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == survivors(texts) == [0, 2, 4]


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 5, jaccard.CELLS)
    for n in [*range(1, 40), 300, 999]:
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        for other in (a[: -(-4 * n // 5)], a[n - -(-4 * n // 5) :], rng.permutation(a)[: -(-4 * n // 5)], np.append(a, rng.integers(0, 1 << 63, n // 4, np.uint64))):
            b = np.unique(other)
            assert 9 * len(np.intersect1d(a, b)) >= 4 * (len(a) + len(b))
            assert np.intersect1d(jaccard.prefix(a, counts), jaccard.prefix(b, counts)).size
    assert not jaccard.prefix(np.zeros(0, np.uint64), counts).size


def test_stage_searches_fingerprints_first(spark, sf_dir, monkeypatch):
    texts = [*AWKWARD, *(t for seed in range(12) for t in copies(300 + seed, 300, 1, 4)), *(prose(seed, 200) for seed in range(20))]
    docs, probed, linked = documents(spark, texts), [], []

    def links(fps, distance):
        probed.append(({r.fp for r in fps.collect()}, distance))
        return simhash.links(fps, distance)

    def groups(pairs, nodes, *rest):
        linked.append(whole(pairs, nodes, *rest))
        return linked[0]

    whole = jaccard.groups_of_pairs
    monkeypatch.setattr(jaccard, "links", links)
    monkeypatch.setattr(jaccard, "groups_of_pairs", groups)
    kept = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    prints = {r.doc_id: r.fp for r in simhash.with_fingerprints(docs, keep=["doc_id"], words=5).collect()}
    assert probed == [(set(prints.values()), simhash.DISTANCE)]
    # every pair of the copies within the distance is in a group by then: they are similar
    node = {t: None for t in texts}
    found = {r.node: r.group for r in linked[0].collect()}
    for t, hashes in ((t, np.array(simhash.shingle_hashes((t or "").encode(), 5), np.uint64)) for t in node):
        node[t] = int(np.array(jaccard.xxhash.xxh64_intdigest(np.unique(hashes).tobytes(), jaccard.SEED), np.uint64).view(np.int64))
    close = 0
    for low in range(len(AWKWARD), len(AWKWARD) + 48, 4):
        for i in range(low, low + 4):
            for j in range(low, i):
                if texts[i] != texts[j] and ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= simhash.DISTANCE:
                    assert found[node[texts[i]]] == found[node[texts[j]]]
                    close += 1
    assert close >= 5
    assert sorted(r.doc_id for r in kept.collect()) == survivors(texts)


def test_cells_are_counted_over_all_texts(spark):
    texts = [*AWKWARD, prose(1, 400), prose(1, 400)]
    want = np.zeros(jaccard.CELLS, np.int64)
    for t in texts:
        for h in simhash.shingle_hashes((t or "").encode(), 5):
            want[h % jaccard.CELLS] += 1
    assert (jaccard.cell_counts(documents(spark, texts)) == want).all()
    assert not jaccard.cell_counts(documents(spark, texts).limit(0)).any()


def test_sketches_tell_long_texts_apart(spark):
    """Fixed 1,024 bits let any two sets of over 2,304 shingles pass."""
    rng = np.random.default_rng(5)
    longs = "node long, sketch struct<size: long, bits: array<long>>"
    for n, m in ((3000, 3000), (4000, 4200), (3000, 3600), (20_000, 17_000)):
        a, b = (rng.integers(0, 1 << 63, k, np.uint64) for k in (n, m))
        # the third is like the first, in the next class of sizes for some
        c = np.append(a[n // 20 :], rng.integers(0, 1 << 63, n // 9, np.uint64))
        rows = [(k, (len(s), jaccard.sketch(s).view(np.int64).tolist())) for k, s in enumerate((a, b, c))]
        pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a long, b long")
        assert [tuple(r) for r in similar._may_link(pairs, spark.createDataFrame(rows, longs), jaccard.SIMILAR).collect()] == [(0, 2)]


def test_sketches_of_other_sizes_fold():
    rng = np.random.default_rng(6)
    for n in (60, 500, 1000, 4000):
        a = rng.integers(0, 1 << 63, n, np.uint64)
        b = np.append(a, rng.integers(0, 1 << 63, n // 5, np.uint64))
        x, y = jaccard.sketch(a), jaccard.sketch(b)
        assert len(y) in (len(x), 2 * len(x))
        folded = y if len(x) == len(y) else y[: len(x)] ^ y[len(x) :]
        assert int(np.bitwise_count(x ^ folded).sum()) <= len(b) - len(a)
