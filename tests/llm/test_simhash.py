import random
import re

import numpy as np
import pytest
import xxhash
from helpers import AWKWARD, documents, prose

from concord.llm import simhash
from concord.session import table


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, distance=3):
    """nodes: id -> fingerprint; id -> smallest id reachable."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ids = sorted(nodes)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (nodes[a] ^ nodes[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_copies(seed, n):
    base = prose(seed, 400).split()
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = list(base)
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    return out


def test_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(documents(spark, [*AWKWARD, *near_copies(5, 12), prose(5, 400)], range(5000, 5013 + len(AWKWARD))).select("doc_id", "text"))
    want = {r.doc_id: fingerprint(r.text) for r in docs.collect()}
    group = components(want)
    rows = simhash.near_duplicate_groups(docs).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {d: (f, group[d]) for d, f in want.items()}
    assert len(set(group.values())) < len(group) - 20


@pytest.mark.parametrize(("bucket", "masks"), [(2048, None), (16, None), (64, [0])])
def test_links_of_crowded_fingerprints(spark, bucket, masks):
    rng = random.Random(bucket)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))) for _ in range(60)}
    nodes = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    table_of = spark.createDataFrame([(n,) for n in nodes], "fp long")
    found = simhash.connected_components(simhash.links(table_of, bucket=bucket, masks=masks))
    got = {r.node: r.component for r in found.collect()}
    assert {n: got.get(n, n) for n in nodes} == components(nodes)


def test_masks_cover_every_pair():
    together = np.ones((64, 64)) * 25 + np.eye(64) * 25
    for parts in (2, 3, 4):
        groups = simhash.group_bits(100, together, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
    assert sum(t + 1 for t in simhash.allocate([[0, 5, 9, 20, 50], [0, 1, 2, 3, 4], [0, 7, 8, 9, 10]], 4)) == 4
    for mask in simhash.split_mask(0xFFFF):
        assert mask & 0xFFFF == 0xFFFF and mask.bit_count() == 28


def test_one_of_each_stays(spark):
    docs = documents(spark, ["x y z w", "x y z w", None, "", "other text of its own", "other text of its own", "lone", "lone"], [7, 3, 9, 8, 4, 4, None, None]).selectExpr("*", "1 as fp", "2 as component_id")
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "lone"), (3, "x y z w"), (4, "other text of its own"), (8, "")]
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0
