import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import AWKWARD, documents, prose
from pyspark.sql import functions as F

from concord.llm import packing, tokens
from concord.session import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [*AWKWARD, "a  b", " lead", "trail ", "trail  ", "x \n y", "it's  we'll\n\n\n ok", "²½ ⅷ ǅ ɐʬ 漢字 कि", "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "    z", prose(4, 700)]


@pytest.fixture(scope="module")
def library():
    return tokens._tokenizer(PATH)


def test_whole_tokens_encode_alone(library):
    whole = tokens.whole_tokens(PATH)
    assert len(whole) > 40_000 and whole[" the"] == 262
    some = list(whole)[::501]
    assert [e.ids for e in library.encode_batch(some)] == [[whole[t]] for t in some]


def test_counts(spark, sf_dir, library):
    rows = tokens.count_tokens(documents(spark, TEXTS), PATH).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == {k: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in enumerate(TEXTS)}
    docs = table(spark, sf_dir, "documents")
    found = {r.doc_id: (r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, PATH, keep=["doc_id"]).collect()}
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    assert found == {k: (n, n > 1024) for k, n in want.items()}
    assert tokens.count_tokens(docs.limit(0), PATH).count() == 0
    assert tokens.tokenizer_kind(PATH) == "byte-bpe"


def check_pieces(rows, want, capacity):
    """Ids, cuts and places of all pieces."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(want)
    for d, pieces in by_doc.items():
        ids, at = want[d] + [0], 0
        for k, p in enumerate(sorted(pieces, key=lambda p: p.piece)):
            assert (p.piece, p.start) == (k, at)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            assert p.length == capacity or k == 0
            at += p.length
        assert at == len(ids)
    for s in by_sequence.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("partition_rows", [20_000, 40])
def test_packing(spark, sf_dir, library, partition_rows):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(documents(spark, TEXTS, [1000 + k for k in range(len(TEXTS))]).select("doc_id", "text"))
    want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect()}
    rows = packing.pack(packing.pieces_of(docs, PATH), partition_rows=partition_rows).collect()
    made = check_pieces(rows, want, packing.CAPACITY)
    least = packing.lower_bound(np.array([r.length for r in rows]), packing.CAPACITY)
    assert least <= made <= least * 1.03 + 1


def test_packing_edges(spark):
    assert packing.pack_documents(documents(spark, ["a"]).limit(0), PATH).count() == 0
    twice = packing.pack_documents(documents(spark, ["a b", "a b"], [None, None]), PATH, with_ids=True).collect()
    assert sorted(r.offset for r in twice) == [0, 3] and len({r.sequence_id for r in twice}) == 1
    assert np.frombuffer(twice[0].ids, "<u4")[-1] == 0


def test_bound_and_cut():
    rng = np.random.default_rng(1)
    for _ in range(40):
        lengths = rng.integers(1, 33, rng.integers(1, 9))
        best = exact_bins(sorted(lengths.tolist(), reverse=True), 32)
        assert packing.lower_bound(lengths, 32) <= best <= packing.best_fit_decreasing(lengths, 32)[0].max() + 1
    assert packing.cut(5, 2) == [(0, 1), (1, 2), (3, 2)] and packing.cut(4, 2) == [(0, 2), (2, 2)] and packing.cut(2, 2) == [(0, 2)]


def exact_bins(lengths, capacity, bins=()):
    if not lengths:
        return len(bins)
    best = exact_bins(lengths[1:], capacity, (*bins, lengths[0]))
    for k in range(len(bins)):
        if bins[k] + lengths[0] <= capacity:
            best = min(best, exact_bins(lengths[1:], capacity, (*bins[:k], bins[k] + lengths[0], *bins[k + 1 :])))
    return best


def test_rows_counted_once(spark):
    docs = documents(spark, ["a"] * 7, [1] * 7)
    assert packing.pack_documents(docs, PATH).agg(F.sum("length")).first()[0] == 14


def test_ranked_merges_give_the_library_ids(library):
    ranked = tokens.ranked_merges(PATH)
    pieces = [f"{a}{w}{b}" for w in prose(8, 400).split() for a in (" ", "") for b in ("", ".", ",\nÉtait", "'s", "¿ß")] + [" ", "\n\n", "é", "\x00\x7f"]
    assert [ranked(p) for p in pieces] == [e.ids for e in library.encode_batch(pieces, add_special_tokens=False)]


def test_table_keeps_its_bound():
    table = tokens.PieceTable(PATH, limit=50)
    texts = [prose(k, 60) for k in range(20)]
    want = [table.encode_whole([t])[0] for t in texts]
    for _ in range(3):
        assert [b"".join(v) for v in table.values(texts)] == want
    assert len(table.known) <= 1400 and len(table.young) <= 1400


def test_runs_of_white_space_and_special_strings_are_cut_too(library):
    rng = np.random.default_rng(2)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u2003", "\x1c", "\x85", "a", "é", "It's", "42", "!", "<|endoftext|>", "漢"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(20_000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    table = tokens.PieceTable(PATH)
    assert [np.frombuffer(b"".join(v), "<u4").tolist() for v in table.values(texts)] == want
    counts = tokens.CountTable(PATH, tokens.whole_tokens(PATH))
    assert [sum(v) for v in counts.values(texts)] == list(map(len, want))
    indented = "\n".join(" " * (k % 9) + f"word{k % 3} = value" for k in range(400))
    assert max(map(len, table.pieces(indented))) < 30  # no text goes round the table whole
