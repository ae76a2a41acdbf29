"""Fill-in-middle against slices of the text, the wavelet matrix against counting."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, documents, prose
from pyspark.sql import functions as F

from concord.llm import middle

TEXTS = [*AWKWARD, "a<P>b", "<S>", "x <M>", "<P", "ends <", "🙂" * 4000, "é\nß x\n\nlast line", *(prose(k, 20 + k) for k in range(60))]


def wanted(doc_id, text):
    text = text or ""
    h = [int(hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in middle.MARKS) or h[2] % 100 >= 90:
        return (n, "plain", None, None, text)
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}")
    return (n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}")


def test_characters(spark):
    docs = documents(spark, TEXTS)
    found = middle.fill_in_middle(docs).withColumn("back", middle.restored()).collect()
    assert len(found) == len(TEXTS) and {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.fim) == wanted(r.doc_id, TEXTS[r.doc_id])
        assert r.back == (TEXTS[r.doc_id] or "") and r.lang == "en"


@pytest.mark.parametrize("unit", ["word", "line"])
def test_other_units_start_where_cut(spark, unit):
    texts = ["one two\nthree  four\n\nfive ß" * k for k in range(1, 30)]
    found = middle.fill_in_middle(documents(spark, texts), unit=unit, transformed=100, suffix_first=0).collect()
    for r in found:
        text = texts[r.doc_id]
        starts = [m.start() for m in re.finditer(r"(?<!\S)\S" if unit == "word" else r"(?<=\n)[\s\S]|\A[\s\S]", text)]
        assert r.n == len(starts)
        pre, rest = r.fim.removeprefix("<P>").split("<S>")
        suf, mid = rest.split("<M>")
        assert pre + mid + suf == text
        cut = lambda k: 0 if k == 0 else starts[k] if k < len(starts) else len(text)
        assert (len(pre), len(pre) + len(mid)) == (cut(r.prefix_chars), cut(r.prefix_chars + r.middle_chars))


def test_wavelet_matrix_ranks():
    symbols = np.random.default_rng(3).integers(0, 5, 1000).astype(np.uint8)
    matrix, at = middle.WaveletMatrix(symbols), np.arange(1001)
    for s in range(5):
        assert matrix.rank(s, at).tolist() == [0, *np.cumsum(symbols == s).tolist()]


def test_repeated_rows_clashing_columns_and_empty_table(spark):
    docs = documents(spark, ["some words here"] * 4 + [None], [7, 7, None, None, None]).withColumn("Form", F.lit("own")).withColumn("_h0", F.lit(1)).withColumn("fim", F.lit("own"))
    found = middle.fill_in_middle(docs).collect()
    assert Counter((r.doc_id, r.form, r.fim, r["_h0"]) for r in found).most_common(2)[0][1] == 2 and len(found) == 5
    assert [c for c in middle.fill_in_middle(docs).columns if c.lower() == "form"] == ["form"]
    assert middle.fill_in_middle(docs.limit(0)).count() == 0
