"""License scans, personal data and sharding: DataFrame operations only."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from helpers import AWKWARD, crc, documents, prose

from concord.llm import licenses, pii, sharding
from concord.session import fresh_path, table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow", plan)


def license_base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


LICENSED = [
    "Under the MIT License. under the mit-license, under the mit licenses",
    "Apache License, Version 2.0 and CC BY-NC and cc by nc",
    "cc by nc " * 2000,
    "x Permission is hereby granted, free of charge, to any human person obtaining a copy of this software",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "licensed under the garden in winter",
    "mit license under the",
    "under the",
    "all rights reserved",
    "x " * 300 + licenses.TEXTS["mit"] + " y" * 300,
    " ".join(w for k, w in enumerate(licenses.TEXTS["isc"].split()) if k % 23 != 11),
    " ".join(["permission is hereby granted free of charge"] * 40),
    " filler ".join(licenses.NOTICES["mpl-2"].split()),
]


def test_licenses(spark, sf_dir):
    texts = [*AWKWARD, *LICENSED]
    docs = documents(spark, texts)
    rows = licenses.license_labels(docs)
    assert no_python(rows)
    found = {r.doc_id: r for r in rows.collect()}
    for k, t in enumerate(texts):
        r = found[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == license_base(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(r["labels"].split(",")) and 0 <= r.score <= 1
    n = len(AWKWARD)
    assert [found[n + k]["labels"] for k in range(len(LICENSED))] == ["mit", "apache-2,cc-by-nc", "cc-by-nc", "mit", "cc-by-nc", "", "", "", "", "mit", "isc", "", ""]
    assert found[n + 9].score == 1.0
    given = table(spark, sf_dir, "documents")
    want = {r.doc_id: license_base(r.text) for r in given.collect()}
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.license_labels(given).collect()} == want


def test_licenses_repeated_rows_and_empty_table(spark):
    docs = documents(spark, [LICENSED[0]] * 3 + ["none"], [1, 1, None, None])
    rows = [(r.doc_id, r.n_base) for r in licenses.license_labels(docs).collect()]
    assert Counter(rows) == {(1, 2): 2, (None, 2): 1, (None, 0): 1}
    assert licenses.license_labels(docs.limit(0)).count() == 0


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PRIVATE = [
    "é🙂 mail a.b+c@d-e.co.uk. Next x@y and a@b.c_d@e.f, _@x.y..z",
    "ips 1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 9.9.9.99999999999999999999 1.2.3",
    "cards 4337166598464399 4337-1665-9846-4399 4337 1665  9846 4399 4337166598464390 0000000000000 12345678901234567890",
    "call +1 (988) 555-2485 or +49 30 1234567, +1, +12, +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 tel 555-123-4567 end",
    "phone 555-123-4567",
    "a@" + "b." * 20_000 + "c",
    "+1 " + "2" * 30_000,
    "a" * 40_000 + "@",
]


def test_personal_data_base(spark, sf_dir):
    texts = [t for t in [*AWKWARD, *PRIVATE]]
    rows = pii.personal_data(documents(spark, texts))
    assert no_python(rows)
    for r in rows.collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (texts[r.doc_id][:80], want, r.spans)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
        assert set(want) <= set(filter(None, r.spans.split(",")))
    given = table(spark, sf_dir, "documents")
    want = {r.doc_id: hashlib.sha256(",".join(base_spans(r.text)).encode()).hexdigest() for r in given.collect()}
    assert {r.doc_id: r.base_sha256 for r in pii.personal_data(given).collect()} == want


def test_method_adds_likely_spans_only(spark):
    texts = [f"{prose(k, 20)} write to user{k}@mail.example.com or call +1 (988) 555-{2000 + k} {prose(k + 1, 9)}" for k in range(40)]
    texts += [f"phone 555-123-{4000 + k} {prose(k, 9)}" for k in range(20)] + [f"v1.2.3.{300 + k} {prose(k, 30)}" for k in range(20)]
    rows = {r.doc_id: r.spans for r in pii.personal_data(documents(spark, texts)).collect()}
    assert sum("phone:6:18" in rows[k] for k in range(40, 60)) == 20
    assert all(rows[k] == "" for k in range(60, 80))


def test_redaction(spark):
    docs = documents(spark, ["é a@b.co x +1 (988) 555-2485.", None, "clean"]).selectExpr("*", "'k' as spans", "1 as base")
    rows = pii.redact(docs).orderBy("doc_id").collect()
    assert rows[0].text == "é [EMAIL] x [PHONE]." and rows[0].n_chars == len(rows[0].text)
    assert rows[1].text is None and rows[2].text == "clean" and rows[0].spans == "k"
    assert pii.redact(docs.limit(0)).count() == 0


def test_running_totals(spark):
    from pyspark.sql import functions as F

    for n in (0, 1, 3, 4, 5, 16, 17, 41):
        values = [(k * 7) % 11 - 3 for k in range(n)]
        df = spark.createDataFrame([(values,)], "v array<int>")
        total, most = df.select(pii.running(F.col("v"), "int", F.lit(0), lambda a, b: a + b, 4), pii.running(F.col("v"), "int", F.lit(0), F.greatest, 4)).first()
        assert total == [sum(values[:k]) for k in range(n + 1)]
        assert most == [max([0, *values[:k]]) for k in range(n + 1)]


def test_redaction_of_many_and_overlapping_spans(spark):
    rng = random.Random(4)
    parts = [rng.choice(["a.b@c.org", "10.1.2.3", "4337166598464399", "+1 (988) 555-2485", "é", "🙂", "12", "x\n"]) for _ in range(3000)]
    text = "".join(p + rng.choice([" ", ",", ""]) for p in parts)
    docs = documents(spark, [text])
    spans = [x.split(":") for x in pii.personal_data(docs).first().spans.split(",")]
    out, at = [], 0
    for start, end, kind in sorted((int(s), int(e), k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    assert pii.redact(docs).first().text == "".join(out) + text[at:]
    assert len(spans) > 1000


def test_cost_grows_with_matches_not_with_their_square(spark):
    def seconds(n, word):
        docs = documents(spark, [" ".join(word(k) for k in range(n))])
        began = time.time()
        found = pii.personal_data(docs).first()
        return time.time() - began, found

    for word, emails in ((lambda k: f"{100 + k % 900} x", 0), (lambda k: f"a{k}@b{k}.org y", 1)):
        few, _ = seconds(2000, word)
        many, found = seconds(100_000, word)
        assert found.n_email == emails * 100_000 and found.n_card == 0
        assert many < 5 * few + 10  # fifty times the matches; the square would be 2,500 times


def test_em_finds_the_reliable_labeler():
    plain = (1, "none", "word")
    counts = [("email", (1, 1, 0, 1, 1), plain, 90.0), ("email", (2, 2, 0, 2, 2), plain, 60.0), ("email", (2, 1, 1, 1, 1), plain, 10.0)]
    post = pii.estimate(counts)
    assert post["email", (1, 1, 0, 1, 1)] > 0.9 > 0.1 > post["email", (2, 2, 0, 2, 2)]


@pytest.mark.parametrize("bucket_bytes", [16 << 20, 20_000])
def test_shards(spark, sf_dir, bucket_bytes):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(documents(spark, [None, "", "a", "a"], [901, 902, 903, 903]).select("doc_id", "text"))
    path = fresh_path(spark, "shards")
    rows = sharding.write_shards(docs, path, bucket_bytes=bucket_bytes)
    assert no_python(rows)
    got = rows.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in docs.collect())
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 16
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    again = sharding.write_shards(docs, fresh_path(spark, "shards"), bucket_bytes=bucket_bytes)
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in again.collect()) == Counter((r.doc_id, r.text, r.shard, r.slot) for r in got)
    if bucket_bytes < 1 << 20:  # a bucket is a task
        assert rows.groupBy("bucket").count().count() > 16


def test_shard_law(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sharding.shard_documents(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 1, crc(texts[r.doc_id])) for r in rows)
    assert all(r.grown_shard in (r.shard, 16) for r in rows) and 0 < sum(r.grown_shard == 16 for r in rows) < len(rows) / 4
    again = {r.doc_id: r.shard for r in sharding.shard_documents(docs.where("doc_id % 2 = 0")).collect()}
    assert all(again[r.doc_id] == r.shard for r in rows if r.doc_id in again)
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_shared_id_is_spread(spark):
    """Records that share an id, null included, and even all else, stay in its shard but not in one bucket; clashing columns give way."""
    rows = [(None, f"text {i}", i) for i in range(300)] + [(i, f"text {i}", i) for i in range(100)] + [(7, "same", 7)] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    got = sharding.write_shards(docs, fresh_path(spark, "shards"), bucket_bytes=4096).collect()
    assert len(got) == len(rows)
    for shared in ([r for r in got if r.doc_id is None], [r for r in got if r.text == "same"]):
        assert len({r.shard for r in shared}) == 1 and len({r.bucket for r in shared}) > 5
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
