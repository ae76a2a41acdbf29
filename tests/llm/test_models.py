"""Language ID, quality rules and the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
from helpers import AWKWARD, documents, prose

import corpus_pipeline
from concord.llm import langid, quality
from concord.session import table


def test_languages_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = langid.identify(docs, langid.fit(docs)).withColumn("held_out", langid.is_held_out("doc_id")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_languages_edges(spark):
    texts = [*AWKWARD, "123 456", "Ω", prose(1, 50)]
    learn = documents(spark, [prose(k, 80) for k in range(60)]).unionByName(documents(spark, [f"les {k} êtes de là où nous étions très déjà" for k in range(60)], range(100, 160), "fr"))
    model = langid.fit(learn.unionByName(documents(spark, ["x y"], [None], "zz")))
    assert set(model.languages) == {"en", "fr"}
    rows = {r.doc_id: r for r in langid.identify(documents(spark, texts).selectExpr("*", "1 as extra"), model, keep=["doc_id", "extra"]).collect()}
    for k, t in enumerate(texts):
        lettered = any(c.isalpha() for c in t or "")
        assert (rows[k].lang_pred == "und") == (not lettered) and (lettered or rows[k].rejected)
    assert rows[len(texts) - 1].lang_pred == "en" and not rows[len(texts) - 1].rejected
    none = documents(spark, ["a b"], lang=None)
    assert langid.fit(none) is None and [r.lang_pred for r in langid.identify(none, None).collect()] == ["und"]
    assert langid.identify(none.limit(0), model).count() == 0
    kept = langid.drop_rejected(learn.withColumnRenamed("source", "score"))
    assert kept.columns == ["doc_id", "text", "lang", "score", "n_chars"] and kept.count() == 120


def grams(text):
    """Every byte bigram and trigram but blank ones, by hand."""
    data = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in text.encode())
    out = Counter()
    for n in (2, 3):
        for k in range(len(data) - n + 1):
            g = data[k : k + n]
            if g != b" " * n:
                number = int.from_bytes(g, "big") + (n == 2) * (1 << 24)
                out[(number * 0x9E3779B1 >> 7) % langid.DIMENSIONS] += 1
    return out


def test_predictions_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").unionByName(documents(spark, [*AWKWARD, "Ω é", "THE cat"], range(5000, 5002 + len(AWKWARD))))
    model = langid.fit(docs)
    rows = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for r in docs.collect():
        got, counts = rows[r.doc_id], grams(r.text or "")
        if not any(c.isalpha() for c in r.text or ""):
            assert (got.lang_pred, got.score, got.rejected) == ("und", 0.0, True)
            continue
        weight = {c: math.log1p(n) * float(model.idf[c]) for c, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in weight.values())) or 1.0
        cosine = [sum(w * float(centre[c]) for c, w in weight.items()) / norm for centre in model.centres]
        best = max(cosine)
        assert abs(got.score - min(1, max(0, best))) < 1e-4
        assert got.lang_pred in {name for name, c in zip(model.languages, cosine, strict=True) if c > best - 1e-4}
        least = model.least[min(int(math.log2(sum(counts.values()) + 1)), len(model.least) - 1)]
        if abs(best - least) > 1e-4:
            assert got.rejected == (best < least)


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    many = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if many[w] > 1 for j in range(5)}
    lines, seen, duplicate = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicate += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicate, len(repeated)]


def test_rule_statistics(spark, sf_dir):
    texts = [*AWKWARD, "a b c d e " * 3, "x\nx\n \n \ny\nx", "# * $% & |<>", "a a a a a a a", *(r.text for r in table(spark, sf_dir, "documents").collect())]
    rows = {r.doc_id: r for r in quality.with_statistics(documents(spark, texts)).collect()}
    for k, t in enumerate(texts):
        want = brute_statistics(t)
        assert [rows[k][c] for c in quality._COUNTS] == want
        assert rows[k].base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_quality_verdicts(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    rows = quality.judge(docs, labels).join(labels, "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)
    assert not any(r.kept and r.base_failed for r in rows)
    few = quality.judge(documents(spark, [prose(1, 40), None]), labels.limit(0)).orderBy("doc_id").collect()
    assert [r.kept for r in few] == [True, False]
    assert quality.judge(docs.limit(0), labels).count() == 0


def walked(forest, x):
    """A row's score, one tree and one node at a time."""
    total = 0.0
    for feature, split, left, depth in zip(forest.feature, forest.split, forest.left, forest.depth, strict=True):
        at = 0
        while feature[at] >= 0:
            at = left[at] + (x[feature[at]] >= split[at])
        total += depth[at]
    return 2.0 ** (-total / len(forest.feature) / forest.scale)


def test_verdicts_against_brute_force(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    forest = quality.fit(quality.with_statistics(docs, keep=["doc_id"]), labels)
    rows = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert np.isfinite(forest.threshold)
    for r in docs.collect():
        counts = brute_statistics(r.text)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        score = walked(forest, quality.statistics(r.text)[1])
        assert abs(rows[r.doc_id].anomaly - score) < 1e-9
        assert rows[r.doc_id].kept == (not failed and score <= forest.threshold)


def test_forest_scores_outliers_higher():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(400, 10)), rng.normal(8, 1, size=(5, 10))])
    scores = quality.grow(x[:400]).scores(x)
    assert scores[400:].min() > np.quantile(scores[:400], 0.95)
    assert quality.calibrate(scores, np.arange(len(x)) < 400) >= scores[:400].max() - 0.1


def test_forest_and_threshold_are_of_all_labelled_rows(spark):
    n = 30_000
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, len(quality.FEATURES))).round(3)
    x[rng.choice(n, 90, replace=False)] += 6  # 0.3 % of the good rows lie apart
    rows = spark.createDataFrame([(k, v, False) for k, v in enumerate(x.tolist())], "doc_id long, features array<double>, base_failed boolean")
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality")
    forest = quality.fit(rows, labels)
    scores = forest.scores(x)
    assert forest.threshold == quality.calibrate(scores, np.ones(n, bool)) == np.sort(scores)[n - 1 - 60]
    drawn = quality.draw(rows.selectExpr("doc_id as _id", "features"), n)
    assert {len(d) for d in drawn} == {quality.TREE_ROWS} and len(drawn) == quality.TREES
    # the trees' rows are their own: far more than any one sample of the first rows
    assert len({tuple(v) for d in drawn for v in d.tolist()}) > 15_000


def test_pipeline_stages_take_effect(spark, sf_dir):
    from test_decontaminate import brute as contaminated
    from test_jaccard import survivors
    from test_native import base_spans

    docs = table(spark, sf_dir, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(kept["language_id"])
    assert sorted(kept["near_dedup"]) == [ids[k] for k in survivors([kept["language_id"][d] for d in ids])]
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    hits = contaminated(list(kept["near_dedup"].values()), items)
    assert set(kept["decontamination"]) == {d for d, h in zip(kept["near_dedup"], hits, strict=True) if not h[1]}
    assert set(kept["personal_data"]) == set(kept["decontamination"])
    assert not any(base_spans(t) for t in kept["personal_data"].values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(kept["personal_data"])


def test_strange_texts_are_rejected_at_every_length(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.fit(docs)
    rng = np.random.default_rng(3)
    letters = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), n))
    polish = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem "
    sizes = (600, 4000, 20_000, 80_000, 400_000)
    texts = [t for n in sizes for t in (letters(n), (polish * (n // 100 + 1))[:n])]
    rows = langid.identify(documents(spark, texts), model, keep=["doc_id"]).collect()
    assert [r.doc_id for r in rows if not r.rejected] == []
    # a very long text in a language that was learned stays
    known = [r.text for r in docs.where("lang = 'en'").orderBy("doc_id").limit(400).collect()]
    long = langid.identify(documents(spark, [" ".join(known)[:n] for n in (80_000, 400_000)]), model, keep=["doc_id"]).collect()
    assert not any(r.rejected for r in long)
