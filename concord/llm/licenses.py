"""License scans by diagonal voting, in DataFrame operations only.

Every rolling word trigram of a text is hashed and joined with the trigrams of
the license templates (a broadcast table of fixed size: the texts and notices
below, or the caller's own). A match votes for the diagonal doc position -
template position of its template; a hash match is a vote only if the three words
are equal. Votes are the distinct template places met on a diagonal. Neighbouring
diagonals (words put in or left out) are merged, and a merged span is verified: it
counts when its distinct template places are enough of the template's, and the
words that they cover in the text are enough of the span's.

Phrases are templates too: a phrase stands at a place exactly when all of its
trigrams vote for one diagonal. Their labels always stay; other templates add
theirs from COVERAGE on, and never by a single trigram.

Before a text's trigrams leave its row, those whose hash no template has are
dropped by a bit table, so that only likely votes are joined. Only documents'
ids, sizes and votes are shuffled. Defined results: null texts are empty; texts
of fewer than three words have no votes; repeated rows come out as often as they
went in; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions.text import bound_once

#: Phrases and their labels (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices of well-known licenses (fixed values), as words; a label may have several.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "cc-by-nc": "licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "licensed under a creative commons attribution sharealike 4 0 international license",
    "gpl": "under the terms of the gnu general public license as published by the free software foundation",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
#: Whole license texts without their names and years (fixed values), as words.
TEXTS = {
    "mit": """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
 files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish
 distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the
 following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the
 software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of
 merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any
 claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software
 or the use or other dealings in the software""",
    "isc": """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
 the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all
 warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be
 liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether
 in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software""",
    "bsd": """redistribution and use in source and binary forms with or without modification are permitted provided that the following
 conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the
 documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is
 and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular
 purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary
 or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business
 interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise
 arising in any way out of the use of this software even if advised of the possibility of such damage""",
    "apache-2": """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you
 may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software
 distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the
 license for the specific language governing permissions and limitations under the license""",
    "gpl": """this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as
 published by the free software foundation either version of the license or at your option any later version this program is distributed in
 the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular
 purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with
 this program""",
    "unlicense": """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell
 or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means""",
}
GRAM = 3
#: Share of a template's trigrams that must vote, and share of a span's words that they must cover.
COVERAGE, DENSITY = 0.8, 0.5
#: Diagonals at most so far apart are one span.
NEIGHBOUR = 2
#: Bits of the table of template hashes.
BITS = 1 << 16
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def templates(spark: SparkSession, phrases: dict[str, str] = PHRASES, *more: dict[str, str]) -> DataFrame:
    """label, words, base: the phrases, and texts by label."""
    rows = [(label, words, True) for words, label in phrases.items()]
    rows += [(label, " ".join(words.split()), False) for texts in (more or (NOTICES, TEXTS)) for label, words in texts.items()]
    return spark.createDataFrame(rows, "label string, words string, base boolean")


def template_grams(found: DataFrame) -> DataFrame:
    """A row per template trigram: its hash, words and place, and the template's number, label, size and kind."""
    number = F.row_number().over(_by_words(found))
    split = found.select(number.alias("template"), "label", "base", F.split("words", " ").alias("w")).where(F.size("w") >= GRAM)
    grams = split.select("template", "label", "base", F.size("w").alias("template_words"), "w", F.explode(F.sequence(F.lit(0), F.size("w") - GRAM)).alias("place"))
    words = [F.get("w", F.col("place") + k).alias(f"t{k}") for k in range(GRAM)]
    return grams.select("template", "label", "base", "template_words", "place", *words).withColumn("hash", F.xxhash64(*(f"t{k}" for k in range(GRAM))))


def _by_words(found: DataFrame):
    from pyspark.sql import Window

    # templates are a fixed list of some dozen rows, not data
    return Window.orderBy("label", "base", "words")


def votes(documents: DataFrame, grams: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct places by document, template and diagonal; each document also has a row without template that counts its copies."""
    # at most BITS / 64 numbers, whatever the templates
    set_bits = [0] * (BITS // 64)
    for r in grams.select(F.pmod("hash", F.lit(BITS)).cast("int").alias("bit")).distinct().collect():
        set_bits[r["bit"] // 64] |= 1 << r["bit"] % 64
    bits = F.array(*(F.lit(b - (1 << 64) if b >> 63 else b) for b in set_bits))
    gram = "struct<at:int,hash:bigint,w0:string,w1:string,w2:string>"

    def likely(w: Column) -> Column:
        def kept(x: Column) -> Column:
            bit = F.pmod(x["hash"], F.lit(BITS)).cast("int")
            return F.call_function("shiftright", F.get(bits, F.shiftright(bit, 6)), bit.bitwiseAND(63)).bitwiseAND(1) == 1

        at = F.when(F.size(w) >= GRAM, F.sequence(F.lit(0), F.size(w) - GRAM)).otherwise(F.array().cast("array<int>"))
        hashed = F.transform(at, lambda i: F.struct(i.alias("at"), F.xxhash64(*(F.get(w, i + k) for k in range(GRAM))).alias("hash")))
        found = F.transform(F.filter(hashed, kept), lambda x: F.struct(x["at"].alias("at"), x["hash"].alias("hash"), *(F.get(w, x["at"] + k).alias(f"w{k}") for k in range(GRAM))))
        # the first entry is null, so that every document keeps a row
        return F.struct(F.size(w).cast("long").alias("n_words"), F.concat(F.array(F.lit(None).cast(gram)), found).alias("grams"))

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("_key"), bound_once(words_of(text), likely).alias("x"))
    each = rows.select("doc_id", "_key", "x.n_words", F.explode("x.grams").alias("g")).select("doc_id", "_key", "n_words", "g.*")
    joined = each.join(F.broadcast(grams), "hash", "left")
    same = F.lit(True)
    for k in range(GRAM):
        same &= F.col(f"w{k}") == F.col(f"t{k}")
    cast = joined.where(F.col("at").isNull() | (F.col("template").isNotNull() & same))
    return cast.groupBy("doc_id", "_key", "n_words", "template", "label", "base", "template_words", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.count("*").alias("rows"), F.collect_set("place").alias("places"))


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", found: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, n_words, places (of phrases: label, start), spans (label, start, end, coverage, density)."""
    spark = documents.sparkSession
    entry = F.struct("template", "diagonal", "label", "base", "template_words", "places")
    grams = template_grams(templates(spark) if found is None else found)
    voted = votes(documents, grams, doc_id, text)
    voted = voted.groupBy("doc_id", "_key", "n_words").agg(F.max(F.when(F.col("template").isNull(), F.col("rows"))).alias("copies"), F.array_sort(F.collect_list(F.when(F.col("template").isNotNull(), entry))).alias("m"))
    n = F.size("m")
    index = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    apart = lambda i: (i == 0) | (F.get("m", i)["template"] != F.get("m", i - 1)["template"]) | (F.get("m", i)["diagonal"] - F.get("m", i - 1)["diagonal"] > NEIGHBOUR)
    cut = voted.withColumn("begin", F.filter(index, apart))
    part = lambda s, k: F.slice("m", s + 1, F.coalesce(F.get("begin", k + 1), n) - s)

    def span(s: Column, k: Column) -> Column:
        def measured(rows: Column) -> Column:
            theirs = F.size(F.array_distinct(F.flatten(F.transform(rows, lambda x: x["places"]))))
            # the text's words that the voting trigrams cover
            at = F.flatten(F.transform(rows, lambda x: F.transform(x["places"], lambda p: p + x["diagonal"])))
            mine = F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(p, p + GRAM - 1))))
            start, end = F.array_min(mine), F.array_max(mine) + 1
            of = F.get("m", s)
            return F.struct(
                of["label"].alias("label"),
                start.alias("start"),
                end.alias("end"),
                (theirs / (of["template_words"] - (GRAM - 1))).alias("coverage"),
                (F.size(mine) / (end - start)).alias("density"),
                theirs.alias("grams"),
            )

        return bound_once(part(s, k), measured)

    exact = F.filter("m", lambda x: x["base"] & (F.size(x["places"]) == x["template_words"] - (GRAM - 1)))
    places = F.transform(exact, lambda x: F.struct(x["label"].alias("label"), x["diagonal"].cast("long").alias("start")))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    spans = F.transform("begin", span).alias("spans")
    return cut.select("doc_id", "n_words", places.alias("places"), spans, "copies").select("doc_id", "n_words", "places", "spans", each.alias("_copy")).drop("_copy")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def license_labels(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", coverage: float = COVERAGE, density: float = DENSITY, found: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score (the best verified coverage) of every document."""
    scanned = scan(documents, doc_id, text, found)
    base = F.transform("places", lambda p: p["label"])
    starts = F.transform("places", lambda p: p["start"])
    verified = F.filter("spans", lambda s: (s["density"] >= density) & (s["grams"] > 1))
    more = F.transform(F.filter(verified, lambda s: s["coverage"] >= coverage), lambda s: s["label"])
    best = F.coalesce(F.array_max(F.transform(verified, lambda s: s["coverage"])), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _joined(base).alias("base_labels"),
        _joined(F.concat(base, more)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )
