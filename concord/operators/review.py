"""Review state from an event log, derived-text caches and the acceptance of recognised text.

The state is a fold of events: nothing is updated in place, and a replay of the log
gives the same state. Events that break a precondition are refused and listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONFIRM, EDIT, REJECT = "CONFIRM", "EDIT_AND_CONFIRM", "REJECT"
#: States of an inspection that need no other one (fixed values).
REUSABLE = ["SEM_PAR_ETP_TR", "FORA_DO_ESCOPO", "LIMITE_ORGAO", "DOWNLOAD_REPROVADO"]
#: Least characters, words and confidence of recognised text (fixed values).
LEAST_CHARS, LEAST_WORDS, LEAST_CONFIDENCE = 40, 8, 40


def review_state(targets: DataFrame, events: DataFrame, blocks: DataFrame) -> DataFrame:
    """target, status, value, quote, pos, n_events and n_refused, a row per target.

    targets: target, document_id, value, quote (its evidence, null without). events:
    target, seq (their order), action, value, quote. A confirmation asks for evidence,
    an edit for a quote that stands in a block of the target's document (document_id,
    pos, text), which becomes the evidence, at the first such block; others are
    refused. The last accepted event decides the status; values come from edits alone.
    """
    known = targets.select("target", "document_id", F.col("value").alias("first_value"), F.col("quote").alias("first_quote"))
    joined = events.join(known.select("target", "document_id", "first_quote"), "target")
    edits = joined.where(F.col("action") == EDIT).select("target", "seq", "document_id", F.trim("quote").alias("q")).where("q <> ''")
    anchored = edits.join(blocks.select("document_id", "pos", "text"), "document_id").where(F.contains("text", F.col("q"))).groupBy("target", "seq").agg(F.min("pos").alias("pos"))
    placed = joined.join(anchored, ["target", "seq"], "left")
    has_evidence = F.coalesce(F.col("first_quote"), F.lit("")) != ""
    accepted = F.when(F.col("action") == EDIT, has_evidence & F.col("pos").isNotNull()).when(F.col("action") == CONFIRM, has_evidence).otherwise(F.col("action") == REJECT)
    judged = placed.withColumn("accepted", accepted)
    last = lambda c, when: F.max_by(F.when(when, F.col(c)), F.when(when, F.col("seq")))
    edited = F.col("accepted") & (F.col("action") == EDIT)
    folded = judged.groupBy("target").agg(
        last("action", F.col("accepted")).alias("action"),
        last("value", edited & F.col("value").isNotNull()).alias("new_value"),
        last("quote", edited).alias("new_quote"),
        last("pos", edited).alias("pos"),
        F.count("*").alias("n_events"),
        F.count_if(~F.col("accepted")).alias("n_refused"),
    )
    out = known.join(folded, "target", "left")
    status = F.when(F.col("action").isNull(), "EXTRACTED").when(F.col("action") == REJECT, "REJECTED").otherwise("CONFIRMED")
    none = F.lit(0).cast("long")
    return out.select("target", status.alias("status"), F.coalesce("new_value", "first_value").alias("value"), F.coalesce(F.trim("new_quote"), "first_quote").alias("quote"), "pos", F.coalesce("n_events", none).alias("n_events"), F.coalesce("n_refused", none).alias("n_refused"))


def derived_key(sha256: Column, language: Column, version: Column, settings: Column) -> Column:
    """The key of a derived text: its source's digest, language, program version and settings (JSON text, sorted keys); null if one is unusable."""
    digest, lang, program = F.lower(F.trim(sha256)), F.lower(F.trim(language)), F.trim(version)
    sound = digest.rlike("^[0-9a-f]{64}$") & (lang != "") & (program != "") & settings.startswith("{")
    return F.when(sound, F.sha2(F.to_json(F.array(digest, lang, program, settings)), 256))


def cached_texts(cache: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (key, ...) with the cached text of its key, null where there is none or its digest is not the one kept.

    cache: key, text, text_sha256, at; the latest sound row of a key counts.
    """
    sound = cache.where(F.sha2("text", 256) == F.col("text_sha256"))
    return asked.join(sound.groupBy("key").agg(F.max_by("text", "at").alias("text")), "key", "left")


def recognised_reasons(text: Column, confidence: Column, original: Column) -> Column:
    """Why recognised text does not replace a page's original: array of reasons, empty if it does."""
    words = lambda t: F.size(F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    chars = lambda t: F.length(F.trim(F.regexp_replace(t, r"\s+", " ")))
    new, old = F.coalesce(text, F.lit("")), F.coalesce(original, F.lit(""))
    valid = confidence.between(0, 100)
    return F.array_compact(
        F.array(
            F.when(chars(new) < LEAST_CHARS, "few_chars"),
            F.when(words(new) < LEAST_WORDS, "few_words"),
            F.when(~F.coalesce(valid, F.lit(False)), "bad_confidence"),
            F.when(valid & (confidence < LEAST_CONFIDENCE), "low_confidence"),
            F.when(chars(new) < chars(old), "fewer_chars_than_before"),
            F.when(words(new) < words(old), "fewer_words_than_before"),
        )
    )


def recognition_usable(opened: Column, used: Column, text_sha256: Column, version: Column, language: Column, characters: Column, needs_ocr: Column) -> Column:
    """Recognised text that can be audited: digest, program version and language are known, and the document opened with text."""
    traced = F.lower(F.trim(text_sha256)).rlike("^[0-9a-f]{64}$") & (F.trim(version) != "") & (F.trim(language) != "")
    return F.coalesce(opened & used & traced & (characters > 0) & ~F.coalesce(needs_ocr, F.lit(False)), F.lit(False))


def inspected_anew(candidates: DataFrame, inspections: DataFrame) -> DataFrame:
    """``candidates`` (number, ...) but those whose latest inspection (number, status, at) is in a state that needs no other one.

    A later inspection in another state opens the candidate again; a candidate that was
    never inspected, or whose number is null, stays.
    """
    last = inspections.groupBy("number").agg(F.max_by("status", "at").alias("status"))
    return candidates.join(last.where(F.col("status").isin(REUSABLE)).select("number"), "number", "left_anti")


def process_id(control_number: Column) -> Column:
    return F.replace(control_number, F.lit("/"), F.lit("-"))


def document_id(process: Column, role: Column, seq: Column, place: Column) -> Column:
    """process#role-nn: the number of the document, else its place, of two digits at least."""
    n = F.coalesce(seq.cast("long"), place.cast("long")).cast("string")
    return F.concat(process, F.lit("#"), F.lower(role), F.lit("-"), F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n))


def page_of(block_id: Column, default: Column) -> Column:
    """The page in a block's id (...:p-0001:...), else the default."""
    return F.coalesce(F.nullif(F.regexp_extract(block_id, ":p-([0-9]+):", 1), F.lit("")).try_cast("int"), default)
