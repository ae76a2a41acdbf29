"""A corpus pipeline of five stages over ``documents``; each works on what the one before kept.

Defined results of every stage: null texts are empty ones, which language ID keeps
(there is nothing to reject) and near_dedup links with each other; rows that repeat
an id or a text are judged each; null ids come last where the smallest id stays; an
empty table gives no rows; other columns come through as they are. Stages raise a
ValueError that names the column where doc_id, text or lang is missing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from concord.llm import decontaminate, jaccard, langid, packing, pii
from concord.session import scratch, table, written

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the language model rejects."""
    return langid.drop_rejected(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group of texts linked by a five-word Jaccard similarity of 0.8 or more."""
    return jaccard.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a benchmark window occurs."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences; a row per piece."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: The stages learn, tokenise and pack; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as folders:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
            folders.discard(docs)
    return docs
