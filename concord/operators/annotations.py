"""Manual annotations placed in their documents, evidence opened again, the confirmed view at all levels, and a scan for terms.

Every result is rows rather than nested documents: facts and items carry their
process and document, so a document of very many facts is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What each family of document-level terms is called in a block, and how a quantity of time is written (fixed values; case is ignored).
FAMILIES = {
    "DELIVERY_DEADLINE": r"prazo\s+(de\s+)?(entrega|fornecimento|execu)",
    "WARRANTY_TERM": r"garantia|assist[êe]ncia\s+t[ée]cnica|validade",
    "CONTRACT_TERM": r"vig[êe]ncia|vigente|dura[çc][ãa]o\s+do\s+contrato",
    "PAYMENT_DEADLINE": r"prazo\s+(de\s+)?pagamento|pagamento",
}
QUANTIFIED = r"\d+\s*\(?\s*[a-zçãéí ]*\)?\s*(dias?|meses|m[êe]s|anos?)"
CONFIRMED = "CONFIRMED"


def placed(annotations: DataFrame, documents: DataFrame, blocks: DataFrame) -> DataFrame:
    """``annotations`` with document_id, quote, kind, name and error; each row of the input stays.

    annotations: process, role, block, page, item, field_type, attribute and others.
    documents: process, role (the pair unique), document_id, and sha256 beside stored,
    the digest that the file has now. blocks: document_id, block (the pair unique),
    text. kind is field where there is a field_type, else requirement; name is that
    type or attribute; quote is the whole block. error is null or the first of
    document_unknown, digest_differs (or a digest unknown), block_unknown and
    name_missing, with which a row is no fact. Empty annotations give no rows.
    """
    known = documents.select("process", "role", "document_id", F.coalesce(F.col("sha256") == F.col("stored"), F.lit(False)).alias("_same"))
    texts = blocks.select("document_id", "block", F.col("text").alias("quote"), F.lit(True).alias("_found"))
    given = annotations.drop("document_id", "quote", "kind", "name", "error", "_same", "_found")
    joined = given.join(known, ["process", "role"], "left").join(texts, ["document_id", "block"], "left")
    name = F.coalesce("field_type", "attribute")
    error = F.when(F.col("document_id").isNull(), "document_unknown").when(~F.col("_same"), "digest_differs").when(F.col("_found").isNull(), "block_unknown").when(name.isNull(), "name_missing")
    return joined.select(*given.columns, "document_id", "quote", F.when(F.col("field_type").isNotNull(), "field").otherwise("requirement").alias("kind"), name.alias("name"), error.alias("error"))


def annotated_items(facts: DataFrame) -> DataFrame:
    """process, document_id, item, description, block, n_fields and n_requirements of every item that facts name.

    facts: rows of ``placed`` that have no error, with pos, their order. The last
    description that is not empty counts, and the block of the first fact is the
    item's evidence; both combine before the shuffle.
    """
    described = F.nullif("description", F.lit("")).isNotNull()
    return facts.where("item is not null").groupBy("process", "document_id", "item").agg(
        F.max_by(F.when(described, F.col("description")), F.when(described, F.col("pos"))).alias("description"),
        F.min_by("block", "pos").alias("block"),
        F.count_if(F.col("kind") == "field").alias("n_fields"),
        F.count_if(F.col("kind") == "requirement").alias("n_requirements"),
    )


def opened_again(evidence: DataFrame, documents: DataFrame, blocks: DataFrame) -> DataFrame:
    """``evidence`` (document_id, block, page, quote, ...) with outcome, each row judged.

    The outcome is ok or the first of document_unknown, block_unknown, bad_page (not 1
    or more) and quote_absent (also a null quote or text); an empty quote stands in
    every text. documents: document_id; blocks: document_id, block, text; all unique.
    """
    held = documents.select("document_id", F.lit(True).alias("_document"))
    texts = blocks.select("document_id", "block", F.col("text").alias("_text"), F.lit(True).alias("_block"))
    given = evidence.drop("outcome", "_document", "_text", "_block")
    joined = given.join(held, "document_id", "left").join(texts, ["document_id", "block"], "left")
    outcome = F.when(F.col("_document").isNull(), "document_unknown").when(F.col("_block").isNull(), "block_unknown").when(~F.coalesce(F.col("page") >= 1, F.lit(False)), "bad_page").when(~F.coalesce(F.contains("_text", F.col("quote")), F.lit(False)), "quote_absent").otherwise("ok")
    return joined.select(*given.columns, outcome.alias("outcome"))


def opened_share(judged: DataFrame, least: float = 0.95) -> DataFrame:
    """process, total, ok, share (four decimals) and passed (at least ``least``) of every process, from ``opened_again``."""
    rows = judged.groupBy("process").agg(F.count("*").alias("total"), F.count_if(F.col("outcome") == "ok").alias("ok"))
    return rows.select("*", F.round(F.col("ok") / F.col("total"), 4).alias("share"), (F.col("ok") >= F.lit(least) * F.col("total")).alias("passed"))


def confirmed_export(documents: DataFrame, sections: DataFrame, items: DataFrame, facts: DataFrame, findings: DataFrame) -> DataFrame:
    """The confirmed view as rows: process, document_id, item, level, id and value.

    documents (process, document_id), sections (those, id) and findings (process, id)
    all stay. facts: process, document_id, item (null: of the document), kind (field or
    requirement), id, value and status, of which confirmed ones stay. items: process,
    document_id, item and evidence (boolean): an item stays with evidence of its own or
    a confirmed fact. A null status or evidence counts as none; rows that repeat stay.
    """
    none = F.lit(None).cast("string")
    kept = facts.where(F.col("status") == CONFIRMED)
    own = F.coalesce("evidence", F.lit(False))
    by_facts = items.where(~own).join(kept.where("item is not null").select("process", "document_id", "item"), ["process", "document_id", "item"], "left_semi")

    def rows(df: DataFrame, level: str | Column, id_: str, value: Column = none, document: Column | None = None, item: Column = none) -> DataFrame:
        return df.select("process", (F.col("document_id") if document is None else document).alias("document_id"), item.cast("string").alias("item"), (F.lit(level) if isinstance(level, str) else level).alias("level"), F.col(id_).cast("string").alias("id"), value.cast("string").alias("value"))

    out = rows(documents, "document", "document_id")
    out = out.unionByName(rows(sections, "section", "id")).unionByName(rows(findings, "finding", "id", document=none))
    for held in (items.where(own), by_facts):
        out = out.unionByName(rows(held, "item", "item", item=F.col("item")))
    return out.unionByName(rows(kept, F.col("kind"), "id", F.col("value"), item=F.col("item")))


def term_scan(blocks: DataFrame) -> DataFrame:
    """Blocks that name a family of terms and a quantity of time, with families (in their order, comma-joined) and body (text, white space squeezed); a null text has none."""
    # Unicode's digits and white space count as well
    text = F.col("text")
    families = F.array_compact(F.array(*(F.when(text.rlike(f"(?iU){p}"), name) for name, p in FAMILIES.items())))
    found = blocks.where(text.rlike(f"(?iU){QUANTIFIED}")).withColumn("families", F.array_join(families, ","))
    return found.where("families <> ''").withColumn("body", F.trim(F.regexp_replace("text", r"(?U)\s+", " ")))
