"""Documents of a process put together: items, requirements, fields and sections out of blocks, in one plan.

``blocks`` are the rows of ``concord.sources.files.blocks`` with the document's id
instead of its path; they are written once and read by column for each of the
parts. Items come from a document's tables, or from its prose where its tables give
none; of a process's documents the first of ``binding`` types that has items keeps
them and the others' are dropped.

Defined results: a document without blocks has no parts; null texts are no items
and no fields; an item number that comes again in prose counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions import text as X
from concord.operators import fields as E
from concord.operators.tables import tabular_items

#: Types whose items bind a process, in order (fixed values).
BINDING = ["TR", "ETP"]
#: An item in prose, and its quantity in words of its own (fixed values).
PROSE_ITEM = r"(?iu)^(?:Item|Lote)\s*(\d+)\s*[-–—:]\s*(.+)$"
PROSE_QUANTITY = r"(?iu)\b(?:quantidade|qtd|quant\.?)\s*(?:estimada)?\s*[:=]?\s*(\d+(?:[.,]\d+)?)\s*(unidades?|un|peças?|cx|kg|l)?\b"


def prose_items(blocks: DataFrame) -> DataFrame:
    """document_id, item_id, number, description, quantity, unit, pos of the paragraphs that state an item; the first of each number."""
    said = X.clean_spaces(F.col("text"))
    told = blocks.where(~F.col("type").isin(E.NOT_PROSE)).select("document_id", "pos", F.regexp_extract(said, PROSE_ITEM, 1).try_cast("long").alias("number"), F.trim(F.regexp_extract(said, PROSE_ITEM, 2)).alias("description")).where("number is not null")
    first = told.groupBy("document_id", "number").agg(F.min(F.struct("pos", "description")).alias("m"))
    described = first.select("document_id", F.format_string("item-%04d", "number").alias("item_id"), "number", "m.description", "m.pos")
    quantity = X.quantity(F.nullif(F.regexp_extract("description", PROSE_QUANTITY, 1), F.lit("")))
    unit = F.upper(F.coalesce(F.nullif(F.regexp_extract("description", PROSE_QUANTITY, 2), F.lit("")), F.lit("UN")))
    return described.withColumn("quantity", quantity).withColumn("unit", F.when(F.col("quantity").isNotNull(), unit))


def document_items(blocks: DataFrame) -> DataFrame:
    """document_id, item_id, number, description, quantity, unit: items of tables, of prose only where a document's tables give none."""
    columns = ["document_id", "item_id", "number", "description", F.col("quantity").cast("decimal(20,3)").alias("quantity"), "unit"]
    key = F.struct("document_id", "table_id")
    cells = blocks.where("type = 'TABLE_CELL' and nested_in is null").select(key.alias("table_id"), "row", "col", "text")
    tables = tabular_items(cells).withColumn("document_id", F.col("table_id.document_id")).select(*columns, F.col("table_id.table_id").alias("t"), "row")
    # a number that comes again in a later table keeps the first one's item
    first = tables.groupBy("document_id", "item_id").agg(F.min_by(F.struct("number", "description", "quantity", "unit"), F.struct("t", "row")).alias("m")).select("document_id", "item_id", "m.*")
    prose = prose_items(blocks.where("type = 'PARAGRAPH'")).select(*columns)
    return first.unionByName(prose.join(first.select("document_id").distinct(), "document_id", "left_anti"))


def assemble(blocks: DataFrame, documents: DataFrame, binding: Sequence[str] = BINDING) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, requirements and fields of ``documents`` (document_id, process_id, document_type); ``blocks`` should be written, as it is read once for each."""
    rank = F.array_position(F.array(*map(F.lit, binding)), F.col("document_type"))
    typed = documents.select("document_id", "process_id", "document_type", rank.alias("rank"))
    found = document_items(blocks).join(typed.where("rank > 0"), "document_id")
    binds = found.groupBy("process_id").agg(F.min("rank").alias("rank"))
    items = found.join(binds, ["process_id", "rank"]).select("process_id", "document_id", "document_type", "item_id", "number", "description", "quantity", "unit")
    requirements = E.atomic_requirements(items.select("document_id", "item_id", "description", F.lit(None).cast("array<string>").alias("known")))
    fields = E.document_fields(blocks.where("type = 'PARAGRAPH'").select("document_id", "pos", "type", "text"))
    return items, requirements, fields.join(typed.select("document_id", "process_id", "document_type"), "document_id")
