"""Tables of pages and files: the given tables are laid out as boxes or DOCX files and read back; their SQL reads the columns directly."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.functions import text as X
from concord.operators import assembly, geometry
from concord.operators import document_rules as D
from concord.plans.registry import query
from concord.session import fresh_path, table, written
from concord.sources import files

#: Lines of a partition of pages, each of which becomes eleven boxes.
_PAGE_LINES = 50_000
_LINE_AT = "l_linenumber, l_partkey, l_suppkey, l_quantity"
_ROWS = f"select l_orderkey::bigint as page_id, row_number() over (partition by l_orderkey order by {_LINE_AT}) - 1 as row, l_linenumber, l_partkey, l_quantity, l_returnflag from lineitem"
_CELLS = """select page_id, row, 0 as col, 'linha ' || l_linenumber as text from r union all select page_id, row, 1, 'peça ' || l_partkey || ' nova' from r
 union all select page_id, row, 2, l_quantity::int::varchar from r union all select page_id, row, 3, case l_returnflag when 'N' then '' else l_returnflag end from r"""


def _pages(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Words and rulings: an order is a page, its lines the rows of a table of four columns whose edges are a little off; titles and notes lie outside."""
    at = Window.partitionBy("page_id").orderBy(*_LINE_AT.split(", "))
    given = table(spark, sf_dir, "lineitem")
    # lines and orders are dealt out by page before they become many boxes, and stay there
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), given.count() // _PAGE_LINES + 1)
    dealt = lambda df, key, *columns: df.select(F.col(key).cast("long").alias("page_id"), *columns).repartition(parts, "page_id")
    lines = dealt(given, "l_orderkey", *_LINE_AT.split(", "), "l_returnflag").withColumn("row", F.row_number().over(at) - 1).drop("l_suppkey")
    width, height, top = 100, 20, 90
    off = (F.col("l_partkey") % 7) * 1e-5
    y = F.col("row") * height + top

    def box(left, upper, right, lower):
        return [v.cast("double").alias(c) if isinstance(v, Column) else F.lit(float(v)).alias(c) for c, v in (("left", left), ("top", upper), ("right", right), ("bottom", lower))]

    rulings = lines.select("page_id", F.lit(0).alias("table_id"), F.inline(F.array(*(F.struct(*box(F.lit(width * c) + off, y + off, F.lit(width * (c + 1)), y + height)) for c in range(4)))))
    # the second word of a cell comes first, the third column's is only mostly in its cell, the fourth's has no area
    word = lambda k, text, *b: F.struct((F.col("row") * 10 + k).alias("number"), text.alias("text"), *box(*b))
    words = [
        word(0, F.col("l_linenumber").cast("string"), 40, y + 2, 60, y + 12),
        word(1, F.lit("linha"), 5, y + 2, 30, y + 12),
        word(2, F.lit("peça"), 105, y + 2, 130, y + 12),
        word(3, F.col("l_partkey").cast("string"), 132, y + 2, 160, y + 12),
        word(4, F.lit("nova"), 105, y + 12.5, 130, y + 19),
        word(5, F.col("l_quantity").cast("int").cast("string"), 240, y + 2, 310, y + 12),
        word(6, F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")), 350, y + 5, 350, y + 5),
    ]
    laid = lines.select("page_id", F.inline(F.array(*words))).where("text is not null")
    orders = dealt(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_orderstatus")
    title = orders.select("page_id", F.lit(-1).alias("number"), F.concat(F.lit("pedido "), "o_orderstatus").alias("text"), *box(0, 10, 200, 30))
    note = orders.where("o_custkey % 2 = 0").select("page_id", F.lit(-2).alias("number"), F.lit("nota").alias("text"), *box(395, 5000, 500, 5010))
    return laid.unionByName(title).unionByName(note), rulings


@query(f"with r as ({_ROWS}) select page_id, row::bigint as row, col::bigint as col, text from ({_CELLS})")
def table_geometry(spark, sf_dir):
    """Cells of the pages' tables, empty ones too."""
    return geometry.table_cells(*_pages(spark, sf_dir)).select("page_id", "row", "col", "text")


@query(f"""with r as ({_ROWS}), c as ({_CELLS}), l as (select page_id, row, string_agg(text, chr(9) order by col) as line from c group by all),
 b as (select o_orderkey::bigint as page_id, 1 as place, 'PARAGRAPH' as type, 'pedido ' || o_orderstatus as text from orders union all select page_id, 2, 'TABLE', string_agg(line, chr(10) order by row) from l group by page_id
 union all select o_orderkey, 3, 'PARAGRAPH', 'nota' from orders where o_custkey % 2 = 0)
 select page_id, (row_number() over (partition by page_id order by place) - 1)::bigint as pos, type, text from b""")
def page_blocks(spark, sf_dir):
    """A page's title, table and note in reading order; the table's words are no paragraphs."""
    return geometry.page_blocks(*_pages(spark, sf_dir)).select("page_id", "pos", "type", "text")


@F.pandas_udf(T.BinaryType())
def _zipped(xml: pd.Series) -> pd.Series:
    def one(text: str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            # a member of one time, so that equal texts are equal files whenever they are made
            member = zipfile.ZipInfo("word/document.xml")
            member.compress_type = zipfile.ZIP_DEFLATED
            archive.writestr(member, text)
        return out.getvalue()

    return xml.map(one)


_BODY = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>'


def _paragraph(text: Column) -> Column:
    return F.concat(F.lit("<w:p><w:r><w:t>"), text, F.lit("</w:t></w:r></w:p>"))


def _cell(text: Column, properties: Column | str = "") -> Column:
    return F.concat(F.lit("<w:tc><w:tcPr>"), F.lit(properties) if isinstance(properties, str) else properties, F.lit("</w:tcPr>"), _paragraph(text), F.lit("</w:tc>"))


_HEAD = ["Item", "Descrição", "Qtde", "Unid."]


def _order_rows(spark, sf_dir) -> DataFrame:
    """A customer's orders numbered; two that follow each other share a description."""
    at = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long").alias("customer"), "o_orderkey", F.row_number().over(at).alias("k"))
    told = F.struct("k", "o_orderkey")
    return rows.groupBy("customer").agg(F.array_sort(F.collect_list(told)).alias("rows"))


def _documents(spark, sf_dir) -> DataFrame:
    """A DOCX per customer: TR with a table (a spanned heading row, descriptions merged over two rows, a nested table) or items in prose, and a clause on delivery."""
    kind = F.col("customer") % 3
    row = lambda x: F.concat(
        F.lit("<w:tr>"),
        _cell(x["k"].cast("string")),
        _cell(F.concat(F.lit("bem "), F.floor((x["k"] - 1) / 2).cast("string"), F.lit(" de 220 V")), F.when(x["k"] % 2 == 1, '<w:vMerge w:val="restart"/>').otherwise("<w:vMerge/>")),
        _cell((x["o_orderkey"] % 50 + 1).cast("string")),
        _cell(F.lit("cx")),
        F.lit("</w:tr>"),
    )
    nested = F.concat(F.lit("<w:tr><w:tc><w:tcPr/><w:p/><w:tbl><w:tr>"), _cell(F.lit("9")), _cell(F.lit("não é item")), _cell(F.lit("5")), _cell(F.lit("1")), F.lit('</w:tr></w:tbl></w:tc><w:tc><w:tcPr><w:gridSpan w:val="3"/></w:tcPr><w:p/></w:tc></w:tr>'))
    grid = F.concat(F.lit("<w:tbl><w:tr>"), _cell(F.lit("LOTE UM"), '<w:gridSpan w:val="4"/>'), F.lit("</w:tr><w:tr>"), *(_cell(F.lit(h)) for h in _HEAD), F.lit("</w:tr>"), F.array_join(F.transform("rows", row), ""), nested, F.lit("</w:tbl>"))
    prose = F.array_join(F.transform("rows", lambda x: _paragraph(F.concat(F.lit("Item "), x["k"].cast("string"), F.lit(" – mesa, quantidade: "), (x["o_orderkey"] % 50 + 1).cast("string"), F.lit(" peças")))), "")
    clause = _paragraph(F.concat(F.lit("O prazo de entrega "), (F.col("customer") % 60 + 1).cast("string"), F.lit(" dias corridos")))
    body = F.concat(F.lit(_BODY), _paragraph(F.lit("1. DO OBJETO")), F.when(kind == 0, prose).otherwise(grid), F.when(kind != 1, clause).otherwise(""), F.lit("</w:body></w:document>"))
    return _order_rows(spark, sf_dir).select(F.concat(F.col("customer").cast("string"), F.lit(".docx")).alias("name"), _zipped(body).alias("content"))


def _stored_blocks(spark, sf_dir) -> DataFrame:
    """The documents written to the store by digest, told by content and read as blocks; equal files are stored once and are each customer's own."""
    path, documents = fresh_path(spark, "documents"), _documents(spark, sf_dir)
    files.store(documents, path).agg(F.count("*")).first()
    held = files.told(files.held(documents, path).withColumn("path", F.col("name")))
    return files.blocks(held).withColumn("document_id", F.regexp_extract("path", "^([0-9]+)", 1).cast("long"))


_NUMBERED = "select o_custkey::bigint as document_id, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as k from orders"


@query(f"""with o as ({_NUMBERED}), n as (select document_id, max(k) as n from o group by 1), t as (select * from o where document_id % 3 > 0)
 select document_id, 0 as table_id, row::bigint as row, col::bigint as col, text, null as nested_in from (select document_id, 0 as row, unnest([0, 1, 2, 3]) as col, 'LOTE UM' as text from n where document_id % 3 > 0
 union all select document_id, 1, unnest([0, 1, 2, 3]), unnest(['Item', 'Descrição', 'Qtde', 'Unid.']) from n where document_id % 3 > 0
 union all select document_id, k + 1, unnest([0, 1, 2, 3]), unnest([k::varchar, 'bem ' || ((k - 1) // 2) || ' de 220 V', (o_orderkey % 50 + 1)::varchar, 'cx']) from t
 union all select document_id, n + 2, unnest([0, 1, 2, 3]), '' from n where document_id % 3 > 0)
 union all select document_id, 1, 0, unnest([0, 1, 2, 3]), unnest(['9', 'não é item', '5', '1']), '0:' || (n + 2) || ':0' from n where document_id % 3 > 0""")
def docx_tables(spark, sf_dir):
    """Cells of the DOCX files' tables: spans filled, merged cells repeated, the nested table on its own."""
    cells = _stored_blocks(spark, sf_dir).where("type = 'TABLE_CELL'")
    return cells.select("document_id", "table_id", "row", "col", "text", "nested_in")


_ITEMS = f"""o as ({_NUMBERED}), items as (select document_id, 'item-' || lpad(k::varchar, 4, '0') as item_id, case when document_id % 3 = 0 then 'mesa, quantidade: ' || (o_orderkey % 50 + 1) || ' peças' else 'bem ' || ((k - 1) // 2) || ' de 220 V' end as description,
 (o_orderkey % 50 + 1)::double as quantity, case when document_id % 3 = 0 then 'PEÇAS' else 'CX' end as unit from o)"""


@query(f"with {_ITEMS} select document_id, item_id, description, quantity, unit from items")
def document_items(spark, sf_dir):
    """Items of DOCX files: of their tables, or of their prose where they have none."""
    found = assembly.document_items(_stored_blocks(spark, sf_dir))
    return found.select("document_id", "item_id", "description", F.col("quantity").cast("double").alias("quantity"), "unit")


@query(f"""with {_ITEMS}, d as (select distinct document_id, document_id // 4 as process_id, case document_id % 4 when 0 then 'TR' when 1 then 'ETP' when 2 then 'EDITAL' else 'ETP' end as t, case document_id % 4 when 0 then 1 when 2 then null else 2 end as rank from o),
 b as (select process_id, min(rank) as rank from d group by 1), i as (select i.*, d.process_id from items i join d using (document_id) join b on b.process_id = d.process_id and b.rank = d.rank)
 select d.process_id::bigint as process_id, d.document_id, d.t as document_type, count(i.item_id)::bigint as n_items, count(case when d.document_id % 3 > 0 then i.item_id end)::bigint as n_requirements, coalesce(sum(i.quantity), 0)::double as quantity,
 case when d.document_id % 3 <> 1 then d.document_id % 60 + 1 end::double as deadline, case when d.document_id % 3 = 1 then 'ADVISORY-003' else '' end as findings from d left join i on i.document_id = d.document_id group by all""")
def process_documents(spark, sf_dir):
    """Files to items, requirements, fields and findings in one plan; a document's blocks are read from files once and written."""
    blocks = written(_stored_blocks(spark, sf_dir).drop("path", "kind", "error"), "blocks")
    kind = F.element_at(F.array(*map(F.lit, ("TR", "ETP", "EDITAL", "ETP"))), (F.col("document_id") % 4 + 1).cast("int"))
    documents = blocks.select("document_id").distinct().select("document_id", F.floor(F.col("document_id") / 4).alias("process_id"), kind.alias("document_type"))
    items, requirements, fields = assembly.assemble(blocks, documents)
    late = D.delivery_deadline_missing(blocks.where("type = 'PARAGRAPH'"), fields.select("document_id", "field", "value")).withColumn("findings", F.lit("ADVISORY-003"))
    counted = items.groupBy("document_id").agg(F.count("*").alias("n_items"), F.sum("quantity").alias("quantity"))
    required = requirements.groupBy("document_id").agg(F.count("*").alias("n_requirements"))
    deadlines = fields.where("field = 'DELIVERY_DEADLINE'").select("document_id", F.col("value").cast("double").alias("deadline"))
    joined = documents.join(counted, "document_id", "left").join(required, "document_id", "left").join(deadlines, "document_id", "left").join(late, "document_id", "left")
    return joined.select("process_id", "document_id", "document_type", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_requirements", F.lit(0)).alias("n_requirements"), F.coalesce(F.col("quantity").cast("double"), F.lit(0.0)).alias("quantity"), "deadline", F.coalesce("findings", F.lit("")).alias("findings"))


_SIGNS = "ＦＵＬＬ ﬁm nº 1ª x² Ⅳ ½ Ǆ ﷺ ẛ̣"


@query(f"""select doc_id, md5(trim(regexp_replace(lower(strip_accents(text)), '\\s+', ' ', 'g')) || ' full fim no 1a x2 iv 1⁄2 dz صلى الله عليه وسلم s') as folded from documents where text is not null""")
def unicode_fold(spark, sf_dir):
    """Whole texts with their accents taken apart and compatibility characters added, folded."""
    apart = F.replace(F.replace("text", F.lit("é"), F.lit("é")), F.lit("ü"), F.lit("ü"))
    rows = table(spark, sf_dir, "documents").where("text is not null")
    return rows.select("doc_id", F.md5(X.fold_spaces(F.concat(apart, F.lit(f" {_SIGNS}")))).alias("folded"))
