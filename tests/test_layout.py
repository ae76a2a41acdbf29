"""Table geometry, nested DOCX tables and the compatibility fold in their awkward cases."""

import re
import unicodedata

from pyspark.sql import functions as F
from test_files import W, docx

from concord.functions import text as X
from concord.operators import assembly, document_rules, geometry
from concord.plans import layout_queries
from concord.sources import files

BOX = "left double, top double, right double, bottom double"


def laid(spark, words, rulings):
    w = spark.createDataFrame(words, f"page_id int, number int, text string, {BOX}")
    r = spark.createDataFrame(rulings, f"page_id int, table_id int, {BOX}")
    return w, r


def test_words_go_to_the_cell_that_holds_most_of_them(spark):
    rulings = [(1, 0, 0.0, 0.0, 100.0, 20.0), (1, 0, 200.0, 20.0, 100.0005, 0.0), (1, 0, 0.0002, 20.0, 200.0, 40.0), (1, 1, 0.0, 900.0, 500.0, 1500.0), (2, 0, 0.0, 0.0, 10.0, 10.0)]
    words = [
        (1, 0, "b", 50.0, 2.0, 60.0, 8.0),
        (1, 1, "a", 10.0, 2.0, 20.0, 8.0),
        (1, 2, "mostly right", 95.0, 2.0, 120.0, 8.0),
        (1, 3, "swapped", 60.0, 38.0, 10.0, 22.0),
        (1, 4, "point", 150.0, 30.0, 150.0, 30.0),
        (1, 5, "half out", 190.0, 25.0, 210.0, 30.0),
        (1, 6, "out", 300.0, 25.0, 310.0, 30.0),
        (1, 7, None, 5.0, 5.0, 6.0, 6.0),
        (1, 8, "nowhere", None, 5.0, 6.0, 6.0),
        (1, 9, "over tiles", 10.0, 950.0, 480.0, 1400.0),
        (3, 0, "no table", 0.0, 0.0, 1.0, 1.0),
    ]
    w, r = laid(spark, words, rulings)
    got = {(x.page_id, x.table_id, x.row, x.col): x.text for x in geometry.table_cells(w, r).collect()}
    assert got == {(1, 0, 0, 0): "a b", (1, 0, 0, 1): "mostly right", (1, 0, 1, 0): "swapped half out point", (1, 1, 0, 0): "over tiles", (2, 0, 0, 0): ""}
    blocks = sorted((x.page_id, x.pos, x.type, x.text) for x in geometry.page_blocks(w, r).collect())
    assert blocks == [(1, 0, "TABLE", "a b\tmostly right\nswapped half out point"), (1, 1, "PARAGRAPH", "out"), (1, 2, "TABLE", "over tiles"), (2, 0, "TABLE", ""), (3, 0, "PARAGRAPH", "no table")]
    assert geometry.table_cells(w, r.limit(0)).count() == 0 and geometry.table_cells(w.limit(0), r).count() == 5


def test_every_pair_of_boxes_is_met_once(spark):
    import random

    rng = random.Random(4)
    box = lambda size: (x := rng.uniform(-300, 300), y := rng.uniform(-300, 300), x + rng.uniform(0, size), y + rng.uniform(0, size))
    cells = [(k, *box(250)) for k in range(60)]
    words = [(k, *box(40)) for k in range(300)]

    def ratio(a, b):
        shared = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
        return shared / ((a[2] - a[0]) * (a[3] - a[1]))

    want = {}
    for k, *w in words:
        part, cell = max((ratio(w, c), -i) for i, *c in cells)
        if part >= 0.5:
            want[k] = -cell
    c = spark.createDataFrame([(1, i, 0, 0, b) for i, *b in cells], "page_id int, table_id int, row int, col int, box array<double>").withColumn("box", F.struct(*(F.col("box")[k].alias(s) for k, s in enumerate(("left", "top", "right", "bottom")))))
    w, _ = laid(spark, [(1, k, "w", *b) for k, *b in words], [(1, 0, 0.0, 0.0, 1.0, 1.0)])
    got = geometry.place_words(w, c).collect()
    assert {r.number: r.table_id for r in got} == want and len(got) == len(want) > 100


def cell(text, properties=""):
    return f"<w:tc><w:tcPr>{properties}</w:tcPr><w:p><w:r><w:t>{text}</w:t></w:r></w:p></w:tc>"


def test_docx_tables_span_merge_and_nest():
    span, restart, goes_on = '<w:gridSpan w:val="2"/>', '<w:vMerge w:val="restart"/>', "<w:vMerge/>"
    inner = f"<w:tc><w:p/><w:tbl><w:tr>{cell('x')}</w:tr></w:tbl><w:p><w:r><w:t>after</w:t></w:r></w:p></w:tc>"
    skipped = '<w:trPr><w:gridBefore w:val="1"/></w:trPr>'
    body = f"""<w:document {W}><w:body><w:p/><w:tbl><w:tr>{cell('a', span)}{cell('b', restart)}</w:tr><w:tr>{cell('c')}{inner}{cell('lost', goes_on)}</w:tr>
    <w:tr>{skipped}{cell('d')}{cell('also lost', goes_on)}</w:tr><w:tr>{cell('top', goes_on)}</w:tr></w:tbl><w:tbl><w:tr>{cell('z', '<w:gridSpan w:val="no"/>')}</w:tr></w:tbl></w:body></w:document>"""
    rows = files.docx_blocks(body.encode())
    assert [r[1] for r in rows] == ["PARAGRAPH"] + ["TABLE_CELL"] * 11
    got = {(r[3], r[4], r[5]): (r[2], r[6]) for r in rows[1:]}
    want = {(0, 0, 0): "a", (0, 0, 1): "a", (0, 0, 2): "b", (0, 1, 0): "c", (0, 1, 1): "\nafter", (0, 1, 2): "b", (0, 2, 1): "d", (0, 2, 2): "b", (0, 3, 0): "top", (1, 0, 0): "x", (2, 0, 0): "z"}
    assert {k: v[0] for k, v in got.items()} == want
    assert got[1, 0, 0][1] == "0:1:1" and all(v[1] is None for k, v in got.items() if k[0] != 1)
    # the outer table's cells come before those of the table within
    assert [r[3] for r in rows[1:]] == [0] * 9 + [1, 2]


def test_items_of_files(spark, tmp_path):
    head = "".join(cell(h) for h in ("Item", "Descrição", "Qtde", "Unid."))
    body = f"<w:document {W}><w:body><w:tbl><w:tr>{head}</w:tr><w:tr>{cell('1')}{cell('mesa')}{cell('2')}{cell('un')}</w:tr></w:tbl><w:p><w:r><w:t>Item 7 - não conta</w:t></w:r></w:p></w:body></w:document>"
    (tmp_path / "1.docx").write_bytes(docx(body))
    (tmp_path / "2.txt").write_text("ITEM 3: cadeira, qtd estimada = 1.500 un\nLote 4 — sofá\nitem 3 - outra\nItem - nada\n", encoding="utf-8")
    blocks = files.blocks(files.scan(spark, str(tmp_path))).withColumn("document_id", F.regexp_extract("path", r"([0-9])\.\w+$", 1).cast("long"))
    got = sorted((r.document_id, r.item_id, r.description, r.quantity and float(r.quantity), r.unit) for r in assembly.document_items(blocks).collect())
    assert got == [(1, "item-0001", "mesa", 2.0, "UN"), (2, "item-0003", "cadeira, qtd estimada = 1.500 un", 1500.0, "UN"), (2, "item-0004", "sofá", None, None)]
    assert assembly.document_items(blocks.limit(0)).count() == 0


def test_fold_of_every_character(spark):
    def want(text):
        bare = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
        return re.sub(r"\s+", " ", bare).lower().strip()

    # case pairs younger than the JVM's tables are left out, as are Hangul syllables, which stay composed
    young = {0x1C89, 0xA7CB, 0xA7CC, 0xA7DA, 0xA7DC}
    points = [k for k in [*range(1, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE002, 0x10D50), *range(0x1D400, 0x1D800)] if k not in young]
    texts = {k: f"a{chr(k)}B" for k in points} | {-1: "É é ª", -2: "", -3: "plain ASCII  Text"}
    df = spark.createDataFrame(list(texts.items()), "k int, t string")
    got = {r.k: r.f for r in df.select("k", X.fold_spaces(F.col("t")).alias("f")).collect()}
    assert {k: (got[k], want(t)) for k, t in texts.items() if got[k] != want(t)} == {}
    assert spark.range(1).select(X.fold_spaces(F.lit(None).cast("string"))).first()[0] is None


def test_metric_needs_its_boundary(spark):
    rows = [(1, 0, "", None, 0, "PARAGRAPH", "proteção UV50x"), (2, 0, "", None, 0, "PARAGRAPH", "proteção UV 50 total"), (3, 0, "", None, 0, "PARAGRAPH", "UV50 com laudo")]
    blocks = spark.createDataFrame(rows, "document_id long, section int, title string, section_type string, pos int, type string, text string")
    assert [r.document_id for r in document_rules.metrics_without_method(blocks).collect()] == [2]


def equal_files(spark, tmp_path):
    """Orders of two customers whose documents do not differ, and of one whose document does."""
    spark.createDataFrame([(7, 1), (57, 61), (9, 4)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_equal_files_are_stored_once_and_stay_each_customers_own(spark, tmp_path):
    sf_dir = equal_files(spark, tmp_path)
    assert {r.document_id for r in layout_queries.docx_tables(spark, sf_dir).select("document_id").distinct().collect()} == {1, 4, 61}
    documents = layout_queries._documents(spark, sf_dir)
    assert files.store(documents, str(tmp_path / "s")).count() == 2 and files.held(documents, str(tmp_path / "s")).count() == 3


def test_items_of_equal_files(spark, tmp_path):
    items = {(r.document_id, r.item_id, r.quantity) for r in layout_queries.document_items(spark, equal_files(spark, tmp_path)).collect()}
    assert items == {(1, "item-0001", 8.0), (61, "item-0001", 8.0), (4, "item-0001", 10.0)}


def test_processes_of_equal_files_have_all_their_documents(spark, tmp_path):
    rows = layout_queries.process_documents(spark, equal_files(spark, tmp_path)).collect()
    assert {(r.document_id, r.process_id, r.n_items, r.quantity) for r in rows} == {(1, 0, 1, 8.0), (61, 15, 1, 8.0), (4, 1, 1, 10.0)}


def dealt_by(df):
    """What the exchanges of a plan deal rows out by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {re.sub(r"#\d+L?, \d+", "", by) for by in re.findall(r"Exchange (\w+\(.*?\)|\w+)", plan)}


def test_boxes_of_pages_are_not_dealt_out_again(spark, sf_dir):
    assert dealt_by(layout_queries.page_blocks(spark, sf_dir)) == {"hashpartitioning(page_id)"}


def test_cells_of_pages_are_not_dealt_out_again(spark, sf_dir):
    assert dealt_by(layout_queries.table_geometry(spark, sf_dir)) == {"hashpartitioning(page_id)"}
