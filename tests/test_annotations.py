"""Annotations and evidence with missing parts, the confirmed view of items, scans, inspections; nulls, repeats and empty tables."""

from pyspark.sql import functions as F

from concord.operators import annotations as A
from concord.operators import review as V

ANN = "process string, role string, block string, page int, item string, field_type string, attribute string, value int, description string, pos int, quote string"
DOCS, BLOCKS = "process string, role string, document_id string, sha256 string, stored string, text string", "document_id string, block string, text string, process string"


def test_placed_names_what_is_missing(spark):
    rows = [
        ("p", "TR", "b1", 1, "i1", "QUANTITY", None, 5, "", 1, "an extra column"),
        ("p", "TR", "b1", 1, "i1", None, "size", 6, "a chair", 2, None),
        ("p", "TR", "b1", 1, "i1", None, "size", 6, None, 3, None),
        ("p", "TR", "b1", 1, "i1", None, None, 6, None, 4, None),
        ("p", "TR", "b9", 1, "i1", "QUANTITY", None, 5, None, 5, None),
        ("p", "TR", None, 1, None, "QUANTITY", None, 5, None, 6, None),
        ("p", "ETP", "b1", 1, None, "QUANTITY", None, 5, None, 7, None),
        ("q", "TR", "b1", 1, None, "QUANTITY", None, 5, None, 8, None),
        (None, None, None, None, None, None, None, None, None, 9, None),
    ]
    annotations = spark.createDataFrame(rows, ANN)
    documents = spark.createDataFrame([("p", "TR", "p:tr", "aa", "aa", "x"), ("p", "ETP", "p:etp", "aa", "bb", "x"), ("r", "TR", "r:tr", None, None, None)], DOCS)
    blocks = spark.createDataFrame([("p:tr", "b1", "Quantidade: 5", "p"), ("p:etp", "b1", None, None)], BLOCKS)
    placed = A.placed(annotations.unionByName(annotations.where("pos = 1")), documents, blocks)
    got = {r.pos: r for r in placed.collect()}
    assert placed.count() == 10
    assert {k: r.error for k, r in got.items()} == {1: None, 2: None, 3: None, 4: "name_missing", 5: "block_unknown", 6: "block_unknown", 7: "digest_differs", 8: "document_unknown", 9: "document_unknown"}
    assert (got[1].quote, got[1].kind, got[1].name, got[2].kind, got[2].name) == ("Quantidade: 5", "field", "QUANTITY", "requirement", "size")
    (item,) = A.annotated_items(placed.where("error is null")).collect()
    assert (item.item, item.description, item.block, item.n_fields, item.n_requirements) == ("i1", "a chair", "b1", 2, 2)
    assert A.placed(annotations.limit(0), documents, blocks).count() == 0
    assert A.placed(annotations, documents.limit(0), blocks).where("error <> 'document_unknown'").count() == 0


def test_evidence_is_opened_again(spark):
    documents = spark.createDataFrame([("d", 1)], "document_id string, outcome int")
    blocks = spark.createDataFrame([("d", "b", "thirty (30) days"), ("d", "n", None)], "document_id string, block string, text string")
    rows = [("d", "b", 1, "(30)", "ok"), ("d", "b", 1, "", "ok"), ("d", "b", 1, "31", "quote_absent"), ("d", "b", 1, None, "quote_absent"), ("d", "n", 1, "x", "quote_absent"), ("d", "b", 0, "(30)", "bad_page"), ("d", "b", None, "(30)", "bad_page"), ("d", "c", 0, "x", "block_unknown"), ("e", "b", 1, "(30)", "document_unknown"), (None, None, None, None, "document_unknown")]
    evidence = spark.createDataFrame([(*r[:4], "p", r[4]) for r in rows], "document_id string, block string, page int, quote string, process string, want string")
    judged = A.opened_again(evidence, documents, blocks)
    assert judged.count() == 10 and judged.where("outcome <> want").count() == 0
    share = A.opened_share(judged, 0.2).first()
    assert (share.total, share.ok, share.share, share.passed) == (10, 2, 0.2, True)
    assert A.opened_share(judged.limit(0)).count() == 0


def test_the_confirmed_view_keeps_items_with_evidence_or_a_confirmed_fact(spark):
    documents = spark.createDataFrame([("p", "d"), ("p", "empty")], "process string, document_id string")
    sections = spark.createDataFrame([("p", "d", "s1")], "process string, document_id string, id string")
    findings = spark.createDataFrame([("p", "f1")], "process string, id string")
    items = spark.createDataFrame([("p", "d", "sure", False), ("p", "d", "shown", True), ("p", "d", "neither", None), ("p", "other", "sure", None)], "process string, document_id string, item string, evidence boolean")
    facts = [("p", "d", "sure", "field", "v1", "5", "CONFIRMED"), ("p", "d", "sure", "requirement", "v2", "6", "REJECTED"), ("p", "d", "neither", "field", "v3", "7", None), ("p", "d", "shown", "field", "v4", "8", "EXTRACTED"), ("p", "d", None, "requirement", "v5", None, "CONFIRMED")]
    facts = spark.createDataFrame(facts, "process string, document_id string, item string, kind string, id string, value string, status string")
    got = sorted((r.level, r.id, r.item or "") for r in A.confirmed_export(documents, sections, items, facts, findings).collect())
    assert got == [("document", "d", ""), ("document", "empty", ""), ("field", "v1", "sure"), ("finding", "f1", ""), ("item", "shown", "shown"), ("item", "sure", "sure"), ("requirement", "v5", ""), ("section", "s1", "")]
    assert A.confirmed_export(*(t.limit(0) for t in (documents, sections, items, facts, findings))).count() == 0


def test_terms_need_a_family_and_a_quantity_of_time(spark):
    texts = ["PRAZO DE ENTREGA:  10\n(dez) DIAS", "Vigência e garantia: 12 meses", "garantia", "10 dias", "VIGÊNCIA DE 2 ANOS", "", None, "x" * 50000 + " pagamento em ٣ dias"]
    blocks = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "id int, text string, families string")
    got = {r.id: (r.families, r.body) for r in A.term_scan(blocks).collect()}
    assert {k: v[0] for k, v in got.items()} == {0: "DELIVERY_DEADLINE", 1: "WARRANTY_TERM,CONTRACT_TERM", 4: "CONTRACT_TERM", 7: "PAYMENT_DEADLINE"}
    assert got[0][1] == "PRAZO DE ENTREGA: 10 (dez) DIAS" and len(got[7][1]) == 50020


def test_the_latest_inspection_decides(spark):
    candidates = spark.createDataFrame([(n, i) for i, n in enumerate(["done", "again", "new", None, "new"])], "number string, status int")
    seen = [("done", "PRONTO", 1), ("done", "LIMITE_ORGAO", 2), ("again", "LIMITE_ORGAO", 1), ("again", "SEM_CADEIA", 2), (None, "LIMITE_ORGAO", 1)]
    got = V.inspected_anew(candidates, spark.createDataFrame(seen, "number string, status string, at int")).collect()
    assert sorted(r.number or "" for r in got) == ["", "again", "new", "new"] and set(got[0].asDict()) == {"number", "status"}


def test_recognised_text_must_be_traced(spark):
    rows = [(True, True, " " + "A" * 64, "1", "pt", 5, None), (True, True, "a" * 63, "1", "pt", 5, None), (True, True, "a" * 64, " ", "pt", 5, None), (True, True, "a" * 64, "1", None, 5, None), (True, True, "a" * 64, "1", "pt", 0, None), (True, True, "a" * 64, "1", "pt", 5, True), (None, True, "a" * 64, "1", "pt", 5, None), (True, None, "a" * 64, "1", "pt", 5, None)]
    df = spark.createDataFrame(rows, "o boolean, u boolean, s string, v string, l string, c int, n boolean")
    assert [r[0] for r in df.select(V.recognition_usable(*(F.col(c) for c in "ousvlcn"))).collect()] == [True] + [False] * 7
