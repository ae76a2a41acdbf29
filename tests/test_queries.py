"""Every query with SQL against DuckDB, and the operators' awkward cases."""

import math

import duckdb
import pytest

from concord.plans import annotation_queries, catalogue_queries, document_queries, extraction_queries, findings_queries, gate_queries, layout_queries, purchase_queries, record_queries, registry, review_queries, text_queries, upkeep_queries  # noqa: F401
from concord.streaming import admission, leases, resume, upserts  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    return round(float(v), 4) if isinstance(v, float) or hasattr(v, "as_tuple") else v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, sf_dir, oracle, name):
    df = registry.QUERIES[name](spark, sf_dir)
    cursor = oracle.execute(registry.ORACLES[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    want = sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
    assert sorted(repr([plain(r[c]) for c in columns]) for r in df.collect()) == want


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_fold_and_parse(spark):
    from pyspark.sql import functions as F

    from concord.functions import text as X

    rows = [("  Ótima  São-Paulo\n", "R$ 1.234,56"), ("", "1.500"), (None, None), ("x", "no digits")]
    got = spark.createDataFrame(rows, "t string, m string").select(X.fold_spaces(F.col("t")), X.fold_alnum(F.col("t")), X.slug(F.col("t")), X.money(F.col("m")).cast("double"), X.quantity(F.col("m")).cast("double")).collect()
    assert tuple(got[0]) == ("otima sao-paulo", "otima sao paulo", "otima-sao-paulo", 1234.56, 1234.0)
    assert tuple(got[1]) == ("", "", "untitled", 1.5, 1500.0)
    assert tuple(got[2]) == (None, None, "untitled", None, None)
    assert got[3][3] is None and got[3][4] is None


def test_item_matching_stages(spark):
    from concord.operators.rules import match_items

    schema = "pair_id long, item_id string, number int, pos int"
    left = spark.createDataFrame([(1, "a", 1, 1), (1, "b", 1, 2), (1, "c", None, 3), (2, "d", 7, 1), (3, "e", 1, 1), (3, "f", 2, 2)], schema)
    right = spark.createDataFrame([(1, "x", 1, 1), (1, "y", 9, 2), (1, "z", 8, 3), (2, "w", None, 1), (3, "v", 5, 1)], schema)
    assert sorted(tuple(r) for r in match_items(left, right).collect()) == [(1, "a", "x", "number"), (1, "b", "y", "position"), (1, "c", "z", "position"), (2, "d", "w", "sole")]
    assert match_items(left.limit(0), right).count() == 0


def test_reuse_kinds(spark):
    from concord.operators.reuse import reuse_marks

    words = [chr(97 + i // 26) + chr(97 + i % 26) + "x" for i in range(400)]
    docs = [(1, " ".join(words[:200])), (2, " ".join(words[:200])), (3, " ".join(words[:199])), (4, " ".join(words[50:120])), (5, " ".join(words[100:300])), (6, None), (7, "short")]
    got = {(r.kind, r.doc_id, r.other_id) for r in reuse_marks(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {("near_identical", 1, 1), ("near_identical", 3, 1), ("contained_in", 4, 1), ("contained_in", 4, 3)} <= got
    assert not any(2 in g or 6 in g or 7 in g for g in got) and math.isclose(len(got), len(set(got)))


def test_a_cluster_of_near_copies_gives_a_row_each(spark):
    from concord.operators.reuse import reuse_marks

    words = [chr(97 + i // 26) + chr(97 + i % 26) + "x" for i in range(600)]
    rows = [(k, " ".join([*words[:300], *(["other"] if k else []), words[300 + k]])) for k in range(120)]
    got = reuse_marks(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.kind, r.doc_id, r.other_id) for r in got) == [("near_identical", k, 0) for k in range(120)]
    assert reuse_marks(spark.createDataFrame(rows[:1], "doc_id long, text string")).count() == 0


def test_record_functions(spark):
    from pyspark.sql import functions as F

    from concord.functions import records as N

    rows = [("2 anos", ">= 10", " 1500.00", None), ("18 Meses", "azul", "Preto ", " Inativo"), ("7", "<5", "-0.50", "1"), (None, None, None, ""), ("nunca", "> x", "100", "Não")]
    df = spark.createDataFrame(rows, "d string, c string, v string, a string")
    got = df.select(N.months(F.col("d")).alias("m"), N.comparison(F.col("c")).alias("o"), N.canonical_value(F.col("v")).alias("v"), N.active(F.col("a")).alias("a")).collect()
    assert [r.m for r in got] == [24, 18, 7, None, None]
    assert [(r.o.operator, r.o.operand) for r in got] == [(">=", "10"), ("=", "azul"), ("<", "5"), ("=", None), (">", "x")]
    assert [r.v for r in got] == ["1500", "preto", "-0.5", None, "100"]
    assert [r.a for r in got] == [True, False, True, True, False]
    roman = spark.range(0, 18).select(N.roman(F.col("id").cast("int")).alias("r")).collect()
    assert [roman[i].r for i in (0, 1, 4, 15, 16)] == [None, "I", "IV", "XV", None]
    empty = spark.createDataFrame([(None,), (" {} ",), ("[]",), ("[1]",), ("x",), ('{"a": {}}',), ('{"a": {}, "b": 1}',), ('{"data": null, "b": 1}',), ("[ [ ], 7 ]",), ('["", 7]',), ("0",), ("false",)], "p string").select(N.is_empty_payload(F.col("p")).alias("e")).collect()
    assert [r.e for r in empty] == [True, True, True, False, False, True, False, True, True, False, False, False]


def test_gap_clusters(spark):
    from concord.operators.relational import gap_clusters

    rows = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 9.0), (1, 9.0), (2, 5.0), (2, None)], "o int, v double")
    assert sorted(((r.o, r.v, r.cluster) for r in gap_clusters(rows, "o", "v", 3.0).collect()), key=str) == sorted([(1, 1.0, 0), (1, 2.0, 0), (1, 9.0, 1), (1, 9.0, 1), (2, 5.0, 0), (2, None, 0)], key=str)
    assert gap_clusters(rows.limit(0), "o", "v", 3.0).count() == 0


def test_tabular_items(spark):
    from concord.operators.tables import tabular_items

    tables = {
        1: [["Edital", "x", None], ["Item nº", "Descrição", "Qtde", "Unid."], ["1", "mesa", "1.500", "un"], ["1", "cadeira", "2,5", "a unit name that is long"], ["", "item 7 lamp", "0", "cx"], ["TOTAL", "9 soma", "1", "cx"], ["3", "", "1", "cx"]],
        2: [["4", "desk", "3", "1.234,50"]],
        3: [["5", "only"]],
    }
    cells = [(t, r, c, x) for t, rows in tables.items() for r, row in enumerate(rows) for c, x in enumerate(row)]
    df = spark.createDataFrame(cells, "table_id long, row int, col int, text string")
    got = sorted((r.table_id, r.item_id, r.description, r.quantity and float(r.quantity), r.unit, r.unit_price and float(r.unit_price)) for r in tabular_items(df).collect())
    assert got == [(1, "item-0001", "mesa", 1500.0, "UN", None), (1, "item-0001-02", "cadeira", 2.5, "UN", None), (1, "item-0003", "1", 1.0, "CX", None), (1, "item-0007", "item 7 lamp", None, None, None), (2, "item-0004", "desk", 3.0, "UN", 1234.5), (3, "item-0005", "only", None, None, None)]
    assert tabular_items(df.limit(0)).count() == 0


def test_numbers_go_on_over_buckets(spark):
    from pyspark.sql import functions as F

    from concord.operators.relational import numbered

    rows = [(k % 3 or None, k, f"v{k}") for k in range(40)]
    df = spark.createDataFrame(rows, "key int, at int, v string")
    got = numbered(df, ["key"], ["at"], F.floor(F.col("at") / 7), "n", ("v", "before")).collect()
    want, seen = [], {}
    for key, at, v in rows:
        mine = seen.setdefault(key, [])
        want.append((key, at, v, len(mine) + 1, mine[-1] if mine else None))
        mine.append(v)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert numbered(df.limit(0), ["key"], ["at"], F.lit(1), "n").count() == 0


def test_shingles_are_digests_of_words_digests(spark):
    from pyspark.sql import functions as F

    from concord.functions import text as X

    texts = {"a": "x y z x y z", "b": "x y", "c": "xy z x y z q", "d": ""}
    made = spark.createDataFrame(list(texts.items()), "id string, text string").select("id", X.shingles(F.split("text", " "), 3).alias("s"))
    assert "array_join" not in made._jdf.queryExecution().optimizedPlan().toString()
    found = {r.id: set(r.s) for r in made.collect()}
    # of xyz, yzx, zxy and xy-z-x, zxy, xyz, yzq what is equal word by word
    assert {k: len(v) for k, v in found.items()} == {"a": 3, "b": 0, "c": 4, "d": 0} and len(found["a"] & found["c"]) == 2


def test_a_list_of_both_sides_computes_the_marks_once(spark, sf_dir):
    plan = text_queries.reuse_symmetric_list(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    marks = text_queries.reuse_marks(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == marks.count("Join ") > 0
