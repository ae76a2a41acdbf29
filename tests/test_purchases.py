"""Purchases' records, refusals and initial contracts in their awkward cases."""

import pytest
from pyspark.sql import functions as F

from concord.functions import records as N
from concord.operators import classify as C
from concord.operators import relational as R

NUMBER = "12345678000199-1-000007/2024"


def test_purchases_of_records(spark):
    names = ["numeroControlePNCP", "anoCompra", "sequencialCompra", "createdAt", "orgao_nome", "objeto"]
    rows = [
        (NUMBER, None, None, None, "", None, ("9", "Town")),
        (f" {NUMBER} ", "2024", " 7 ", "2025-01-02T10:00:00Z", "Plain", "x", (None, "Town")),
        ("", None, None, None, None, None, None),
        (None, None, None, None, None, None, None),
        (NUMBER + "0", None, None, None, None, None, None),
        (NUMBER, "", None, None, None, None, None),
        (NUMBER, "2023", None, None, None, None, None),
        (NUMBER, None, "7.0", None, None, None, None),
        (NUMBER, None, "8", None, None, None, None),
        (NUMBER, None, None, "", None, None, None),
        (NUMBER, None, None, "2024-02-30", None, None, None),
    ]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], ", ".join(f"{n} string" for n in names).join(["k int, ", ", orgaoEntidade struct<cnpj: string, razaoSocial: string>"]))
    fields = [*names, "orgaoEntidade.cnpj", "orgaoEntidade.razaoSocial"]
    got = [r.x for r in df.select("k", N.purchase(F.struct(*names, "orgaoEntidade"), fields, "feed", "b", lambda c: F.upper(c)).alias("x")).orderBy("k").collect()]
    assert [x.invalid_reason for x in got] == [None, None, "no_number", "no_number", "bad_number", "bad_year", "other_year", "bad_seq", "other_seq", "bad_date", "bad_date"]
    assert len(got[0]) == 33 and (got[0].org, got[0].org_name, got[0].object, got[0].year, got[0].seq) == ("9", "Town", "", 2024, 7)
    assert (got[1].control_number, got[1].org, got[1].org_name, got[1].category, got[1].detail_url) == (NUMBER, "12345678000199", "Plain", "X", "b/consulta/v1/orgaos/12345678000199/compras/2024/7")
    assert all(v is None for x in got[2:] for v in list(x)[1:])


def test_refusals_in_both_modes(spark):
    rows = [
        (1, " m", "1", "1", "Lei 14.133/2021", "6", "Aquisição de mesas"),
        (2, None, "1", "1", "Lei 14.133/2021", "6", "Aquisição de mesas"),
        (3, "F", None, None, None, None, None),
        (4, "F", "2", "x", "Lei 14.133", "8", "Aquisição"),
        (5, "E", "x", "2", "Lei 14.133", "8", "Aquisição"),
        (6, "E", "1", "1", "Lei 8.666", "8", "Serviços"),
        (7, "E", "1", "1", "Lei 8.666", "6", "Serviços"),
    ]
    df = spark.createDataFrame(rows, "k int, sphere string, i string, a string, b string, m string, o string")
    reason = lambda early, **more: C.refusal(*(F.col(c) for c in ("sphere", "i", "a", "b", "m", "o")), F.lit(False), early, **more)
    got = df.select("k", reason(True).alias("p"), reason(False).alias("s"), reason(True, spheres=["m "]).alias("one")).orderBy("k").collect()
    assert [r.p for r in got] == [None, "sphere", None, "instrument", "article", "mode", "object"]
    assert [r.s for r in got] == [None, "sphere", "instrument", "instrument", "instrument", "profile", "profile"]
    assert [r.one for r in got] == [None] + ["sphere"] * 6
    for wrong in ([], ["X"], ["F", "X"], [" "]):
        with pytest.raises(ValueError):
            reason(True, spheres=wrong)


def test_initial_contracts(spark):
    rows = [("a", 1, "Contrato", 2), ("a", None, "CONTRATO (Termo Inicial)", 1), ("a", 7, "Empenho", 0), ("b", 7, "Empenho", 5), ("b", None, None, 4), (None, 1, None, 1)]
    df = spark.createDataFrame(rows, "purchase string, code int, name string, day int").withColumn("initial", C.initial_contract(F.col("code"), F.col("name")))
    got = R.initial_candidates(df, "purchase", "initial", ["day"], F.col("day"))
    assert sorted((r.purchase, r.day, r.initial, r.place) for r in got.collect()) == [("a", 1, True, 1), ("a", 2, True, 2), ("b", 4, False, 1)]
    assert R.initial_candidates(df.limit(0), "purchase", "initial", ["day"], F.col("day")).count() == 0


def test_running_sums_over_buckets(spark):
    rows = [(k % 3 or None, k, (k * 7) % 5) for k in range(60)]
    df = spark.createDataFrame(rows, "key int, at int, v long")
    span = F.floor(F.col("at") / 4)
    keyed = {r.at: (r.s, r.n) for r in R.running_sums(df, ["key"], ["at"], {"s": F.col("v"), "n": F.lit(1)}, [span, F.floor(span / 3)]).collect()}
    whole = {r.at: r.s for r in R.running_sums(df, [], ["at"], {"s": F.col("v")}, [span, F.floor(span / 3)]).collect()}
    for key, at, _ in rows:
        mine = [v for k, a, v in rows if k == key and a < at]
        assert keyed[at] == (sum(mine), len(mine)) and whole[at] == sum(v for _, a, v in rows if a < at)
    assert R.running_sums(df.limit(0), [], ["at"], {"s": F.col("v")}, [span]).count() == 0
