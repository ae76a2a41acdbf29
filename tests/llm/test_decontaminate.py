import hashlib
import re
import tracemalloc

import pyarrow as pa
import pytest
from helpers import AWKWARD, documents, prose

from concord.llm import decontaminate
from concord.session import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items):
    windows = {}
    for i, t in items:
        w = words(t)
        if i is None or not w:
            continue
        for k in range(max(1, len(w) - 9)):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if (x := windows.get(tuple(w[k : k + m]))) is not None:
                    hit.update(range(k, k + m))
                    found |= x
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


def run(spark, docs, bench, **more):
    rows = decontaminate.find_passages(docs, bench, keep=["doc_id"], **more).withColumn("d", decontaminate.items_digest()).collect()
    return {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), r.d) for r in rows}


@pytest.mark.parametrize("block", [200_000, 7])
def test_against_brute_force(spark, block):
    items = [(k, prose(1000 + k, n)) for k, n in enumerate([30, 10, 9, 3, 1, 25, 12])] + [(10, None), (None, "x y z"), (11, ""), (5, prose(77, 14)), (12, "winter")]
    texts = [*AWKWARD, items[0][1], "Foo " + items[1][1].upper() + "! bar", prose(1, 300) + " " + items[5][1][:90] + " " + prose(2, 40) + ", " + items[2][1].replace(" ", "--"), prose(3, 5), items[3][1], prose(9, 3000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert run(spark, documents(spark, texts), bench, block_windows=block) == dict(enumerate(brute(texts, items)))


def test_given_tables(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = docs.orderBy("doc_id").collect()
    want = brute([r.text for r in rows], [(r.item_id, r.text) for r in bench.collect()])
    assert run(spark, docs, bench) == {r.doc_id: w for r, w in zip(rows, want, strict=True)}
    assert sum(w[1] > 0 for w in want) > 0


def test_a_worker_holds_little_at_once():
    """A scan's arrays are those of a small run of rows, however large the batch."""
    items = [(k, prose(k, 40)) for k in range(30)]
    search = decontaminate.WindowSearch(decontaminate.windows_of((str(k), " ".join(words(t)).encode()) for k, t in items))
    texts = [prose(100 + k, 200) + items[k % 30][1] for k in range(1000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": texts})
    tracemalloc.start()
    found = pa.Table.from_batches(decontaminate._scanner([type("Held", (), {"value": search})], "text", ["doc_id"])(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert batch.nbytes > 1.5e6 and most < 30e6
    assert found["_n_words"].to_pylist() == [len(words(t)) for t in texts] and all(found["_items"].to_pylist())


def test_no_second_pool_of_workers(spark, monkeypatch):
    """The blocks' offsets reach the JVM without an RDD of Python rows, which has workers of its own."""
    bench = spark.createDataFrame([(k, prose(k, 30)) for k in range(9)], "item_id long, text string")
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *_: pytest.fail("an RDD of Python rows"))
    blocks = decontaminate.in_blocks(bench, "item_id", "text", windows=50)
    monkeypatch.undo()
    assert blocks.count() == 9 and blocks.select("block").distinct().count() > 2


def test_empty_tables_and_clashing_columns(spark):
    docs, bench = documents(spark, ["a b c", "d"]), spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert run(spark, docs.limit(0), bench) == {}
    assert run(spark, docs, bench.limit(0))[0][:3] == (3, 0, 0)
    clash = docs.selectExpr("doc_id", "text", "1 as n_words", "2 as items", "3 as _runs")
    kept = decontaminate.drop_contaminated(clash, bench)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.collect()] == [1]


def test_query_against_sql(spark):
    import duckdb

    from concord.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    found = con.execute(queries.ORACLES["op1_decontamination"])
    names = [d[0] for d in found.description]
    want = sorted(found.fetchall())
    rows = queries.op1_decontamination(spark, sf_dir)
    assert sorted(rows.columns) == sorted(names)
    assert sorted(tuple(r) for r in rows.select(*names).collect()) == want
