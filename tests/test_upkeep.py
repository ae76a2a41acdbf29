"""Caches, files, repairs and the catalogue in their awkward cases."""

import hashlib
from datetime import datetime, timedelta

from concord.operators import upkeep

NOON = datetime(2024, 1, 10, 12)


def test_lives_of_answers(spark):
    save = "key string, save_id long, at timestamp, payload string, life double, empty_life double, saved_at string"
    t = lambda s: NOON + timedelta(seconds=s)
    rows = [
        ("a", 1, t(0), "[1]", None, None, "2024-01-10T12:00:00"),
        ("a", 2, t(0), "[2]", 100.0, None, "2024-01-10T12:00:00Z"),
        ("b", 3, t(0), "[]", 1e9, None, "2024-01-10 12:00:00"),
        ("c", 4, t(0), "{bad", None, None, "2024-01-10T12:00:00"),
        ("d", 5, t(0), "7", None, None, "no time"),
        ("e", 6, t(0), "7", None, None, "2024-02-01"),
        ("f", 7, t(-200_000), "7", 1e9, None, "2024-01-08T04:26:40"),
        ("h", 8, t(0), "[]", None, 0.0, "2024-01-10T12:00:00"),
    ]
    asks = [("a", 1, t(99)), ("a", 2, t(100)), ("a", 9, t(-1)), ("b", 3, t(299)), ("b", 4, t(300)), ("c", 5, t(1)), ("d", 6, t(1)), ("e", 7, t(90_000)), ("f", 8, t(0)), ("g", 10, t(0)), ("h", 11, t(0))]
    s, a = spark.createDataFrame(rows, save), spark.createDataFrame(asks, "key string, ask_id long, at timestamp")
    got = {r.ask_id: r.payload for r in upkeep.answers_as_of(s, a).collect()}
    assert got == {1: "[2]", 2: None, 9: None, 3: "[]", 4: None, 5: None, 6: None, 7: "7", 8: "7", 10: None, 11: None}
    endless = {r.ask_id: r.payload for r in upkeep.answers_as_of(s, a, life=None, empty_life=None).collect()}
    assert endless[4] == "[]" and endless[6] is None
    assert upkeep.answers_as_of(s.limit(0), a).where("payload is not null").count() == 0 and upkeep.answers_as_of(s, a.limit(0)).count() == 0


def test_files_against_their_manifest(spark, tmp_path):
    for name, data in {"sound": b"1", "altered": b"2", "short": b"3", "extra": b"4"}.items():
        (tmp_path / f"{name}.bin").write_bytes(data)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    manifest = spark.createDataFrame([("sound", sha(b"1"), 1), ("altered", sha(b"x"), 1), ("short", sha(b"3"), 9), ("gone", sha(b"5"), None), ("nodigest", None, None)], "name string, sha256 string, bytes long")
    (tmp_path / "nodigest.bin").write_bytes(b"6")
    got = {r["name"]: r.status for r in upkeep.revalidated_files(spark, manifest, str(tmp_path), r"([a-z]+)\.bin$").collect()}
    assert got == {"sound": "sound", "altered": "altered", "short": "altered", "gone": "missing", "extra": "unlisted", "nodigest": "unlisted"}


def test_budget_by_utc_day_twice(spark):
    rows = spark.createDataFrame([("2024-01-09T23:30:00-03:00", "5"), ("2024-01-10T02:30Z", "7"), (" 2024-01-10 ", " 1"), ("2024-01-10 23:59:59", "2"), ("2024-13-01", "3"), ("x", None), ("2024-01-11", "-4"), (None, "1")], "day string, used string")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        sums, bad = upkeep.repaired_budget(rows)
        assert [tuple(r) for r in sums.collect()] == [("2024-01-10", "15")]
        assert sorted(r.reason for r in bad.collect()) == ["day", "day", "day; used", "used"]
        again, none = upkeep.repaired_budget(sums)
        assert again.collect() == sums.collect() and none.count() == 0
        cache = spark.createDataFrame([("a", "2024-01-09T23:30:00-03:00", 9.0), ("b", "soon", 9.0), ("c", None, None)], "key string, saved_at string, life double")
        once = upkeep.repaired_cache(cache)
        assert sorted(map(tuple, once.collect())) == [("a", "2024-01-10T02:30:00Z", 9.0), ("b", upkeep.EPOCH, 0.0), ("c", upkeep.EPOCH, 0.0)]
        assert sorted(map(tuple, upkeep.repaired_cache(once).collect())) == sorted(map(tuple, once.collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sync_equals_a_rebuild_and_reads_touched_partitions(spark, tmp_path):
    docs = [(p, 10 * p + k, r) for p in range(40) for k, r in enumerate(("ETP", "TR", "TR") if p % 3 else ("ETP", "TR"))]
    schema, roles, path = "process long, document_id long, role string", ["ETP", "TR"], str(tmp_path / "catalogue")
    upkeep.catalogue_of(spark.createDataFrame(docs, schema), roles, 8).write.partitionBy("bucket").parquet(path)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "catalogue").rglob("*.parquet")}
    after = spark.createDataFrame([d for d in docs if d[0] != 3 and d[1] != 12] + [(99, 990, "ETP"), (99, 991, "TR")], schema)
    changes = spark.createDataFrame([(3,), (1,), (1,), (99,)], "process long")
    found = upkeep.synchronise(spark, after, changes, path, roles, 8)
    rows = {r.process: (r.chain.ETP, r.chain.TR, r.pair, r.complete) for r in found.collect()}
    assert rows.pop(3) == ([], [], False, False)
    assert rows == {r.process: (r.chain.ETP, r.chain.TR, r.pair, r.complete) for r in upkeep.catalogue_of(after, roles, 8).collect()}
    kept = {f for f in files if f.exists() and f.stat().st_mtime_ns == files[f]}
    touched = {r.bucket for r in found.where("process in (1, 3, 99)").select("bucket").distinct().collect()}
    assert {int(f.parent.name.split("=")[1]) for f in files if f not in kept} <= touched and kept
    assert found.count() == len(rows) + 1
