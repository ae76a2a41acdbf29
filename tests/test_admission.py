"""Collections that stop and go on, against a loop over the candidates in order."""

import random
from datetime import date

from concord.streaming import admission


def by_hand(rows, target, budget=None, cap=5, attempts=3):
    """One run, candidate by candidate."""
    settled, wins, fails, out, used, won, stopped = set(), {}, {}, {}, 0, 0, False
    for page, place, owner, process, contract, outcome, detail, files in sorted(rows):
        if process in settled:
            continue
        if outcome in ("usable", "unusable") and (wins.get(owner, 0) >= cap or fails.get(owner, 0) >= attempts):
            status = "owner_limit"
        else:
            status = {"usable": "accepted", "unusable": "failed"}.get(outcome, outcome)
        cost = detail + (files if status in ("accepted", "failed") else 0)
        stopped = stopped or won >= target or (budget is not None and used + cost > budget)
        out[process, contract] = "pending" if stopped else status
        if stopped:
            continue
        used, won = used + cost, won + (status == "accepted")
        wins[owner] = wins.get(owner, 0) + (status == "accepted")
        fails[owner] = fails.get(owner, 0) + (status == "failed")
        if status in ("accepted", "out_of_scope", "owner_limit"):
            settled.add(process)
    return out, used, won


def candidates(n, seed):
    pick = random.Random(seed)
    places = pick.sample(range(400 * n), n)
    # one owner holds a third of the processes
    return [(p // 3, p % 3, f"o{max(0, k % 9 - 2)}", f"p{k % (n // 2)}-{k % 9}", f"c{k}", pick.choices(["usable", "unusable", "out_of_scope", "error"], [5, 3, 2, 1])[0], 1, 2) for k, p in enumerate(places)]


def test_decisions_equal_those_of_a_loop(spark):
    owners = spark.createDataFrame([], admission.OWNERS)
    for seed, target, budget in ((1, 10**6, None), (2, 12, None), (3, 10**6, 90), (4, 0, 0)):
        rows = candidates(240, seed)
        got = {(r.process, r.contract): r.status for r in admission.decide(spark.createDataFrame(rows, admission.CANDIDATE), owners, target, budget, 6, 4).collect()}
        want, _, _ = by_hand(rows, target, budget, 6, 4)
        assert {k: s for k, s in got.items() if s != "skipped"} == want and len(got) == len(rows)


def test_interrupted_runs_equal_one(spark, tmp_path):
    rows = [r for r in candidates(300, 7) if r[5] != "error"]
    frame = lambda part: spark.createDataFrame(part, admission.CANDIDATE)
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    frame(rows).write.parquet(whole)
    want, summary = admission.collect(spark, whole, f"{whole}-log", f"{whole}-at", date(2024, 1, 1), 20)
    edge = sorted(rows)[150][0]
    frame([r for r in rows if r[0] < edge]).write.parquet(parts)
    at = lambda day, **more: admission.collect(spark, parts, f"{parts}-log", f"{parts}-at", date(2024, 1, day), 20, **more)
    _, first = at(1, daily=65)
    assert [(r.run, r.stopped, r.used <= 60) for r in first.collect()] == [(0, "budget", True)]
    _, second = at(1, daily=65)
    assert second.agg({"used": "sum"}).first()[0] <= 60
    frame([r for r in rows if r[0] >= edge]).write.mode("append").parquet(parts)
    at(2, daily=105)
    got, runs = at(3)
    told = lambda df: sorted((r.process, r.contract, r.status) for r in df.collect())
    assert told(got) == told(want) and runs.agg({"accepted": "sum"}).first()[0] == summary.first().accepted == 20
    assert {r.stopped for r in runs.where("run = 3").collect()} == {"target"}
    again, _ = at(4)
    assert told(again) == told(got)


def test_awkward_candidates(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [(1, 1, "o", "p", None, "usable", None, None), (1, 2, "o", "p", None, "usable", 1, 2), (None, 1, "o", "q", "c", "usable", 1, 2), (1, 3, None, "q", "c", "usable", 1, 2), (1, 4, "o", "r", "c", None, 1, 2), (2, 1, "o", "s", "c", "odd", 1, 2)]
    spark.createDataFrame(rows[:0], admission.CANDIDATE).write.parquet(path)
    none, runs = admission.collect(spark, path, f"{path}-log", f"{path}-at", date(2024, 1, 1), 9)
    assert none.count() == 0 and [(r.used, r.accepted, r.stopped) for r in runs.collect()] == [(0, 0, None)]
    spark.createDataFrame(rows, admission.CANDIDATE).write.mode("append").parquet(path)
    got, _ = admission.collect(spark, path, f"{path}-log", f"{path}-at", date(2024, 1, 1), 9)
    assert sorted((r.process, r.status, r.cost) for r in got.collect()) == [("p", "accepted", 0), ("r", "error", 1), ("s", "error", 1)]


def test_of_equal_contracts_at_one_place_the_same_one_stays_in_any_order(spark):
    rows = [(1, 8, "o", "p", "c", outcome, 1, 2, 0) for outcome in ("usable", "unusable", "error")]
    stay = [admission._sound(spark.createDataFrame(order, admission.LANDED).coalesce(1)).collect() for order in (rows, rows[::-1])]
    assert [[r.outcome for r in s] for s in stay] == [["error"], ["error"]]
