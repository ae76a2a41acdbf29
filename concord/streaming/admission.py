"""A resumable collection that stops: candidates are admitted in order under a target, a daily budget and limits per owner.

Pages of candidates land as files and are taken up by a stream. A run then decides
the open candidates in their order (page, place):

* a process that a usable contract, its scope or a limit has settled is passed over,
  as is a contract that comes again or has failed before;
* an owner with ``cap`` accepted processes or ``attempts`` failed ones gets no more;
* the run ends where ``target`` processes are accepted or the day's budget, less a
  margin, does not hold the next candidate's whole cost. What is left stays pending.

A candidate's decision depends on earlier ones only, so it is computed without the
stop, by running sums over buckets of the order, and the stop cuts off a prefix:
runs that are interrupted decide what one run would. Candidates with an error stay
open for the next run, unless their process is settled by then. Every run writes its decisions, open candidates and owners to
its own folders and its summary last; a run without one is done again over them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from concord.operators.relational import keep_first, running_sums
from concord.plans.registry import query
from concord.session import fresh_path, scratch, table, written

#: What a candidate must hold; outcome is usable, unusable, out_of_scope or error.
CANDIDATE = "page long, place long, owner string, process string, contract string, outcome string, detail_cost long, files_cost long"
LANDED = f"{CANDIDATE}, batch long"
JUDGED = f"{LANDED}, status string, cost long, stop string"
SUMMARY = "run int, day string, used long, accepted long, stopped string, covered long"
OWNERS = "owner string, accepted long, attempts long"
MARGIN, CAP, ATTEMPTS = 5, 5, 3
PARTS, FANOUT = 64, 4096
AT = ["page", "place"]


def decide(rows: DataFrame, owners: DataFrame, target: int, budget: int | None, cap: int = CAP, attempts: int = ATTEMPTS) -> DataFrame:
    """Each open candidate's status and cost: accepted, failed, out_of_scope, owner_limit, error, skipped or pending.

    ``owners`` holds what earlier runs accepted and failed; ``target`` and ``budget``
    (null: none) are what is left for this run. Null costs are nothing; an outcome that
    is none of the four counts as an error. Candidates share no place.
    """
    known = ["usable", "unusable", "out_of_scope"]
    rows = rows.withColumn("outcome", F.when(F.col("outcome").isin(known), F.col("outcome")).otherwise("error"))
    at, wins, fails = F.struct(*AT), F.col("outcome") == "usable", F.col("outcome") == "unusable"
    ends = rows.where("outcome in ('usable', 'out_of_scope')").groupBy("process").agg(F.min(at).alias("_end"))
    live = rows.join(ends, "process", "left").withColumnRenamed("_end", "_settled").withColumn("_late", F.coalesce(at > F.col("_settled"), F.lit(False)))
    counted = {"_wins": (wins & ~F.col("_late")).cast("long"), "_fails": (fails & ~F.col("_late")).cast("long")}
    span = F.floor(F.col("page") / 64)
    # written in between, as what follows reads each of these several times
    live = running_sums(written(live, "live"), ["owner"], AT, counted, [span, F.floor(span / FANOUT)])
    live = live.join(owners.withColumnsRenamed({"accepted": "_accepted", "attempts": "_attempts"}), "owner", "left")
    full = (F.col("_wins") + F.coalesce("_accepted", F.lit(0)) >= cap) | (F.col("_fails") + F.coalesce("_attempts", F.lit(0)) >= attempts)
    live = written(live.withColumn("_limited", ~F.col("_late") & (wins | fails) & full), "limited")
    # a limit settles its process as well
    limits = live.where("_limited").groupBy("process").agg(F.min(at).alias("_end"))
    live = live.join(limits, "process", "left").withColumn("_settled", F.least("_settled", "_end")).withColumn("_late", F.coalesce(at > F.col("_settled"), F.lit(False)))
    status = F.when(F.col("_late"), "skipped").when(F.col("_limited"), "owner_limit").when(wins, "accepted").when(fails, "failed").otherwise(F.col("outcome"))
    detail, files = F.coalesce("detail_cost", F.lit(0)), F.coalesce("files_cost", F.lit(0))
    cost = F.when(F.col("status") == "skipped", 0).when(F.col("status").isin("accepted", "failed"), detail + files).otherwise(detail)
    live = written(live.withColumn("status", status).withColumn("cost", cost.cast("long")), "judged")
    spent = running_sums(live, [], AT, {"_spent": F.col("cost"), "_won": (F.col("status") == "accepted").cast("long")}, [F.col("page"), F.floor(F.col("page") / FANOUT)])
    within = F.lit(True) if budget is None else F.col("_spent") + F.col("cost") <= budget
    reached = F.col("_won") >= target
    stop = F.when(reached, "target").when(~within, "budget")
    out = written(spent.withColumn("stop", stop), "stopped")
    last = out.where("stop is not null").agg(F.min(at).alias("at")).first().at
    # what a pending candidate would settle is not settled yet
    gone = F.col("_late") & (F.lit(True) if last is None else F.col("_settled") < F.struct(*(F.lit(last[c]).cast("long").alias(c) for c in AT)))
    stopped = F.col("stop").isNotNull()
    out = out.withColumn("status", F.when(gone, "skipped").when(stopped, "pending").otherwise(F.col("status"))).withColumn("cost", F.when(stopped, 0).otherwise(F.col("cost")))
    return out.select(*rows.columns, "status", "cost", "stop")


def _sound(rows: DataFrame) -> DataFrame:
    """Candidates with a place, a process and an owner; others belong to no process and give no row. The first of equal contracts stays; of those at one place the least by outcome, owner, costs and batch, so that reruns agree."""
    named = rows.where("page is not null and place is not null and owner is not null and process is not null").withColumn("contract", F.coalesce("contract", F.lit("")))
    return keep_first(named, ["process", "contract"], [*AT, "outcome", "owner", "detail_cost", "files_cost", "batch"])


def collect(spark: SparkSession, source: str, log: str, checkpoint: str, day: date, target: int, daily: int = 0, margin: int = MARGIN, cap: int = CAP, attempts: int = ATTEMPTS) -> tuple[DataFrame, DataFrame]:
    """One run: takes up what has landed in ``source``, decides it and what is pending; returns all decisions so far and the runs' summaries.

    ``target`` counts the accepted processes of all runs; ``daily`` is what one day may
    cost (0: no bound), whose last ``margin`` is never spent. Calling it again with
    nothing landed works on what is pending. One run at a time for a log.
    """
    landed, decided, opened, known, runs = (f"{log}/{x}" for x in ("landed", "decided", "open", "owners", "runs"))
    for path, columns in ((f"{landed}/batch=-1", CANDIDATE), (f"{decided}/run=-1/part=0", JUDGED), (f"{opened}/run=-1", JUDGED), (f"{known}/run=-1", OWNERS), (f"{runs}/number=-1", SUMMARY)):
        spark.createDataFrame([], columns).write.mode("ignore").parquet(path)
    read = lambda columns, path: spark.read.schema(columns).parquet(path)

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{landed}/batch={number}")

    stream = spark.readStream.schema(CANDIDATE).parquet(source)
    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    summaries = read(SUMMARY, runs)
    past = summaries.agg(F.coalesce(F.max("run"), F.lit(-1)).alias("run"), F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"), F.coalesce(F.max("covered"), F.lit(-1)).alias("covered"), F.coalesce(F.sum(F.when(F.col("day") == day.isoformat(), F.col("used"))), F.lit(0)).alias("used")).first()
    run, taken = past.run + 1, StructType.fromDDL(LANDED).names
    waiting = read(f"{JUDGED}, run int", opened).where(F.col("run") == past.run).select(*taken)
    rows = _sound(read(LANDED, landed).where(F.col("batch") > past.covered).unionByName(waiting))
    rows = rows.withColumn("part", F.pmod(F.hash("process"), F.lit(PARTS)))
    touched = [r.part for r in rows.select("part").distinct().collect()]
    earlier = read(f"{JUDGED}, run int, part int", decided).where((F.col("run") < run) & F.col("part").isin(touched))
    rows = rows.join(earlier.where("status <> 'failed'").select("process").distinct(), "process", "left_anti")
    rows = rows.join(earlier.where("status = 'failed'").select("process", "contract"), ["process", "contract"], "left_anti")
    owners = read(f"{OWNERS}, run int", known).where(F.col("run") == past.run).drop("run")
    budget = max(0, daily - margin - past.used) if daily else None
    with scratch(spark) as folders:
        judged = written(decide(written(rows.select(*taken, "part"), "candidates"), owners, target - past.accepted, budget, cap, attempts), "decided")
        judged.where("status not in ('pending', 'error', 'skipped')").write.mode("overwrite").partitionBy("part").parquet(f"{decided}/run={run}")
        judged.where("status in ('pending', 'error')").drop("part").write.mode("overwrite").parquet(f"{opened}/run={run}")
        counts = judged.groupBy("owner").agg(F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "failed").alias("attempts"))
        owners.unionByName(counts).groupBy("owner").agg(F.sum("accepted").alias("accepted"), F.sum("attempts").alias("attempts")).write.mode("overwrite").parquet(f"{known}/run={run}")
        covered = read(LANDED, landed).agg(F.max("batch").alias("covered"))
        told = judged.agg(F.coalesce(F.sum("cost"), F.lit(0)).alias("used"), F.count_if(F.col("status") == "accepted").alias("accepted"), F.min_by("stop", F.when(F.col("stop").isNotNull(), F.struct(*AT))).alias("stopped")).crossJoin(covered)
        told.select(F.lit(run).alias("run"), F.lit(day.isoformat()).alias("day"), "used", "accepted", "stopped", F.coalesce("covered", F.lit(past.covered)).alias("covered")).write.mode("overwrite").parquet(f"{runs}/number={run}")
        folders.discard()

    final = read(f"{JUDGED}, run int, part int", decided).where(F.col("run") <= run).drop("part")
    return final.unionByName(read(f"{JUDGED}, run int", opened).where(F.col("run") == run)), read(SUMMARY, runs)


@query("""with c as (select date_diff('day', date '1995-01-01', l_shipdate::date) as page, l_orderkey * 8 + l_linenumber as place, o_custkey as owner, l_orderkey as process, l_linenumber as contract,
   case when starts_with(o_orderpriority, '1') then 'out_of_scope' when l_quantity < 5 then 'error' when l_returnflag = 'R' then 'unusable' else 'usable' end as outcome
  from lineitem join orders on o_orderkey = l_orderkey),
 u as (select * from c qualify row_number() over (partition by process, contract order by page, place) = 1),
 k as (select *, min(case when outcome in ('usable', 'out_of_scope') then (page, place) end) over (partition by process) as fin from u),
 l as (select *, coalesce((page, place) > fin, false) as late1 from k),
 w as (select *, count_if(outcome = 'usable' and not late1) over o as wins, count_if(outcome = 'unusable' and not late1) over o as fails from l window o as (partition by owner order by page, place rows between unbounded preceding and 1 preceding)),
 m as (select *, not late1 and outcome in ('usable', 'unusable') and (wins >= 5 or fails >= 3) as limited from w),
 n as (select *, least(fin, min(case when limited then (page, place) end) over (partition by process)) as settled from m),
 s as (select *, case when (page, place) > settled then 'skipped' when limited then 'owner_limit' when outcome = 'usable' then 'accepted' when outcome = 'unusable' then 'failed' else outcome end as status from n),
 t as (select *, case status when 'skipped' then 0 when 'accepted' then 3 when 'failed' then 3 else 1 end as cost, (select count(*) from customer) * 2 as target, (select count(*) // 2 from orders) as budget from s),
 r as (select *, sum(cost) over p as spent, sum((status = 'accepted')::int) over p - (status = 'accepted')::int as won from t window p as (order by page, place))
 select process::bigint as process, contract::bigint as contract, case when won >= target then 'pending' else status end as status, (case when page < 1200 and spent <= budget and status <> 'error' and won < target then 0 else 1 end)::int as run
 from r where (status <> 'skipped' or settled >= (select min((page, place)) from r where won >= target))
  and not coalesce(status = 'error' and settled < (select min((page, place)) from r where page >= 1200 or spent > budget), false)""")
def admitted(spark, sf_dir):
    """Lines as contracts of their order, customers as owners: the first run ends with its day's budget, the second one, a day later, with the target."""
    orders, days = table(spark, sf_dir, "orders"), F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date"))
    outcome = F.when(F.col("o_orderpriority").startswith("1"), "out_of_scope").when(F.col("l_quantity") < 5, "error").when(F.col("l_returnflag") == "R", "unusable").otherwise("usable")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
    text = lambda c: F.col(c).cast("string")
    rows = lines.select(days.cast("long").alias("page"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("place"), text("o_custkey").alias("owner"), text("l_orderkey").alias("process"), text("l_linenumber").alias("contract"), outcome.alias("outcome"), F.lit(1).cast("long").alias("detail_cost"), F.lit(2).cast("long").alias("files_cost"))
    landed, log, checkpoint = (fresh_path(spark, x) for x in ("landed", "admission", "progress"))
    target, daily = 2 * table(spark, sf_dir, "customer").count(), orders.count() // 2 + MARGIN
    for part, day, bound in ((F.col("page") < 1200, date(2024, 1, 1), daily), (F.col("page") >= 1200, date(2024, 1, 2), 0)):
        rows.where(part).write.mode("append").parquet(landed)
        decisions, _ = collect(spark, landed, log, checkpoint, day, target, bound)
    return decisions.select(F.col("process").cast("long").alias("process"), F.col("contract").cast("long").alias("contract"), "status", "run")
