"""Caches, stored files, repairs and a catalogue kept up to date over the given tables; SQL reads the columns directly."""

from __future__ import annotations

from pyspark.sql import functions as F

from concord.operators import upkeep
from concord.plans.registry import query
from concord.session import fresh_path, table, written

_PAYLOAD = "case event_id % 6 when 0 then '[]' when 1 then '{\"a\": ' || event_id when 2 then '{\"data\": null, \"x\": 1}' else '[1,' || event_id || ']' end"
_SAVED = "case event_id % 9 when 0 then 'ontem' when 1 then strftime(ts + interval 2 day, '%Y-%m-%dT%H:%M:%S') else strftime(ts, '%Y-%m-%dT%H:%M:%S') end"


@query(f"""with s as (select user_id as key, ts, event_id, {_PAYLOAD} as payload, {_SAVED} as saved, case event_id % 5 when 0 then 600 when 1 then 1e9 end as life from events where event_type in ('purchase', 'error', 'signup')),
 a as (select user_id as key, ts, event_id as ask_id from events where event_type = 'view'),
 j as (select a.key, a.ask_id, a.ts as now, x.* from a left join lateral (select * from s where s.key = a.key and s.ts <= a.ts order by s.ts desc, s.event_id desc limit 1) x on true),
 t as (select *, epoch_us(now) - epoch_us(try_cast(saved as timestamp)) as age, 1e6 * case when payload like '[]' or payload like '{{"data"%' then 300 else coalesce(life, 86400) end as kept from j)
 select key, ask_id, case when json_valid(payload) and age < kept then payload end as payload from t""")
def cached_answers(spark, sf_dir):
    """Each view asks for the last answer of its user: cut-off JSON, times that cannot be read or lie ahead, lives of their own, empty answers for five minutes."""
    events = table(spark, sf_dir, "events")
    n, stamp = F.col("event_id"), lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    payload = F.when(n % 6 == 0, "[]").when(n % 6 == 1, F.concat(F.lit('{"a": '), n.cast("string"))).when(n % 6 == 2, '{"data": null, "x": 1}').otherwise(F.concat(F.lit("[1,"), n.cast("string"), F.lit("]")))
    saved_at = F.when(n % 9 == 0, "ontem").when(n % 9 == 1, stamp(F.col("ts") + F.expr("interval 2 days"))).otherwise(stamp(F.col("ts")))
    life = F.when(n % 5 == 0, 600.0).when(n % 5 == 1, 1e9)
    saves = events.where("event_type in ('purchase', 'error', 'signup')").select(F.col("user_id").alias("key"), n.alias("save_id"), F.col("ts").alias("at"), payload.alias("payload"), life.alias("life"), F.lit(None).cast("double").alias("empty_life"), saved_at.alias("saved_at"))
    asks = events.where("event_type = 'view'").select(F.col("user_id").alias("key"), n.alias("ask_id"), F.col("ts").alias("at"))
    return upkeep.answers_as_of(saves, asks)


@query("""select s_suppkey::varchar as name, case when s_suppkey % 11 = 0 and s_suppkey % 7 = 0 then null when s_suppkey % 7 = 0 then 'missing' when s_suppkey % 11 = 0 then 'unlisted' when s_suppkey % 5 = 0 or s_suppkey % 13 = 0 then 'altered' else 'sound' end as status
 from supplier where not (s_suppkey % 11 = 0 and s_suppkey % 7 = 0)""")
def revalidated_store(spark, sf_dir):
    """Files of suppliers' names, some never written, some with other contents or another length in the manifest, some not listed."""
    key, path = F.col("s_suppkey"), fresh_path(spark, "store")
    suppliers = table(spark, sf_dir, "supplier").repartition(4)
    content = F.concat("s_name", F.when(key % 5 == 0, "!").otherwise(""))
    suppliers.where(key % 7 != 0).select(key.alias("name"), content.alias("value")).write.partitionBy("name").option("lineSep", ";").text(path)
    listed = F.concat("s_name", F.lit(";"))
    length = F.octet_length(listed).cast("long") + F.when(key % 13 == 0, 1).otherwise(0)
    manifest = suppliers.where(key % 11 != 0).select(key.cast("string").alias("name"), F.sha2(listed.cast("binary"), 256).alias("sha256"), length.alias("bytes"))
    return upkeep.revalidated_files(spark, manifest, path, "name=([0-9]+)/")


_ROLES = ["ETP", "TR", "EDITAL", "CONTRATO"]


@query("""with d as (select l_partkey as process, l_suppkey as row_id, (l_orderkey + l_linenumber) % 5 as r, l_orderkey * 10 + l_linenumber as revision, l_tax <> 0.03 as sound from lineitem),
 n as (select process, row_id, r, count(*) as n, max_by(sound, revision) as sound from d where r < 4 group by all),
 h as (select process, row_id, count(*) as roles, sum(n)::bigint as documents, bool_or(r = 0 and sound and n = 1) as a, bool_or(r = 1 and sound and n = 1) as b, bool_or(r = 2 and sound) as c, bool_or(r = 3 and sound) as e from n group by all)
 select process::bigint as process, row_id::bigint as row_id, concat_ws(',', 'ETP', 'TR', case when c then 'EDITAL' end, case when e then 'CONTRATO' end) as kept from h where a and b qualify row_number() over (partition by process order by roles desc, documents desc, row_id desc) = 1""")
def revalidated_acceptances(spark, sf_dir):
    """Of a process's accepted rows the best one whose study and reference term are still sound."""
    lines = table(spark, sf_dir, "lineitem")
    role = F.get(F.array(*map(F.lit, [*_ROLES, "OUTROS"])), ((F.col("l_orderkey") + F.col("l_linenumber")) % 5).cast("int"))
    documents = lines.select(F.col("l_partkey").cast("long").alias("process"), F.col("l_suppkey").cast("long").alias("row_id"), role.alias("role"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("revision"), (F.col("l_tax") != 0.03).alias("sound"))
    return upkeep.revalidated_processes(documents, _ROLES, _ROLES[:2])


@query("""with b as (select case event_id % 5 when 0 then strftime(ts - interval 3 hour, '%Y-%m-%dT%H:%M:%S') || '-03:00' when 1 then strftime(ts, '%Y-%m-%d') when 2 then 'dia ' || event_id else strftime(ts, '%Y-%m-%d %H:%M:%S') end as day,
  case when event_id % 7 = 0 then '-1' when event_id % 11 = 0 then null else (event_id % 100)::varchar end as used, strftime(ts, '%Y-%m-%d') as utc, event_id % 5 = 2 as bad_day, event_id % 7 = 0 or event_id % 11 = 0 as bad_used from events)
 select 'budget' as part, utc as day, sum(used::bigint)::varchar as used, null as reason from b where not bad_day and not bad_used group by utc
 union all select 'quarantine', day, used, concat_ws('; ', case when bad_day then 'day' end, case when bad_used then 'used' end) from b where bad_day or bad_used""")
def quarantined_budget(spark, sf_dir):
    """Days with offsets, dates and times summed by UTC day; what cannot be read is kept apart with its reason."""
    n, ts = F.col("event_id"), F.col("ts")
    day = F.when(n % 5 == 0, F.concat(F.date_format(ts - F.expr("interval 3 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:00"))).when(n % 5 == 1, F.date_format(ts, "yyyy-MM-dd")).when(n % 5 == 2, F.concat(F.lit("dia "), n.cast("string"))).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    used = F.when(n % 7 == 0, "-1").when(n % 11 != 0, (n % 100).cast("string"))
    sums, bad = upkeep.repaired_budget(table(spark, sf_dir, "events").select(day.alias("day"), used.alias("used")))
    return sums.select(F.lit("budget").alias("part"), "day", "used", F.lit(None).cast("string").alias("reason")).unionByName(bad.select(F.lit("quarantine").alias("part"), "day", "used", "reason"))


@query("""with t as (select l_suppkey % 50 as source, l_partkey % 100 as params, l_linenumber as page, l_orderkey * 10 + l_linenumber - 5000 as task_id, case l_returnflag when 'A' then 'leased' when 'N' then 'done' else 'pending' end as status,
  case when l_orderkey % 4 = 0 then ' ' when l_orderkey % 4 < 3 then 'w' || (l_orderkey % 3000) end as token, case when l_orderkey % 5 > 0 then 9 end as until from lineitem),
 o as (select * from t qualify row_number() over (partition by source, params, page order by task_id <= 0, task_id, status, token nulls first, until nulls first) = 1),
 k as (select *, case when status = 'leased' then nullif(trim(token), '') end as tk from o), h as (select tk, min(task_id) as holder from k where tk is not null group by tk),
 x as (select k.*, status = 'leased' and (k.tk is null or until is null or task_id <> holder) as lost from k left join h on h.tk = k.tk)
 select task_id::bigint as task_id, case when lost then 'pending' else status end as status, case when not lost then tk end as token, case when lost then case when tk is null or until is null then 'lease without a token or an end' else 'token held twice' end end as note from x""")
def repaired_queue(spark, sf_dir):
    """One task for each natural key; leases without a token or an end, or with a token held already, go back to the queue. A second repair changes nothing."""
    c = F.col
    token = F.when(c("l_orderkey") % 4 == 0, " ").when(c("l_orderkey") % 4 < 3, F.concat(F.lit("w"), (c("l_orderkey") % 3000).cast("string")))
    rows = table(spark, sf_dir, "lineitem").select(
        (c("l_suppkey") % 50).alias("source"), (c("l_partkey") % 100).alias("params"), c("l_linenumber").alias("page"), F.lit(10).alias("size"), (c("l_orderkey") * 10 + c("l_linenumber") - 5000).cast("long").alias("task_id"),
        F.when(c("l_returnflag") == "A", "leased").when(c("l_returnflag") == "N", "done").otherwise("pending").alias("status"), token.alias("token"), F.when(c("l_orderkey") % 5 > 0, 9).alias("until"), F.lit(None).cast("string").alias("note"))
    return upkeep.repaired_tasks(written(upkeep.repaired_tasks(rows), "tasks")).select("task_id", "status", "token", "note")


_SYNC_ROLES = ["URGENT", "HIGH", "MEDIUM", "LOW"]
_CHAIN = ", ".join(f"array_to_string(list_sort(list(o_orderkey) filter (role = '{r}' and not gone)), ',') as {r.lower()}" for r in _SYNC_ROLES)


@query(f"""with d as (select o_custkey as process, o_orderkey, case split_part(o_orderpriority, '-', 1) when '1' then 'URGENT' when '2' then 'HIGH' when '3' then 'MEDIUM' else 'LOW' end as role, o_custkey % 10 = 3 and (o_custkey % 20 = 3 or o_orderkey % 2 = 0) as gone from orders),
 n as (select process, {_CHAIN}, count(*) filter (role = 'URGENT' and not gone) as u, count(*) filter (role = 'HIGH' and not gone) as h, count(*) filter (role = 'MEDIUM' and not gone) as m, count(*) filter (role = 'LOW' and not gone) as w from d group by process)
 select process::bigint as process, coalesce(urgent, '') as urgent, coalesce(high, '') as high, coalesce(medium, '') as medium, coalesce(low, '') as low, u = 1 and h = 1 as pair, u = 1 and h = 1 and m = 1 and w = 1 as complete from n""")
def catalogue_sync(spark, sf_dir):
    """A catalogue of all orders brought up to date after a tenth of the processes lost documents, some of them all."""
    lead = F.substring_index("o_orderpriority", "-", 1)
    role = F.when(lead == "1", "URGENT").when(lead == "2", "HIGH").when(lead == "3", "MEDIUM").otherwise("LOW")
    before = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long").alias("process"), F.col("o_orderkey").cast("long").alias("document_id"), role.alias("role"))
    path, buckets = fresh_path(spark, "catalogue"), 16
    upkeep.catalogue_of(before, _SYNC_ROLES, buckets).write.partitionBy("bucket").parquet(path)
    gone = (F.col("process") % 10 == 3) & ((F.col("process") % 20 == 3) | (F.col("document_id") % 2 == 0))
    found = upkeep.synchronise(spark, before.where(~gone), before.where("process % 10 = 3").select("process"), path, _SYNC_ROLES, buckets)
    return found.select("process", *(F.array_join(F.transform(f"chain.{r}", lambda x: x.cast("string")), ",").alias(r.lower()) for r in _SYNC_ROLES), "pair", "complete")
