"""Relational operators, chains, catalogue, state folds, rules and comparison over the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.functions import records as N
from concord.operators import relational as R
from concord.operators import rules
from concord.plans.registry import query
from concord.session import table

ROLES = ["view", "signup", "click", "purchase"]
_ROLE_SQL = "list_position(['view','signup','click','purchase'], event_type)"


def _text(column: str):
    """A timestamp's text, the same in Spark and DuckDB."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


@query("select o_orderkey, floor(date_diff('day', o_orderdate::date, date '2001-12-31') / 31)::bigint as window_no from orders where o_orderdate <= timestamp '2001-12-31'")
def reverse_windows(spark, sf_dir):
    end = F.lit("2001-12-31").cast("date")
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") <= F.lit("2001-12-31").cast("timestamp_ntz"))
    return orders.select("o_orderkey", R.reverse_windows(F.col("o_orderdate").cast("date"), end, 31).cast("long").alias("window_no"))


@query("select user_id, event_type, event_id, value from events qualify row_number() over (partition by user_id, event_type order by ts, event_id) = 1")
def dedup_keep_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return R.keep_first(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderkey)::bigint as turn, min(o_orderkey) over (partition by o_custkey) as first from orders""")
def round_robin(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return R.round_robin(orders, "o_custkey", "o_orderkey", F.floor(F.col("o_orderkey") / 100_000))


@query("select user_id, event_type, event_id, value from events qualify row_number() over (partition by user_id, event_type order by ts desc, value desc, event_id desc) = 1")
def latest_revision(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return R.latest(events, ["user_id", "event_type"], ["ts", "value", "event_id"]).drop("ts")


@query("""select c_custkey, o_orderkey, o_orderpriority from orders join customer on o_custkey = c_custkey
 qualify o_orderpriority = '1-URGENT' or (count_if(o_orderpriority = '1-URGENT') over (partition by c_custkey) = 0 and row_number() over (partition by c_custkey order by o_orderdate, o_orderkey desc) = 1)""")
def contract_group_priority(spark, sf_dir):
    """All initial (urgent) orders of a customer; the first one where there is none."""
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    initial = F.col("o_orderpriority") == "1-URGENT"
    picked = F.struct("o_orderkey", "o_orderpriority")
    first = F.min_by(picked, F.struct("o_orderdate", -F.col("o_orderkey")))
    grouped = joined.groupBy("c_custkey").agg(F.collect_list(F.when(initial, picked)).alias("initials"), first.alias("first"))
    return grouped.select("c_custkey", F.inline(F.when(F.size("initials") > 0, F.col("initials")).otherwise(F.array("first"))))


#: A user's events of one day are a process: its event types are the roles of its documents.
_DAY = "strftime(ts, '%Y-%m-%d')"


def _processes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


@query(f"""with g as (select user_id, {_DAY} as day, list_distinct(list(event_type)) as p, max_by(event_id, (ts, event_id)) filter (event_type = 'purchase') as chosen from events group by all)
 select user_id, day, chosen, array_to_string(list_filter(['view','signup','click','purchase'], lambda r: not list_contains(p, r)), ',') as missing from g""")
def candidate_chain(spark, sf_dir):
    grouped = _processes(spark, sf_dir).groupBy("user_id", "day").agg(F.collect_set("event_type").alias("p"), F.max_by(F.when(F.col("event_type") == "purchase", F.col("event_id")), F.when(F.col("event_type") == "purchase", F.struct("ts", "event_id"))).alias("chosen"))
    return grouped.select("user_id", "day", "chosen", rules.missing(F.col("p"), ROLES).alias("missing"))


@query(f"""with r as (select user_id, {_DAY} as day, event_type, {_ROLE_SQL} as k, count(*) as n from events where {_ROLE_SQL} > 0 group by all),
 s as (select *, lead(event_type) over w as to_role, lead(n) over w as n_to from r window w as (partition by user_id, day order by k))
 select user_id, day, event_type as from_role, to_role, n as n_from, n_to, n * n_to as n_links from s where to_role is not null""")
def chain_edges(spark, sf_dir):
    """An edge for each two neighbouring present roles of a process, with its number of links; ``chain_members`` lists their ends."""
    return R.role_edges(_processes(spark, sf_dir), ["user_id", "day"], "event_type", ROLES)


@query(f"select user_id, {_DAY} as day, event_type as role, event_id from events where {_ROLE_SQL} > 0")
def chain_members(spark, sf_dir):
    return _processes(spark, sf_dir).where(F.col("event_type").isin(ROLES)).select("user_id", "day", F.col("event_type").alias("role"), "event_id")


@query(f"""select user_id, {_DAY} as day, count(*)::bigint as n, count(*) = count(distinct event_type) and count(distinct event_type) filter (event_type <> 'error') = 4 and count(*) = 4 as complete, bool_and(value < 200) as usable
 from events group by all""")
def complete_chain(spark, sf_dir):
    """A chain is complete with exactly one document of each of the four roles and no other; usable with all of them."""
    roles = F.count_distinct(F.when(F.col("event_type").isin(ROLES), F.col("event_type")))
    return _processes(spark, sf_dir).groupBy("user_id", "day").agg(F.count("*").alias("n"), ((F.count("*") == 4) & (roles == 4)).alias("complete"), F.bool_and(F.col("value") < 200).alias("usable"))


@query("""with new as (select o_orderkey, o_custkey, 'new' as origin from orders where o_orderdate >= timestamp '1998-01-01'),
 old as (select o_orderkey, o_custkey, 'old' as origin from orders where o_orderdate < timestamp '1999-01-01')
 select * from new union all select * from old where o_orderkey not in (select o_orderkey from new)""")
def catalog_merge(spark, sf_dir):
    orders, day = table(spark, sf_dir, "orders"), lambda d: F.lit(d).cast("timestamp_ntz")
    new = orders.where(F.col("o_orderdate") >= day("1998-01-01")).select("o_orderkey", "o_custkey", F.lit("new").alias("origin"))
    old = orders.where(F.col("o_orderdate") < day("1999-01-01")).select("o_orderkey", "o_custkey", F.lit("old").alias("origin"))
    return R.merge_catalogue(new, old, "o_orderkey")


_STATS = "orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"


def _placed(spark, sf_dir) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


@query(f"""select n_name, count(*)::bigint as n_orders, count(distinct c_custkey)::bigint as n_customers, count(distinct nullif(c_mktsegment, ''))::bigint as n_segments,
 count_if(o_orderstatus = 'F')::bigint as n_done, nullif(round(sum(coalesce(o_totalprice, 0)), 2), 0) as total from {_STATS} group by n_name""")
def corpus_statistics(spark, sf_dir):
    return _placed(spark, sf_dir).groupBy("n_name").agg(F.count("*").alias("n_orders"), F.count_distinct("c_custkey").alias("n_customers"), F.count_distinct(F.nullif("c_mktsegment", F.lit(""))).alias("n_segments"), F.count_if(F.col("o_orderstatus") == "F").alias("n_done"), F.nullif(F.round(F.sum(F.coalesce("o_totalprice", F.lit(0.0))), 2), F.lit(0.0)).alias("total"))


@query(f"""with p as (select count(*) as orders, count(distinct n_name) as nations, count(distinct c_mktsegment) as segments from {_STATS}),
 m as (select max(n) as most from (select count(*) as n from orders group by o_custkey))
 select 'orders' as criterion, 20::bigint as required, orders::bigint as found, orders >= 20 as passed from p union all select 'nations', 5, nations, nations >= 5 from p
 union all select 'segments', 3, segments, segments >= 3 from p union all select 'most_per_customer', 5, most, most <= 5 from m""")
def gate_criteria(spark, sf_dir):
    found = _placed(spark, sf_dir).agg(F.count("*").alias("orders"), F.count_distinct("n_name").alias("nations"), F.count_distinct("c_mktsegment").alias("segments"))
    most = table(spark, sf_dir, "orders").groupBy("o_custkey").count().agg(F.max("count").alias("most_per_customer"))
    rows = [("orders", 20, True), ("nations", 5, True), ("segments", 3, True), ("most_per_customer", 5, False)]
    lists = F.array(*(F.struct(F.lit(n).alias("criterion"), F.lit(r).cast("long").alias("required"), F.col(n).alias("found"), (F.col(n) >= r if least else F.col(n) <= r).alias("passed")) for n, r, least in rows))
    return found.crossJoin(most).select(F.inline(lists))  # one row each


@query("""select user_id, count(*)::bigint as n, count_if(date_diff('second', ts, timestamp '2024-01-20 00:00:00') < case when value < 5 then 300 else 86400 end)::bigint as fresh
 from (select * from events where ts < timestamp '2024-01-20 00:00:00' qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1) group by user_id""")
def ttl_cache_hits(spark, sf_dir):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    last = R.latest(table(spark, sf_dir, "events").where(F.col("ts") < now), ["user_id", "event_type"], ["ts", "event_id"])
    age = F.timestamp_diff("SECOND", F.date_trunc("second", "ts").cast("timestamp_ntz"), now)
    return last.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(age < F.when(F.col("value") < 5, 300).otherwise(86400)).alias("fresh"))


@query("""select strftime(ts, '%Y-%m-%d') as day, count(*)::bigint as asked, least(count(*), 250)::bigint as admitted, count(*) > 250 as blocked from events group by 1""")
def daily_budget(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("asked"))
    return days.select("day", "asked", F.least("asked", F.lit(250)).cast("long").alias("admitted"), (F.col("asked") > 250).alias("blocked"))


@query("""select event_id, attempt, 60 * pow(2, attempt - 1) as wait_seconds from
 (select event_id, row_number() over (partition by user_id order by ts, event_id)::bigint as attempt from events where event_type = 'error')""")
def retry_backoff(spark, sf_dir):
    """The wait doubles with every attempt, without an upper limit."""
    errors = table(spark, sf_dir, "events").where("event_type = 'error'").select("user_id", "event_id", "ts")
    attempts = R.numbered(errors, ["user_id"], ["ts", "event_id"], F.to_date("ts"), "attempt")
    return attempts.select("event_id", "attempt", (60 * F.pow(F.lit(2.0), F.col("attempt") - 1)).alias("wait_seconds"))


_STATE = {"signup": "pending", "click": "leased", "purchase": "done", "error": "retry", "view": None}


@query("""with l as (select user_id, event_type from events where event_type <> 'view' qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
 select user_id, case event_type when 'signup' then 'pending' when 'click' then 'leased' when 'purchase' then 'done' else 'retry' end as status,
 (select count(*) from events e where e.user_id = l.user_id and e.event_type = 'error')::bigint as failures from l""")
def lease_state(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("event_type <> 'view'")
    status = F.create_map(*(F.lit(x) for k, v in _STATE.items() if v for x in (k, v)))
    folded = events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last"), F.count_if(F.col("event_type") == "error").alias("failures"))
    return folded.select("user_id", status[F.col("last")].alias("status"), "failures")


_SIDES = """with l as (select l_orderkey as o, l_partkey, l_linenumber as n, l_quantity, l_extendedprice, l_returnflag, l_tax, l_discount, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as pos from lineitem)"""
_PAIRED = f"""{_SIDES}, a as (select o // 2 as pair_id, * from l where o % 2 = 0), b as (select o // 2 as pair_id, * from l where o % 2 = 1),
 fa as (select * from a qualify row_number() over (partition by pair_id, n order by pos) = 1), fb as (select * from b qualify row_number() over (partition by pair_id, n order by pos) = 1),
 num as (select pair_id, fa.pos as left_id, fb.pos as right_id, 'number' as stage from fa join fb using (pair_id, n)),
 sa as (select pair_id, min(pos) as left_id from a group by 1 having count(*) = 1), sb as (select pair_id, min(pos) as right_id from b group by 1 having count(*) = 1),
 sole as (select pair_id, left_id, right_id, 'sole' as stage from sa join sb using (pair_id) where pair_id not in (select pair_id from num)),
 used as (select * from num union all select * from sole),
 ra as (select pair_id, pos as left_id, row_number() over (partition by pair_id order by pos) as rn, count(*) over (partition by pair_id) as c from a where not exists (select 1 from used u where u.pair_id = a.pair_id and u.left_id = a.pos)),
 rb as (select pair_id, pos as right_id, row_number() over (partition by pair_id order by pos) as rn, count(*) over (partition by pair_id) as c from b where not exists (select 1 from used u where u.pair_id = b.pair_id and u.right_id = b.pos)),
 matched as (select * from used union all select pair_id, left_id, right_id, 'position' from ra join rb using (pair_id, rn, c)),
 sides as (select m.*, a.l_quantity as qa, b.l_quantity as qb, a.l_returnflag as ua, b.l_returnflag as ub, a.l_extendedprice as pa, b.l_extendedprice as pb, a.l_tax as ta, b.l_tax as tb, a.l_discount as da, b.l_discount as db
 from matched m join a on a.pair_id = m.pair_id and a.pos = m.left_id join b on b.pair_id = m.pair_id and b.pos = m.right_id)"""


def _sides(spark, sf_dir) -> DataFrame:
    """Lines of each two neighbouring orders, the items of two documents of a process, dealt out by pair; repeated lines are numbered in their order."""
    pos = F.row_number().over(Window.partitionBy("pair_id", "l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")).cast("long")
    side = (F.col("l_orderkey") % 2).cast("int")
    lines = table(spark, sf_dir, "lineitem").withColumn("pair_id", F.floor(F.col("l_orderkey") / 2)).repartition("pair_id")
    return lines.select("pair_id", side.alias("side"), F.col("l_linenumber").alias("number"), pos.alias("pos"), pos.alias("item_id"), "l_quantity", "l_returnflag", "l_extendedprice", "l_tax", "l_discount")


@query(f"{_PAIRED} select pair_id::bigint as pair_id, left_id::bigint as left_id, right_id::bigint as right_id, stage from matched")
def item_matching(spark, sf_dir):
    return rules.match_sides(_sides(spark, sf_dir), dealt=True).select("pair_id", F.col("left.item_id").alias("left_id"), F.col("right.item_id").alias("right_id"), "stage")


#: What a flag's unit is called on either side.
_CALLED = {"A": ("Und.", "unidades"), "N": ("cx", "Caixa"), "R": ("PÇ", "kg")}
_UNIT_NAMES = {"Und.": "UNIDADE", "unidades": "UNIDADE", "cx": "CAIXA", "Caixa": "CAIXA", "PÇ": "PECA", "kg": "QUILOGRAMA"}


def _unit_said(side: int, flag: str) -> str:
    return f"case {flag} " + " ".join(f"when '{f}' then '{names[side]}'" for f, names in _CALLED.items()) + " end"


def _unit_sql(side: int, flag: str) -> str:
    return f"case {flag} " + " ".join(f"when '{f}' then '{_UNIT_NAMES[names[side]]}'" for f, names in _CALLED.items()) + " end"


_ITEM_RULES = {
    "const_quantity": ("CONST-001", "quantity", "qa", "qb"),
    "const_unit": ("CONST-002", "unit", _unit_sql(0, "ua"), _unit_sql(1, "ub")),
    "item_total": ("CONST-005", "item_total", "pa::decimal(18,2)", "pb::decimal(18,2)"),
    "item_unit": ("CONST-005", "item_unit", "round(pa * 100)::bigint // qa::bigint", "round(pb * 100)::bigint // qb::bigint"),
}


def _item_comparisons() -> dict[str, rules.Comparison]:
    unit = lambda x: N.canonical_unit(x["unit"])
    price = lambda x: x["l_extendedprice"].cast("decimal(18,2)")
    each = lambda x: F.floor(F.try_divide(F.round(x["l_extendedprice"] * 100), x["l_quantity"].cast("int")))
    values = {"const_quantity": lambda x: x["l_quantity"], "const_unit": unit, "item_total": price, "item_unit": each}
    return {name: (_ITEM_RULES[name][0], _ITEM_RULES[name][1], "HIGH", f) for name, f in values.items()}


def _matched(spark, sf_dir, *without: str) -> DataFrame:
    """The pairs' items matched, their sides' structs without some columns."""
    said = F.when(F.col("side") == 0, F.expr(_unit_said(0, "l_returnflag"))).otherwise(F.expr(_unit_said(1, "l_returnflag")))
    found = rules.match_sides(_sides(spark, sf_dir).withColumn("unit", said).drop(*without), dealt=True)
    return found.withColumn("left_id", F.col("left.item_id")).withColumn("right_id", F.col("right.item_id"))


_FINDING = ["rule_id", "level", "severity", "pair_id", "left_id", "right_id", "left_value", "right_value", "left_pos", "right_pos"]


def _item_sql(name: str) -> str:
    rule, level, a, b = _ITEM_RULES[name]
    return f"select '{rule}' as rule_id, '{level}' as level, 'HIGH' as severity, pair_id::bigint as pair_id, left_id::bigint as left_id, right_id::bigint as right_id, ({a})::varchar as left_value, ({b})::varchar as right_value, left_id::bigint as left_pos, right_id::bigint as right_pos from sides where ({a}) <> ({b})"


@query(f"{_PAIRED} {_item_sql('const_quantity')}")
def const_quantity(spark, sf_dir):
    return rules.compare(_matched(spark, sf_dir), [_item_comparisons()["const_quantity"]], ["pair_id", "left_id", "right_id"]).select(*_FINDING)


@query(f"{_PAIRED} {_item_sql('const_unit')}")
def const_unit(spark, sf_dir):
    return rules.compare(_matched(spark, sf_dir), [_item_comparisons()["const_unit"]], ["pair_id", "left_id", "right_id"]).select(*_FINDING)


#: A line says its document's deadline (days), warranty and budget; the first lines cannot be read.
_FIELD_AT = "(l_linenumber, l_partkey, l_suppkey, l_quantity)"
_FIELDS_SQL = f"""f as (select l_orderkey // 2 as pair_id, l_orderkey % 2 as side, min_by(l_quantity::int, {_FIELD_AT}) filter (l_linenumber > 1) as deadline,
 min_by(case when l_linenumber % 2 = 0 then 12 else 1 end * round(l_discount * 100)::int, {_FIELD_AT}) filter (l_linenumber > 1) as warranty, min_by(l_extendedprice::decimal(18,2), {_FIELD_AT}) as budget, min(l_linenumber)::bigint as pos from lineitem group by all)"""


def _field_sql(rule: str, level: str, name: str) -> str:
    return f"select '{rule}' as rule_id, '{level}' as level, 'HIGH' as severity, a.pair_id::bigint as pair_id, null::bigint as left_id, null::bigint as right_id, a.{name}::varchar as left_value, b.{name}::varchar as right_value, a.pos as left_pos, b.pos as right_pos from f a join f b on a.pair_id = b.pair_id and a.side = 0 and b.side = 1 where a.{name} <> b.{name}"


def _documents_compared(spark, sf_dir, names: list[str]) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.floor(F.col("l_orderkey") / 2).alias("pair_id"), (F.col("l_orderkey") % 2).cast("int").alias("side"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("pos"), "l_quantity", "l_discount", "l_extendedprice")
    late = F.col("pos.l_linenumber") > 1
    hundredths = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    said = [
        F.struct(F.lit("deadline").alias("field"), F.when(late, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" dias"))).otherwise("a definir").alias("value")),
        F.struct(F.lit("warranty").alias("field"), F.when(late, F.concat(hundredths, F.when(F.col("pos.l_linenumber") % 2 == 0, " Anos").otherwise(" meses"))).otherwise("conforme a lei").alias("value")),
        F.struct(F.lit("budget").alias("field"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("value")),
    ]
    fields = lines.select("pair_id", "side", "pos", F.inline(F.array(*said)))
    read = {"deadline": N.first_number, "warranty": N.months, "budget": lambda v: v.try_cast("decimal(18,2)")}
    pairs = rules.first_fields(fields, read)
    for side in ("left", "right"):
        pairs = pairs.withColumn(side, F.col(side).withField("pos", F.col(f"{side}.pos.l_linenumber").cast("long")))
    rule = {"deadline": ("CONST-003", "deadline"), "warranty": ("CONST-004", "warranty"), "budget": ("CONST-005", "document")}
    comparisons = [(*rule[n], "HIGH", lambda x, n=n: x[n]) for n in names]
    none = F.lit(None).cast("long")
    return rules.compare(pairs, comparisons, ["pair_id"]).select("rule_id", "level", "severity", "pair_id", none.alias("left_id"), none.alias("right_id"), "left_value", "right_value", "left_pos", "right_pos")


@query(f"with {_FIELDS_SQL} {_field_sql('CONST-003', 'deadline', 'deadline')}")
def const_deadline(spark, sf_dir):
    return _documents_compared(spark, sf_dir, ["deadline"])


@query(f"with {_FIELDS_SQL} {_field_sql('CONST-004', 'warranty', 'warranty')}")
def const_warranty(spark, sf_dir):
    return _documents_compared(spark, sf_dir, ["warranty"])


_BUDGET_SQL = f"{_field_sql('CONST-005', 'document', 'budget')} union all {_item_sql('item_total')} union all {_item_sql('item_unit')}"


@query(f"{_PAIRED}, {_FIELDS_SQL} {_BUDGET_SQL}")
def const_budget(spark, sf_dir):
    """Budgets of whole documents, and of items their total prices and their unit prices in whole cents."""
    comparisons = _item_comparisons()
    items = rules.compare(_matched(spark, sf_dir), [comparisons["item_total"], comparisons["item_unit"]], ["pair_id", "left_id", "right_id"]).select(*_FINDING)
    return _documents_compared(spark, sf_dir, ["budget"]).unionByName(items)


_ATTRIBUTE = "case l_returnflag when 'A' then 'catmat' else lower(trim(l_returnflag)) end"
_SPEC_SQL = f"""r as (select l_orderkey // 2 as pair_id, l_orderkey % 2 as side, {_ATTRIBUTE} as attribute, max_by(lower(trim(l_linestatus)) || (l_quantity::int // 10), {_FIELD_AT}) as v, max(l_linenumber)::bigint as pos from lineitem group by all)"""
_SPEC_SELECT = "select 'CONST-006' as rule_id, attribute as level, case attribute when 'catmat' then 'HIGH' else 'MEDIUM' end as severity, a.pair_id::bigint as pair_id, null::bigint as left_id, null::bigint as right_id, a.v as left_value, b.v as right_value, a.pos as left_pos, b.pos as right_pos from r a join r b using (pair_id, attribute) where a.side = 0 and b.side = 1 and a.v <> b.v"


@query(f"with {_SPEC_SQL} {_SPEC_SELECT}")
def const_spec(spark, sf_dir):
    """Requirements of equal name (trimmed, lower case), the last one of each side; codes weigh more than other attributes."""
    said = F.concat(F.lit(" "), F.upper("l_linestatus"), (F.floor(F.col("l_quantity").cast("int") / 10)).cast("string"))
    attribute = F.lower(F.trim(F.when(F.col("l_returnflag") == "A", " CatMat").otherwise(F.col("l_returnflag"))))
    at = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    sides = [F.struct(F.max_by(F.when(F.col("l_orderkey") % 2 == n, said), F.when(F.col("l_orderkey") % 2 == n, at)).alias("value"), F.max(F.when(F.col("l_orderkey") % 2 == n, F.col("l_linenumber"))).cast("long").alias("pos")).alias(name) for n, name in enumerate(("left", "right"))]
    pairs = table(spark, sf_dir, "lineitem").groupBy(F.floor(F.col("l_orderkey") / 2).alias("pair_id"), attribute.alias("attribute")).agg(*sides)
    severity = F.when(F.col("attribute") == "catmat", "HIGH").otherwise("MEDIUM")
    found = rules.compare(pairs, [("CONST-006", "", severity, lambda x: F.lower(F.trim(x["value"])))], ["pair_id", "attribute"])
    none = F.lit(None).cast("long")
    return found.select("rule_id", F.col("attribute").alias("level"), "severity", "pair_id", none.alias("left_id"), none.alias("right_id"), "left_value", "right_value", "left_pos", "right_pos")


@query(f"{_PAIRED}, {_FIELDS_SQL}, {_SPEC_SQL}, u as ({_item_sql('const_quantity')} union all {_item_sql('const_unit')} union all {_field_sql('CONST-003', 'deadline', 'deadline')} union all {_field_sql('CONST-004', 'warranty', 'warranty')} union all {_BUDGET_SQL} union all {_SPEC_SELECT}) select rule_id, level, severity, count(*)::bigint as n, count(distinct pair_id)::bigint as n_pairs from u group by all")
def consistency_findings(spark, sf_dir):
    """The union of all bilateral rules' findings, counted; items and document fields are each matched once for all their rules."""
    items = rules.compare(_matched(spark, sf_dir), list(_item_comparisons().values()), ["pair_id", "left_id", "right_id"]).select(*_FINDING)
    every = items.unionByName(_documents_compared(spark, sf_dir, ["deadline", "warranty", "budget"])).unionByName(const_spec(spark, sf_dir))
    return every.groupBy("rule_id", "level", "severity").agg(F.count("*").alias("n"), F.count_distinct("pair_id").alias("n_pairs"))


@query(f"""{_PAIRED}, x as (select *, case when (pair_id + left_id) % 3 = 0 then qb * 3 + 7 else qa end as qm, (pair_id + left_id) % 3 = 0 as mutated from sides)
 select stage, count(*)::bigint as n, count_if(mutated)::bigint as n_mutated, count_if(mutated and qm <> qb)::bigint as detected, count_if(not mutated and qm <> qb)::bigint as differing from x group by stage""")
def mutation_suite(spark, sf_dir):
    pairs = _matched(spark, sf_dir).withColumn("mutated", (F.col("pair_id") + F.col("left_id")) % 3 == 0)
    changed = F.when(F.col("mutated"), F.col("right.l_quantity") * 3 + 7).otherwise(F.col("left.l_quantity"))
    differs = changed != F.col("right.l_quantity")
    return pairs.groupBy("stage").agg(F.count("*").alias("n"), F.count_if("mutated").alias("n_mutated"), F.count_if(F.col("mutated") & differs).alias("detected"), F.count_if(~F.col("mutated") & differs).alias("differing"))


@query("""with d as (select user_id, event_type, max_by(event_id, (ts, event_id)) as doc from events group by all), p(a, b) as (values ('view', 'signup'), ('signup', 'click'), ('signup', 'purchase'), ('error', 'view'))
 select x.user_id, p.a as left_type, p.b as right_type, x.doc as left_doc, y.doc as right_doc from p join d x on x.event_type = p.a join d y on y.event_type = p.b and y.user_id = x.user_id""")
def doc_pairing(spark, sf_dir):
    last = R.latest(table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")
    pairs = F.array(*(F.struct(F.lit(a).alias("left_type"), F.lit(b).alias("right_type")) for a, b in [("view", "signup"), ("signup", "click"), ("signup", "purchase"), ("error", "view")]))
    left = last.select("user_id", F.inline(F.filter(pairs, lambda p: p["left_type"] == F.col("event_type"))), F.col("event_id").alias("left_doc"))
    return left.join(last.select("user_id", F.col("event_type").alias("right_type"), F.col("event_id").alias("right_doc")), ["user_id", "right_type"])


@query("select o_orderkey, o_orderstatus from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 25 and l_returnflag is not null)")
def rule_missing(spark, sf_dir):
    good = table(spark, sf_dir, "lineitem").where("l_quantity > 25 and l_returnflag is not null").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(good, "o_orderkey", "left_anti")


@query("""with m as (select l_orderkey, l_returnflag as v, l_linenumber as n, l_partkey, l_suppkey from lineitem), f as (select l_orderkey, min_by(v, (n, l_partkey, l_suppkey)) as first_value from m group by 1)
 select l_orderkey, first_value, min_by(v, (n, l_partkey, l_suppkey)) as other_value, count(*)::bigint as n_other from m join f using (l_orderkey) where v <> first_value group by all""")
def rule_contradiction(spark, sf_dir):
    mentions = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("at"))
    return rules.contradictions(mentions, ["l_orderkey"], "l_returnflag", "at")


@query(f"""with g as (select user_id, {_DAY} as day, list_distinct(list(event_type)) as p from events group by all)
 select user_id, day, array_to_string(list_filter(['view','signup','click','purchase','error'], lambda r: not list_contains(p, r)), ',') as missing from g where len(p) < 5""")
def rule_mandatory(spark, sf_dir):
    """Processes without some role, and the roles they lack in canonical order."""
    grouped = _processes(spark, sf_dir).groupBy("user_id", "day").agg(F.collect_set("event_type").alias("p"))
    return grouped.where(F.size("p") < 5).select("user_id", "day", rules.missing(F.col("p"), [*ROLES, "error"]).alias("missing"))


@query("select l_partkey, count(*)::bigint as mentions from lineitem where l_partkey not in (select p_partkey from part where p_size > 10) group by l_partkey")
def rule_unresolved_ref(spark, sf_dir):
    known = table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("mentions")).join(known, "l_partkey", "left_anti")


_ACTIONS = "case event_type when 'click' then 'CONFIRM' when 'purchase' then 'EDIT_AND_CONFIRM' when 'error' then 'REJECT' end"
_REVIEWS = f"select *, {_ACTIONS} as action, json_extract(props, '$.k')::int as target from events where event_type in ('click', 'purchase', 'error')"


def _reviews(spark, sf_dir) -> DataFrame:
    action = F.create_map(*(F.lit(x) for x in ("click", "CONFIRM", "purchase", "EDIT_AND_CONFIRM", "error", "REJECT")))
    return table(spark, sf_dir, "events").where("event_type in ('click', 'purchase', 'error')").withColumn("action", action[F.col("event_type")]).withColumn("target", F.get_json_object("props", "$.k").cast("int"))


@query(f"""select target, max_by(action, (ts, event_id)) as last_action, case when max_by(action, (ts, event_id)) = 'REJECT' then 'REJECTED' else 'CONFIRMED' end as status,
 max_by(value, (ts, event_id)) filter (action = 'EDIT_AND_CONFIRM') as value, count(*)::bigint as n_events from ({_REVIEWS}) group by target""")
def review_fold(spark, sf_dir):
    order = F.struct("ts", "event_id")
    edited = F.col("action") == "EDIT_AND_CONFIRM"
    folded = _reviews(spark, sf_dir).groupBy("target").agg(F.max_by("action", order).alias("last_action"), F.max_by(F.when(edited, F.col("value")), F.when(edited, order)).alias("value"), F.count("*").alias("n_events"))
    return folded.withColumn("status", F.when(F.col("last_action") == "REJECT", "REJECTED").otherwise("CONFIRMED"))


@query(f"select event_id, target, action, row_number() over (partition by target order by ts, event_id)::bigint as seq, lag(action) over (partition by target order by ts, event_id) as previous from ({_REVIEWS})")
def review_audit(spark, sf_dir):
    """Every event with its number and the action before it; targets are few whatever the events, so days are numbered by themselves."""
    reviews = _reviews(spark, sf_dir).select("event_id", "target", "action", "ts")
    return R.numbered(reviews, ["target"], ["ts", "event_id"], F.to_date("ts"), "seq", ("action", "previous")).drop("ts")


@query(f"select target, max_by(value, (ts, event_id)) as value from ({_REVIEWS}) group by target having max_by(action, (ts, event_id)) <> 'REJECT'")
def confirmed_export(spark, sf_dir):
    order = F.struct("ts", "event_id")
    return _reviews(spark, sf_dir).groupBy("target").agg(F.max_by("value", order).alias("value"), F.max_by("action", order).alias("a")).where("a <> 'REJECT'").drop("a")


@query("""select 'order_without_customer' as violation, count(*)::bigint as n from orders where o_custkey not in (select c_custkey from customer) union all
 select 'duplicate_line', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1) union all
 select 'line_without_order', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders) union all
 select 'quantity_not_positive', count(*) from lineitem where not l_quantity > 0""")
def integrity_violations(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    counts = [
        ("order_without_customer", orders.join(customers, "o_custkey", "left_anti")),
        ("duplicate_line", lines.groupBy("l_orderkey", "l_linenumber").count().where("count > 1")),
        ("line_without_order", lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti")),
        ("quantity_not_positive", lines.where("not l_quantity > 0")),
    ]
    out = None
    for name, rows in counts:
        row = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("violation"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(f"""select user_id, {_DAY} as day, count_if(event_type = 'view')::bigint as view, count_if(event_type = 'signup')::bigint as signup, count_if(event_type = 'click')::bigint as click, count_if(event_type = 'purchase')::bigint as purchase,
 4 - count(distinct event_type) filter (event_type <> 'error')::bigint as missing from events group by all""")
def coverage_report(spark, sf_dir):
    counts = [F.count_if(F.col("event_type") == r).alias(r) for r in ROLES]
    missing = 4 - F.count_distinct(F.when(F.col("event_type") != "error", F.col("event_type")))
    return _processes(spark, sf_dir).groupBy("user_id", "day").agg(*counts, missing.alias("missing"))


@query(f"""with u as (select user_id, {_DAY} as day, list_distinct(list(event_type)) as p from events group by all)
 select count(*)::bigint as processes, count_if(list_contains(p, 'view'))::bigint as with_view, count_if(list_contains(p, 'purchase'))::bigint as with_purchase, count_if(len(p) = 5)::bigint as complete from u""")
def survey_yield(spark, sf_dir):
    processes = _processes(spark, sf_dir).groupBy("user_id", "day").agg(F.collect_set("event_type").alias("p"))
    has = lambda r: F.count_if(F.array_contains("p", r))
    return processes.agg(F.count("*").alias("processes"), has("view").alias("with_view"), has("purchase").alias("with_purchase"), F.count_if(F.size("p") == 5).alias("complete"))


@query("""select user_id, round(sum(least(value, 100) * greatest(k, 1)) / sum(greatest(k, 1)), 6) as confidence, case when bool_and(value <= 300) then round(avg(value), 6) end as strict_mean
 from (select user_id, value, json_extract(props, '$.k')::int as k from events) group by user_id""")
def weighted_confidence(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    weight = F.greatest("k", F.lit(1))
    return events.groupBy("user_id").agg(F.round(F.sum(F.least("value", F.lit(100.0)) * weight) / F.sum(weight), 6).alias("confidence"), F.when(F.bool_and(F.col("value") <= 300), F.round(F.avg("value"), 6)).alias("strict_mean"))


_REASONS = [("c_acctbal < 0", "negative_balance"), ("c_mktsegment not in ('MACHINERY', 'HOUSEHOLD', 'BUILDING', 'AUTOMOBILE')", "segment"), ("c_nationkey % 5 = 0", "nation")]


@query("select c_custkey, case " + " ".join(f"when {c} then '{n}'" for c, n in _REASONS) + " end as reason from customer")
def acceptance_reason(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", R.first_reason([(F.expr(c), n) for c, n in _REASONS]).alias("reason"))
