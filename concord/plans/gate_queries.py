"""The gate over orders laid out as processes: flags of each process, criteria of both kinds of lots; SQL compares lists where the plan compares counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.operators import gate as G
from concord.plans.registry import query
from concord.session import table

_ROLE = "case l_linenumber when 1 then 'ETP' when 2 then 'TR' when 3 then 'EDITAL' when 4 then 'CONTRATO' when 7 then 'OUTRO' end"
_SPHERE = "case c_nationkey % 6 when 0 then 'F' when 1 then ' e' when 2 then 'M' when 3 then 'D' when 4 then 'X' end"
_LEAST = {"least": 20, "per_owner": 2, "owners": 5, "spheres": ["F", "E", "M"], "categories": 3}


def _laid_out(spark, sf_dir) -> tuple[DataFrame, ...]:
    """processes, chain, documents, edges and contracts, with planted gaps."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.expr(_SPHERE).alias("sphere"), F.col("c_mktsegment").alias("category"))
    orders = table(spark, sf_dir, "orders").join(customers, "o_custkey", "left")
    number = F.col("o_orderkey").cast("string")
    policy = F.when(F.year("o_orderdate") >= 1999, G.CURRENT_POLICY)
    processes = orders.select(F.col("o_orderkey").alias("process"), F.col("o_custkey").alias("owner"), "category", "sphere", policy.alias("policy"), number.alias("control"), (F.col("o_orderstatus") != "P").alias("supported"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("process"), F.concat_ws("-", "l_orderkey", "l_partkey").alias("document"), F.expr(_ROLE).alias("role"), "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax").where("role is not null")
    chain, documents = lines.where("round(l_discount * 100) <> 5").select("process", "role", "document"), lines.where("round(l_tax * 100) <> 3").select("process", "document", "role", (F.col("l_quantity") > 2).alias("usable"))
    # an order has as many lines as a document has parts
    before = Window.partitionBy("process").orderBy("l_linenumber", "l_partkey")
    edges = lines.select("process", F.lag("role").over(before).alias("from_role"), F.col("role").alias("to_role"), F.lag("document").over(before).alias("from_doc"), F.col("document").alias("to_doc"), "l_partkey").where("from_role is not null and l_partkey % 20 <> 0").drop("l_partkey")
    named = F.when(F.col("o_orderkey") % 7 == 0, F.concat(number, F.lit("x"))).otherwise(number)
    contract = table(spark, sf_dir, "orders").where("o_orderpriority not like '5%'").select(F.col("o_orderkey").alias("process"), named.alias("purchase"), F.when(F.col("o_orderkey") % 13 == 0, "objeto").otherwise(G.LINK_RULE).alias("rule"))
    return processes, chain, documents, edges, contract.unionByName(contract.where("process % 11 = 0"))


_P = f"""p as (select o_orderkey, o_custkey, c_mktsegment, upper(trim({_SPHERE})) as sphere, o_orderstatus <> 'P' as supported, year(o_orderdate) >= 1999 as cur from orders left join customer on o_custkey = c_custkey),
 l as (select l_orderkey, l_partkey, l_linenumber, l_orderkey || '-' || l_partkey as d, {_ROLE} as role, l_quantity > 2 as u, round(l_discount * 100) <> 5 as in_chain, round(l_tax * 100) <> 3 as in_docs from lineitem),
 c as (select l_orderkey as k, """ + ", ".join(f"coalesce(list(distinct d) filter (role = '{r}'), []) as c{i}" for i, r in enumerate(G.CHAIN)) + """, count_if(role = 'OUTRO') as other from l where in_chain and role is not null group by 1),
 d as (select l_orderkey as k, count(*) as n, list(distinct role) as roles, list_sort(list(distinct d)) as ids, list(distinct d) filter (not u) as bad from l where in_docs and role is not null group by 1),
 e as (select k, list(a || '>' || b) as edges from (select l_orderkey as k, l_partkey, lag(d || '/' || role) over w as a, d || '/' || role as b from l where role is not null window w as (partition by l_orderkey order by l_linenumber, l_partkey)) where a is not null and l_partkey % 20 <> 0 group by k),
 j as (select p.*, coalesce(c0, []) as c0, coalesce(c1, []) as c1, coalesce(c2, []) as c2, coalesce(c3, []) as c3, coalesce(other, 0) as other, coalesce(n, 0) as n, coalesce(roles, []) as roles, coalesce(ids, []) as ids, coalesce(bad, []) as bad, coalesce(edges, []) as edges,
  case when o_orderpriority like '5%' then 0 when o_orderkey % 11 = 0 then 2 else 1 end as nc from p join (select o_orderkey as o, o_orderpriority from orders) on o = o_orderkey left join c on c.k = o_orderkey left join d on d.k = o_orderkey left join e on e.k = o_orderkey),
 s as (select *, list_sort(list_distinct(c0 || c1 || c2 || c3)) as want, """ + ", ".join(f"len(c{i}) = 1 and len(c{i + 1}) = 1 as s{i}, list_contains(edges, c{i}[1] || '/{a}>' || c{i + 1}[1] || '/{b}') as h{i}" for i, (a, b) in enumerate(zip(G.CHAIN, G.CHAIN[1:]))) + """, nc > 0 and o_orderkey % 7 <> 0 and o_orderkey % 13 <> 0 as linked from j)"""  # fmt: skip


def _flags(current: str) -> str:
    return f"""f as (select o_orderkey as process, o_custkey as owner, c_mktsegment as category, coalesce(sphere, 'AUSENTE') as sphere, {current} as current, supported,
 other = 0 and len(c0) = 1 and len(c1) = 1 and len(c2) <= 1 and len(c3) <= 1 and (not {current} or len(c2) + len(c3) = 2) as exact,
 n = (len(c0) > 0)::int + (len(c1) > 0)::int + (len(c2) > 0)::int + (len(c3) > 0)::int and ids = want and not list_contains(roles, 'OUTRO') and list_has_all(roles, case when {current} then ['ETP', 'TR', 'EDITAL', 'CONTRATO'] else ['ETP', 'TR'] end) as documents_exact,
 not list_has_any(want, bad) as good, len(want) as k, len(want) - len(list_intersect(want, bad)) as g, roles,
 case when {current} then (s0 or s1 or s2) and (not s0 or h0) and (not s1 or h1) and (not s2 or h2) else s0 and h0 end as rel, not {current} or (nc = 1 and linked) as contract_ok, nc as n_contracts, linked as contracts_linked from s),
 g as (select process, owner, category, sphere, current, supported, exact, documents_exact, documents_exact and good as usable, coalesce(rel, false) as related, contract_ok, n_contracts::bigint as n_contracts, contracts_linked,
  case when exact and documents_exact then k else 0 end::bigint as n_expected, case when exact and documents_exact then g else 0 end::bigint as n_usable,
  supported and exact and documents_exact and good and coalesce(rel, false) and contract_ok as eligible, supported and exact and documents_exact and good and not coalesce(rel, false) as unrelated from f)"""


def _criteria(lot: str, current: str) -> str:
    role = lambda r, need: f"(select count(*) from l join g on l_orderkey = process where in_docs and role = '{r}' and current = (select cur from t) and {need})"
    floors = [(r, f"'>={_LEAST['least']}'" if i < 2 else "'no floor'", f"x >= {_LEAST['least']}" if i < 2 else "true") for i, r in enumerate(G.CHAIN)]
    parts = [
        *((name, f"'>={number}'", f"(select {counted} from b)", f"found::int >= {number}") for name, counted, number in [("processes", "count_if(eligible)", 20), ("owners", "count(distinct owner) filter (eligible)", 5), ("categories", "count(distinct category) filter (eligible)", 3), ("profile", "count_if(supported)", 20), ("processes_in_filter", "count_if(eligible)", 20)]),
        ("most_per_owner", "'<=2'", "(select coalesce(max(k), 0) from (select count(*) as k from b where eligible group by owner))", "found::int between 1 and 2"),
        ("spheres", "'E,F,M'", "(select string_agg(distinct sphere, ',' order by sphere) filter (sphere <> 'X') || case when count_if(sphere = 'X') > 0 then '+' || count_if(sphere = 'X') else '' end from b)", "(select bool_and(sphere in ('E', 'F', 'M')) from b)"),
        *((name, "(select count_if(supported) from b)", f"(select count_if(supported and exact and {more}) from b)", "found = required and found::int > 0") for name, more in [("exact_chain", "documents_exact"), ("usable_documents", "usable"), ("catalogued_relations", "related")]),
        ("complete_chains", "(select count_if(supported and current) from b)", "(select count_if(current and supported and exact and usable and related) from b)", "found = required"),
        ("contract_links", "(select count_if(n_contracts > 0) from b)", "(select count_if(contracts_linked) from b)", "found = required"),
        ("linked_contract", "(select count_if(supported and current) from b)", "(select count_if(current and supported and contract_ok) from b)", "found = required"),
        ("chain_documents_only", "'0'", role("OUTRO", "eligible"), "found::int = 0"),
        *((f"documents_{r}", f"case when (select cur from t) then '=' || (select count_if(supported) from b) else {floor} end", f"case when (select cur from t) then {role(r, 'supported')} else {role(r, 'eligible')} end", f"case when (select cur from t) then '=' || found = required else {over.replace('x', 'found::int')} end") for r, floor, over in floors),
    ]
    rows = " union all ".join(f"select '{name}' as criterion, ({required})::varchar as required, ({found})::varchar as found, '{i}' as i" for i, (name, required, found, _) in enumerate(parts))
    passed = "case i " + " ".join(f"when '{i}' then {p[3].replace('found::int', 'try_cast(found as int)')}" for i, p in enumerate(parts)) + " end"
    return f"with {_P}, {_flags(current)}, t as (select max(current) as cur from g), b as (select * from g where current = (select cur from t)), r as ({rows}) select '{lot}' as lot, criterion, required, found, {passed} as passed from r"


@query(f"with {_P}, {_flags('cur')} select * from g")
def gate_processes(spark, sf_dir):
    """Flags of every process, of the current policy and of earlier ones."""
    judged = G.judged_processes(*_laid_out(spark, sf_dir))
    return judged.withColumn("sphere", F.coalesce(F.upper(F.trim("sphere")), F.lit("AUSENTE")))


@query(f"select * from ({_criteria('current', 'cur')}) union all select * from ({_criteria('earlier', 'false')})")
def gate_lots(spark, sf_dir):
    """All criteria, for a lot with processes of the current policy and for one without."""
    processes, chain, documents, edges, contracts = _laid_out(spark, sf_dir)
    out = None
    for lot, held in (("current", processes), ("earlier", processes.withColumn("policy", F.lit(None).cast("string")))):
        rows = G.criteria(G.judged_processes(held, chain, documents, edges, contracts), documents, **_LEAST).select(F.lit(lot).alias("lot"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out
