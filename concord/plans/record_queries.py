"""Record normalisation, revision choice, caches, evaluation and document lines over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.functions import records as N
from concord.functions import text as X
from concord.operators import relational as R
from concord.plans.registry import query
from concord.session import fresh_path, table
from concord.sources import files

_FALSE = "('0', 'false', 'inactive', 'inativo', 'nao', 'não')"


@query(f"select event_id, (json_extract_string(props, '$.k') is null or lower(trim(json_extract_string(props, '$.k'))) not in {_FALSE}) as active from events")
def active_flag(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", N.active(F.get_json_object("props", "$.k")).alias("active"))


@query("""select o_orderkey, case when o_orderkey % 3 = 0 then l * 12 else l end::int as months from (select o_orderkey, (o_custkey % 9 + 1) as l from orders)""")
def duration_months(spark, sf_dir):
    n = (F.col("o_custkey") % 9 + 1).cast("string")
    said = F.when(F.col("o_orderkey") % 3 == 0, F.concat(n, F.lit(" anos"))).when(F.col("o_orderkey") % 3 == 1, F.concat(n, F.lit(" Meses"))).otherwise(n)
    return table(spark, sf_dir, "orders").select("o_orderkey", N.months(said).alias("months"))


_ROMAN_SQL = "['I','II','III','IV','V','VI','VII','VIII','IX','X','XI','XII','XIII','XIV','XV'][p_size]"


@query(f"select p_partkey, case when {_ROMAN_SQL} is null then 'annex ' || p_size else 'annex ' || p_size || '|annex ' || {_ROMAN_SQL} end as anchors, try_cast(nullif(regexp_extract(p_brand, '[0-9]+'), '') as bigint) as item_number from part")
def anchor_variants(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(N.anchor_variants("annex", F.col("p_size")), "|").alias("anchors"), N.first_number(F.col("p_brand")).alias("item_number"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, case l_linenumber % 3 when 0 then '>=' when 1 then '<' else '=' end as operator, l_quantity::int::varchar as operand from lineitem""")
def requirement_operator(spark, sf_dir):
    said = F.concat(F.when(F.col("l_linenumber") % 3 == 0, ">= ").when(F.col("l_linenumber") % 3 == 1, " <").otherwise(""), F.col("l_quantity").cast("int").cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.comparison(said).alias("x")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "x.*")


@query("select o_orderkey, (case when printf('%.2f', o_totalprice) like '%.00' then replace(printf('%.2f', o_totalprice), '.00', '') else rtrim(printf('%.2f', o_totalprice), '0') end) as canonical, lower(o_orderpriority) as priority from orders")
def canonical_values(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", N.canonical_value(F.format_string("%.2f", "o_totalprice")).alias("canonical"), N.canonical_value(F.col("o_orderpriority")).alias("priority"))


@query("""select event_id, sha256('{"event_type":"' || event_type || '","user_id":' || user_id || '}') as key from events""")
def stable_keys(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", N.stable_key(["user_id", "event_type"]).alias("key"))


_PAYLOADS = ["'[]'", "'{\"items\": []}'", "'[[], ' || user_id || ']'", "'{\"items\": [], \"total\": 3}'", "' '", "'{\"x\": \"\"}'", "'{\"total\": 3}'", "'{\"data\": [1], \"page\": 2}'", "'[0, ' || user_id || ']'", "props"]


@query("select event_type, count_if(event_id % 10 < 6)::bigint as n_empty, count(*)::bigint as n from events group by event_type")
def empty_payload(spark, sf_dir):
    """Answers of every form, the first six of them empty; props hold a number, which is content."""
    said = F.expr("case event_id % 10 " + " ".join(f"when {k} then {p}" for k, p in enumerate(_PAYLOADS)) + " end")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(N.is_empty_payload(said)).alias("n_empty"), F.count("*").alias("n"))


@query("""select page_id, regexp_extract(url, '^[a-z]+') as scheme, regexp_extract(url, '^[a-z]+://([^/?]+)', 1) as host, try_cast(nullif(regexp_extract(url, '/([0-9]+)([?].*)?$', 1), '') as bigint) as number,
 not regexp_matches(url, '^https?://[^/]+/[a-z]{2}/[0-9]+') as invalid from pages""")
def purchase_link_parse(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract(url, "^[a-z]+", 0).alias("scheme"),
        F.regexp_extract(url, "^[a-z]+://([^/?]+)", 1).alias("host"),
        F.nullif(F.regexp_extract(url, "/([0-9]+)([?].*)?$", 1), F.lit("")).try_cast("long").alias("number"),
        (~url.rlike("^https?://[^/]+/[a-z]{2}/[0-9]+")).alias("invalid"),
    )


@query("""select page_id, case when page_id % 5 = 0 then 'pdf' when page_id % 5 = 1 then 'zip' when page_id % 5 = 2 then 'rtf' when page_id % 5 = 3 then 'xyz' else 'bin' end as kind from pages""")
def magic_sniff(spark, sf_dir):
    """Pages behind the first bytes of a format, in their exact case, and with or without a usable file name."""
    lead = F.element_at(F.array(*map(F.lit, ("%PDF-1.7\n", "PK\x03\x04", "{\\rtf1 ", "%pdf pk {\\RTF ", "pk"))), (F.col("page_id") % 5 + 1).cast("int"))
    name = F.when(F.col("page_id") % 5 == 4, "name").otherwise("a.b.X-y z!")
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(lead, F.coalesce("html", F.lit(""))).cast("binary").alias("content"), name.alias("name"))
    return pages.select("page_id", files.kind_of("content", "name").alias("kind"))


@query("""select o_orderkey, coalesce(case when o_orderstatus = 'F' then null else nullif(o_orderpriority, '') end, c_mktsegment) as label, year(o_orderdate)::int as year,
 case when o_custkey is null then 'no_buyer' when c_custkey is null then 'unknown_buyer' when o_totalprice <= 0 then 'no_value' when o_orderdate < timestamp '1996-01-01' then 'before_period' end as invalid_reason
 from orders left join customer on o_custkey = c_custkey""")
def purchase_normalise(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    reasons = [(F.col("o_custkey").isNull(), "no_buyer"), (F.col("c_custkey").isNull(), "unknown_buyer"), (F.col("o_totalprice") <= 0, "no_value"), (F.year("o_orderdate") < 1996, "before_period")]
    label = N.first_filled(F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")), F.col("c_mktsegment"))
    return joined.select("o_orderkey", label.alias("label"), F.year("o_orderdate").alias("year"), R.first_reason(reasons).alias("invalid_reason"))


@query("""with y as (select distinct year(o_orderdate)::int as year from orders), t as (select unnest(['goods', 'services', 'works']) as term)
 select year, term, row_number() over (order by (year = 1998) desc, year desc, term)::bigint as rank from y, t""")
def query_terms(spark, sf_dir):
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    terms = years.select("year", F.explode(F.array(*(F.lit(t) for t in ("goods", "services", "works")))).alias("term"))
    # a handful of rows: calendar years times three terms
    return terms.withColumn("rank", F.row_number().over(Window.orderBy((F.col("year") == 1998).desc(), F.col("year").desc(), "term")).cast("long"))


@query("""select o_orderkey, count(l_partkey)::bigint as n_items, coalesce(string_agg(l_returnflag, '' order by l_returnflag), '') as flags from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey""")
def attachment_lists(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("l_partkey").alias("n"), F.array_join(F.array_sort(F.collect_list("l_returnflag")), "").alias("f"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(items, "o_orderkey", "left").select("o_orderkey", F.coalesce("n", F.lit(0)).cast("long").alias("n_items"), F.coalesce("f", F.lit("")).alias("flags"))


_ATTR = "select l_orderkey // 2 as pair_id, l_orderkey % 2 as side, lower(trim(l_returnflag)) as attribute, max_by(l_quantity, (l_linenumber, l_partkey, l_suppkey, l_quantity)) as v from lineitem group by all"


@query(f"with r as ({_ATTR}) select a.pair_id::bigint as pair_id, attribute, a.v as left_value, b.v as right_value from r a join r b using (pair_id, attribute) where a.side = 0 and b.side = 1 and a.v <> b.v")
def requirement_join(spark, sf_dir):
    last = table(spark, sf_dir, "lineitem").groupBy(F.floor(F.col("l_orderkey") / 2).alias("pair_id"), F.lower(F.trim("l_returnflag")).alias("attribute"))
    at = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")  # repeated lines: the largest
    side = lambda n: F.max_by(F.when(F.col("l_orderkey") % 2 == n, F.col("l_quantity")), F.when(F.col("l_orderkey") % 2 == n, at))
    return last.agg(side(0).alias("left_value"), side(1).alias("right_value")).where("left_value <> right_value")


@query("""select c_custkey, (select max_by(o_orderkey, (o_orderpriority = '1-URGENT', o_orderdate, o_orderkey)) from orders where o_custkey = c_custkey) as chosen from customer""")
def promoted_link(spark, sf_dir):
    best = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderkey", F.struct(F.col("o_orderpriority") == "1-URGENT", "o_orderdate", "o_orderkey")).alias("chosen"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(best, "c_custkey", "left")


@query("select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) <= 5")
def per_owner_cap(spark, sf_dir):
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return table(spark, sf_dir, "orders").withColumn("rn", rank).where("rn <= 5").select("o_custkey", "o_orderkey")


@query("""with s as (select p_partkey, p_brand, replace(p_name, ' ', '-') as base from part), n as (select *, row_number() over (partition by p_brand, base order by p_partkey) as k from s)
 select p_partkey, base || case when k > 1 then '-' || case when k < 10 then '0' else '' end || k else '' end as id from n""")
def id_suffix(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", X.slug(F.col("p_name")).alias("base"))
    k = F.row_number().over(Window.partitionBy("p_brand", "base").orderBy("p_partkey"))
    return parts.withColumn("k", k).select("p_partkey", F.concat("base", F.when(F.col("k") > 1, F.format_string("-%02d", "k")).otherwise("")).alias("id"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() over (partition by l_orderkey order by case when l_returnflag = 'N' then null else l_quantity end nulls last, l_linenumber, l_partkey, l_suppkey)::bigint as position from lineitem""")
def reading_order(spark, sf_dir):
    y = F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_quantity"))
    w = Window.partitionBy("l_orderkey").orderBy(y.asc_nulls_last(), "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.row_number().over(w).cast("long").alias("position"))


@query("""with g as (select l_orderkey, l_quantity, l_quantity - lag(l_quantity) over (partition by l_orderkey order by l_quantity) as gap from lineitem),
 c as (select l_orderkey, l_quantity, sum(case when gap > 3 then 1 else 0 end) over (partition by l_orderkey order by l_quantity) as cluster from g)
 select l_orderkey, cluster::bigint as cluster, count(*)::bigint as n, min(l_quantity) as low, max(l_quantity) as high from c group by all""")
def gap_clusters(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    return R.gap_clusters(lines, "l_orderkey", "l_quantity", 3.0).groupBy("l_orderkey", "cluster").agg(F.count("*").alias("n"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))


@query("""with d as (select user_id, strftime(ts, '%Y-%m-%d') as day, count(distinct event_type) as roles, count(*) as n from events group by all),
 b as (select user_id, max_by(day, (roles, n, day)) as day from d group by user_id), h as (select e.user_id, b.day, list_distinct(list(e.event_type) filter (strftime(e.ts, '%Y-%m-%d') = b.day)) as own, list_distinct(list(e.event_type)) as ever from events e join b using (user_id) group by all)
 select user_id, day, len(own)::bigint as n_own, len(list_filter(ever, lambda x: not list_contains(own, x)))::bigint as n_inherited from h""")
def best_acceptance(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.collect_set("event_type").alias("roles"), F.count("*").alias("n"))
    best = days.groupBy("user_id").agg(F.max_by(F.struct("day", "roles"), F.struct(F.size("roles"), "n", "day")).alias("b"), F.array_distinct(F.flatten(F.collect_set("roles"))).alias("ever"))
    return best.select("user_id", "b.day", F.size("b.roles").cast("long").alias("n_own"), F.size(F.array_except("ever", "b.roles")).cast("long").alias("n_inherited"))


@query("""with e as (select user_id, json_extract(props, '$.k')::int as k, event_id, event_type, ts from events where event_type <> 'view')
 select user_id, k, max_by(event_id, (ts, event_id)) as event_id, max_by(event_type, (ts, event_id)) as status from e group by user_id, k""")
def policy_upsert(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("event_type <> 'view'").select("user_id", F.get_json_object("props", "$.k").cast("int").alias("k"), "ts", "event_id", F.col("event_type").alias("status"))
    return R.latest(events, ["user_id", "k"], ["ts", "event_id"]).drop("ts")


@query("""select strftime(ts, '%Y-%m-%d') as day, sum(case when value >= 5 then floor(value)::bigint else 0 end)::bigint as used, count_if(value < 5)::bigint as quarantined, count_if(value < 5) > 0 as closed from events group by 1""")
def budget_quarantine(spark, sf_dir):
    bad = F.col("value") < 5
    days = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return days.agg(F.sum(F.when(~bad, F.floor("value")).otherwise(0)).cast("long").alias("used"), F.count_if(bad).alias("quarantined")).withColumn("closed", F.col("quarantined") > 0)


@query("select source, count(*)::bigint as n, count_if(length(text) = n_chars)::bigint as valid, count(distinct sha256(text))::bigint as n_contents from documents group by source")
def revalidation(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.length("text") == F.col("n_chars")).alias("valid"), F.count_distinct(F.sha2("text", 256)).alias("n_contents"))


@query("""select event_id, user_id || ':' || event_type || case when value > 100 then ':' || json_extract_string(props, '$.k') else '' end as target, case when value > 100 then 'item' else 'field' end as level, event_type as section from events""")
def target_address(spark, sf_dir):
    target = F.concat_ws(":", "user_id", "event_type", F.when(F.col("value") > 100, F.get_json_object("props", "$.k")))
    parts = F.split("target", ":")
    return table(spark, sf_dir, "events").select("event_id", target.alias("target")).select("event_id", "target", F.when(F.size(parts) == 3, "item").otherwise("field").alias("level"), parts[1].alias("section"))


_FACTS = "select distinct l_orderkey // 2 as pair_id, l_linenumber, l_returnflag, l_orderkey % 2 as side from lineitem"


@query(f"""with f as ({_FACTS}), hit as (select l_returnflag, count(*) as n from (select pair_id, l_linenumber, l_returnflag from f where side = 0 intersect select pair_id, l_linenumber, l_returnflag from f where side = 1) group by 1)
 select f.l_returnflag as family, count_if(side = 0)::bigint as n_truth, count_if(side = 1)::bigint as n_found, any_value(coalesce(hit.n, 0))::bigint as n_hit from f left join hit using (l_returnflag) group by f.l_returnflag""")
def fact_accuracy(spark, sf_dir):
    side = F.col("l_orderkey") % 2
    facts = table(spark, sf_dir, "lineitem").groupBy(F.floor(F.col("l_orderkey") / 2).alias("pair_id"), "l_linenumber", F.col("l_returnflag").alias("family")).agg(F.bool_or(side == 0).alias("truth"), F.bool_or(side == 1).alias("found"))
    return facts.groupBy("family").agg(F.count_if("truth").alias("n_truth"), F.count_if("found").alias("n_found"), F.count_if(F.col("truth") & F.col("found")).alias("n_hit"))


def _lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "l"))


@query("""select doc_id, count_if(trim(l) <> '' and not starts_with(l, '|'))::bigint as n_citable, count_if(regexp_matches(l, '(license|licensed|copyright)') and regexp_matches(l, '[0-9]+'))::bigint as n_quantified
 from (select doc_id, unnest(string_split(text, chr(10))) as l from documents) group by doc_id""")
def citable_lines(spark, sf_dir):
    line = F.col("l")
    citable = (F.trim(line) != "") & ~line.startswith("|")
    quantified = line.rlike("(license|licensed|copyright)") & line.rlike("[0-9]+")
    return _lines(spark, sf_dir).groupBy("doc_id").agg(F.count_if(citable).alias("n_citable"), F.count_if(quantified).alias("n_quantified"))


@query("""with q as (select doc_id, trim(substr(text, 11, 20)) as quote, text from documents where text is not null),
 l as (select doc_id, quote, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) as ord from q)
 select doc_id, min(ord)::bigint as block from l where quote <> '' and contains(l, quote) group by doc_id""")
def reanchor(spark, sf_dir):
    quoted = table(spark, sf_dir, "documents").select("doc_id", F.trim(F.substring("text", 11, 20)).alias("quote"), F.posexplode(F.split("text", "\n")).alias("ord", "l"))
    return quoted.where((F.col("quote") != "") & F.contains("l", "quote")).groupBy("doc_id").agg((F.min("ord") + 1).cast("long").alias("block"))


@query("select c_custkey, c_name, c_mktsegment from customer")
def jsonl_catalogue(spark, sf_dir):
    """The catalogue written as JSON lines and scanned again with its schema."""
    rows, path = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), fresh_path(spark, "jsonl")
    rows.write.json(path)
    return spark.read.schema(rows.schema).json(path)
