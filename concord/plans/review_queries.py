"""Review states, caches of derived texts, identifiers and confirmation order over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from concord.functions import records as N
from concord.operators import review as V
from concord.plans.registry import query
from concord.session import table

_EVENTS = "select *, case event_type when 'click' then 'CONFIRM' when 'purchase' then 'EDIT_AND_CONFIRM' else 'REJECT' end as action, user_id as target, (ts, event_id) as seq from events where event_type in ('click', 'purchase', 'error')"


@query(f"""with t as (select distinct user_id as target, case when user_id % 7 = 0 then '' else 'fact ' || user_id end as quote from events),
 e as (select e.*, t.quote <> '' and (action <> 'EDIT_AND_CONFIRM' or event_id % 3 > 0) or action = 'REJECT' as ok, event_id % 3 as kind from ({_EVENTS}) e join t using (target)),
 f as (select target, max_by(action, seq) filter (ok) as action, max_by(value, seq) filter (ok and action = 'EDIT_AND_CONFIRM' and event_id % 5 > 0) as value, max_by(kind, seq) filter (ok and action = 'EDIT_AND_CONFIRM') as kind, count(*) as n, count_if(not ok) as refused from e group by target)
 select t.target::bigint as target, case when action is null then 'EXTRACTED' when action = 'REJECT' then 'REJECTED' else 'CONFIRMED' end as status, value, coalesce(case kind when 1 then 'fact' when 2 then 'late' end, t.quote) as quote, case kind when 1 then 0 when 2 then 1 end::int as pos,
 coalesce(n, 0)::bigint as n_events, coalesce(refused, 0)::bigint as n_refused from t left join f using (target)""")
def review_states(spark, sf_dir):
    """Users are targets; edits quote a block of the target's document, or words that stand in none and are refused."""
    events = table(spark, sf_dir, "events")
    ids = events.select("user_id").distinct()
    evidence = F.when(F.col("user_id") % 7 == 0, "").otherwise(F.concat(F.lit("fact "), F.col("user_id").cast("string")))
    targets = ids.select(F.col("user_id").cast("long").alias("target"), F.col("user_id").alias("document_id"), F.lit(None).cast("double").alias("value"), evidence.alias("quote"))
    blocks = ids.select(F.col("user_id").alias("document_id"), F.posexplode(F.array(F.lit("the fact stands here"), F.lit("a late fact"))).alias("pos", "text"))
    action = F.when(F.col("event_type") == "click", V.CONFIRM).when(F.col("event_type") == "purchase", V.EDIT).otherwise(V.REJECT)
    quote = F.when(F.col("event_id") % 3 == 1, " fact ").when(F.col("event_id") % 3 == 2, "late").otherwise("absent")
    said = events.where("event_type in ('click', 'purchase', 'error')").select(F.col("user_id").cast("long").alias("target"), F.struct("ts", "event_id").alias("seq"), action.alias("action"), F.when(F.col("event_id") % 5 > 0, F.col("value")).alias("value"), quote.alias("quote"))
    return V.review_state(targets, said, blocks)


@query("""select doc_id, case when text is not null and doc_id % 4 <> 0 and doc_id % 6 <> 5 then length(text) end::bigint as cached from documents""")
def derived_cache(spark, sf_dir):
    """Texts cached under their key, in two versions of which the later counts; some with a wrong digest, some keys unusable."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    language = F.when(F.col("doc_id") % 6 == 5, " ").otherwise(" PT ")
    key = V.derived_key(F.sha2(F.concat(F.lit("source "), F.col("doc_id").cast("string")), 256), language, F.lit("1"), F.lit('{"dpi":200}'))
    keyed = docs.withColumn("key", key)
    good = F.when(F.col("doc_id") % 4 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.sha2("text", 256))
    old = F.concat(F.lit("old "), F.coalesce("text", F.lit("")))
    entries = F.array(F.struct(F.col("text").alias("text"), good.alias("text_sha256"), F.lit(2).alias("at")), F.struct(F.when(F.col("doc_id") % 4 > 0, old).alias("text"), F.sha2(old, 256).alias("text_sha256"), F.lit(1).alias("at")))
    cache = keyed.where("key is not null and text is not null").select("key", F.inline(entries))
    return V.cached_texts(cache, keyed.select("doc_id", "key")).select("doc_id", F.length("text").cast("long").alias("cached"))


_SHORT, _CONF = "length(text) < 40", "case turn % 4 when 0 then 90.0 when 1 then 20.0 when 2 then 120.0 end"
_CHARS = "length(trim(regexp_replace(text, '\\s+', ' ', 'g')))"
_WORDS = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"


@query(f"""select conv_id, turn, concat_ws(',', case when {_CHARS} < 40 then 'few_chars' end, case when {_WORDS} < 8 then 'few_words' end, case when turn % 4 >= 2 then 'bad_confidence' end, case when turn % 4 = 1 then 'low_confidence' end,
 case when conv_id % 2 = 0 then 'fewer_chars_than_before' end, case when conv_id % 2 = 0 then 'fewer_words_than_before' end) as reasons from (select * from conversations where text is not null)""")
def recognition_accepted(spark, sf_dir):
    """Turns as recognised pages, of which every second conversation had one word more before."""
    rows = table(spark, sf_dir, "conversations").where("text is not null")
    confidence = F.when(F.col("turn") % 4 == 0, 90.0).when(F.col("turn") % 4 == 1, 20.0).when(F.col("turn") % 4 == 2, 120.0)
    before = F.when(F.col("conv_id") % 2 == 0, F.concat("text", F.lit(" more"))).otherwise("")
    return rows.select("conv_id", "turn", F.array_join(V.recognised_reasons(F.col("text"), confidence, before), ",").alias("reasons"))


@query("""select o_orderkey, o_orderkey || '-1' as process, o_orderkey || '-1#tr-' || case when k < 10 then '0' else '' end || k as document, case when o_custkey % 2 = 0 then o_custkey % 90 else 7 end::int as page,
 not (o_orderdate < timestamp '1995-01-01' or o_orderdate >= timestamp '1998-01-01') or o_custkey % 10 = 3 as in_period from (select *, case when o_custkey % 3 = 0 then 5 else o_custkey % 200 end as k from orders)""")
def identifiers(spark, sf_dir):
    """Process and document ids, pages of block ids, and dates within a period, where an unknown one passes."""
    process = V.process_id(F.concat(F.col("o_orderkey").cast("string"), F.lit("/1")))
    seq = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") % 200)
    block = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("doc:p-"), F.lpad((F.col("o_custkey") % 90).cast("string"), 4, "0"), F.lit(":b-0001"))).otherwise("doc:b-1")
    day = F.when(F.col("o_custkey") % 10 != 3, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", process.alias("process"), V.document_id(process, F.lit("TR"), seq, F.lit(5)).alias("document"), V.page_of(block, F.lit(7)).alias("page"), N.in_period(N.iso_date(day), "1995-01-01", "1997-12-31").alias("in_period"))


@query("""select o_orderkey, row_number() over (partition by o_custkey order by o_totalprice <= 50000, o_orderpriority <> '1-URGENT', o_orderstatus <> 'F', o_orderkey)::bigint as turn,
 row_number() over (partition by o_custkey order by o_totalprice <= 50000, o_orderpriority <> '1-URGENT', o_orderstatus <> 'F', o_orderkey) <= 5 as within_cap from orders""")
def confirmation_order(spark, sf_dir):
    """Which of an owner's purchases are looked at first: complete ones, then by mode and instrument; at most five of an owner are accepted."""
    first = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice") <= 50000, F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus") != "F", "o_orderkey")
    ranked = table(spark, sf_dir, "orders").select("o_orderkey", F.row_number().over(first).cast("long").alias("turn"))
    return ranked.withColumn("within_cap", F.col("turn") <= 5)
