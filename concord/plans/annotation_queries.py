"""Annotations, evidence, the confirmed view and scans over orders whose lines are laid out as blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.operators import annotations as A
from concord.operators import review as V
from concord.plans.registry import query
from concord.session import table

_ROLE = "case when l_linenumber % 2 = 0 then 'ETP' else 'TR' end"


def _lines(spark, sf_dir) -> DataFrame:
    """Lines without those that repeat an order's part, each with its process, role, document and block."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(*(F.min(c).alias(c) for c in ("l_linenumber", "l_quantity", "l_suppkey", "l_returnflag", "l_linestatus")))
    role = F.expr(_ROLE)
    return lines.withColumn("process", F.col("l_orderkey").cast("string")).withColumn("role", role).withColumn("document_id", F.concat("process", F.lit(":"), F.lower(role))).withColumn("block", F.concat(F.lit("b-"), "l_partkey"))


def _documents(lines: DataFrame) -> DataFrame:
    documents = lines.select("process", "role", "document_id", "l_orderkey").distinct().where("l_orderkey % 9 <> 0")
    digest = F.sha2("document_id", 256)
    return documents.select("process", "role", "document_id", digest.alias("sha256"), F.when(F.col("l_orderkey") % 10 == 3, F.sha2(F.lit("changed"), 256)).otherwise(digest).alias("stored"))


def _blocks(lines: DataFrame) -> DataFrame:
    return lines.where("l_partkey % 15 <> 0").select("document_id", "block", F.concat(F.lit("Quantidade: "), F.col("l_quantity").cast("int"), F.lit(" unidades")).alias("text"))


_L = f"""l as (select *, {_ROLE} as role, l_orderkey || ':' || lower({_ROLE}) as doc, 'b-' || l_partkey as block from (select l_orderkey, l_partkey, min(l_linenumber) as l_linenumber, min(l_quantity)::int as q, min(l_suppkey) as l_suppkey, min(l_returnflag) as l_returnflag, min(l_linestatus) as l_linestatus from lineitem group by 1, 2)),
 p as (select *, case l_suppkey % 4 when 3 then null else 'item ' || l_suppkey % 3 end as item, l_partkey % 2 = 0 as is_field, l_partkey % 2 = 0 or l_partkey % 3 > 0 as named, case when l_partkey % 5 > 0 then 'part ' || l_partkey end as description,
  case when l_orderkey % 9 = 0 then 'document_unknown' when l_orderkey % 10 = 3 then 'digest_differs' when l_partkey % 15 = 0 then 'block_unknown' when not (l_partkey % 2 = 0 or l_partkey % 3 > 0) then 'name_missing' end as error from l)"""  # fmt: skip


def _annotations(lines: DataFrame) -> DataFrame:
    item = F.when(F.col("l_suppkey") % 4 != 3, F.concat(F.lit("item "), F.col("l_suppkey") % 3))
    field = F.when(F.col("l_partkey") % 2 == 0, "QUANTITY")
    attribute = F.when((F.col("l_partkey") % 2 != 0) & (F.col("l_partkey") % 3 > 0), "size")
    description = F.when(F.col("l_partkey") % 5 > 0, F.concat(F.lit("part "), "l_partkey")).otherwise("")
    return lines.select("process", "role", "block", F.lit(1).alias("page"), item.alias("item"), field.alias("field_type"), attribute.alias("attribute"), F.col("l_quantity").cast("int").alias("value"), description.alias("description"), F.col("l_partkey").alias("pos"), "l_orderkey", "l_partkey")


@query(f"""with {_L} select l_orderkey, l_partkey, case when is_field then 'field' else 'requirement' end as kind, case when is_field then 'QUANTITY' when named then 'size' end as name,
 case when l_orderkey % 9 <> 0 and l_partkey % 15 <> 0 then 'Quantidade: ' || q || ' unidades' end as quote, case when l_orderkey % 9 <> 0 then doc end as document_id, error from p""")
def placed_annotations(spark, sf_dir):
    """Annotations joined with the catalogue, the files' digests and blocks; what is missing is named."""
    lines = _lines(spark, sf_dir)
    return A.placed(_annotations(lines), _documents(lines), _blocks(lines)).select("l_orderkey", "l_partkey", "kind", "name", "quote", "document_id", "error")


@query(f"""with {_L} select l_orderkey::varchar as process, doc as document_id, item, max_by(description, l_partkey) filter (description is not null) as description, min_by(block, l_partkey) as block, count_if(is_field)::bigint as n_fields, count_if(not is_field)::bigint as n_requirements
 from p where error is null and item is not null group by all""")
def annotated_items(spark, sf_dir):
    """Items that the sound annotations of a lot make, with description and evidence."""
    lines = _lines(spark, sf_dir)
    return A.annotated_items(A.placed(_annotations(lines), _documents(lines), _blocks(lines)).where("error is null"))


@query(f"""with {_L}, j as (select l_orderkey as k, case when l_orderkey % 9 = 0 then 'document_unknown' when l_partkey % 15 = 0 then 'block_unknown' when l_suppkey % 8 = 0 then 'bad_page' when q >= 40 then 'quote_absent' else 'ok' end as outcome from l)
 select k::varchar as process, count(*)::bigint as total, count_if(outcome = 'ok')::bigint as ok, round(count_if(outcome = 'ok') / count(*), 4) as share, 10 * count_if(outcome = 'ok') >= 8 * count(*) as passed,
 count_if(outcome = 'document_unknown')::bigint as document_unknown, count_if(outcome = 'block_unknown')::bigint as block_unknown, count_if(outcome = 'bad_page')::bigint as bad_page, count_if(outcome = 'quote_absent')::bigint as quote_absent from j group by k""")
def evidence_share(spark, sf_dir):
    """Evidence of every process opened again in its blocks: the share that stands, and why the rest does not."""
    lines = _lines(spark, sf_dir)
    quote = F.concat(F.col("l_quantity").cast("int"), F.when(F.col("l_quantity").cast("int") >= 40, " caixas").otherwise(" unidades"))
    page = F.when(F.col("l_suppkey") % 8 != 0, 1 + F.col("l_suppkey") % 3)
    judged = A.opened_again(lines.select("process", "document_id", "block", page.alias("page"), quote.alias("quote")), _documents(lines), _blocks(lines))
    why = judged.groupBy("process").agg(*(F.count_if(F.col("outcome") == o).alias(o) for o in ("document_unknown", "block_unknown", "bad_page", "quote_absent")))
    return A.opened_share(judged, 0.8).join(why, "process")


@query(f"""with {_L}, f as (select *, case l_returnflag when 'A' then 'CONFIRMED' when 'R' then 'REJECTED' end as status from p), i as (select l_orderkey, doc, item, bool_or(l_linestatus = 'F') as ev, bool_or(coalesce(status = 'CONFIRMED', false)) as sure from f where item is not null group by all)
 select distinct l_orderkey::varchar as process, doc as document_id, null as item, 'document' as level, doc as id, null as value from l union all
 select distinct l_orderkey::varchar, doc, null, 'section', 's' || l_linenumber, null from l union all
 select l_orderkey::varchar, doc, item, 'item', item, null from i where ev or sure union all
 select l_orderkey::varchar, doc, item, case when is_field then 'field' else 'requirement' end, block, q::varchar from f where status = 'CONFIRMED' union all
 select o_orderkey::varchar, null, null, 'finding', o_orderstatus, null from orders""")
def confirmed_levels(spark, sf_dir):
    """The confirmed view: facts that are confirmed, items with evidence or a confirmed fact, all documents, sections and findings."""
    lines = _lines(spark, sf_dir)
    facts = _annotations(lines).join(lines.select("l_orderkey", "l_partkey", "document_id", "l_returnflag", "l_linestatus"), ["l_orderkey", "l_partkey"])
    status = F.when(F.col("l_returnflag") == "A", A.CONFIRMED).when(F.col("l_returnflag") == "R", "REJECTED")
    facts = facts.withColumn("status", status).withColumn("kind", F.when(F.col("field_type").isNotNull(), "field").otherwise("requirement")).withColumn("id", F.col("block"))
    items = facts.where("item is not null").groupBy("process", "document_id", "item").agg(F.bool_or(F.col("l_linestatus") == "F").alias("evidence"))
    documents = lines.select("process", "document_id").distinct()
    sections = lines.select("process", "document_id", F.concat(F.lit("s"), "l_linenumber").alias("id")).distinct()
    findings = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("process"), F.col("o_orderstatus").alias("id"))
    return A.confirmed_export(documents, sections, items, facts, findings)


@query("""select event_id, case event_type when 'view' then 'DELIVERY_DEADLINE' when 'click' then 'WARRANTY_TERM,PAYMENT_DEADLINE' when 'purchase' then 'CONTRACT_TERM' end as families,
 case event_type when 'view' then 'PRAZO DE ENTREGA: ' when 'click' then 'Garantia e pagamento em ' else 'Vigência do contrato ' end || user_id || case event_type when 'view' then ' (trinta) DIAS' when 'click' then ' meses' else ' anos' end as body
 from events where event_type in ('view', 'click', 'purchase') and event_id % 4 <> 0""")
def term_scan(spark, sf_dir):
    """Clauses that name a family of terms, a quarter of them without a quantity of time, others with one but no family."""
    kind, n = F.col("event_type"), F.col("user_id").cast("string")
    unit = lambda u: F.when(F.col("event_id") % 4 == 0, F.lit(" unidades")).otherwise(F.lit(u))
    text = (
        F.when(kind == "view", F.concat(F.lit(" PRAZO DE\n ENTREGA: "), n, unit(" (trinta) DIAS")))
        .when(kind == "click", F.concat(F.lit("Garantia e pagamento em "), n, unit(" meses")))
        .when(kind == "purchase", F.concat(F.lit("Vigência do contrato "), n, unit(" anos")))
        .otherwise(F.concat(F.lit("Entrega em "), n, F.lit(" dias")))
    )
    return A.term_scan(table(spark, sf_dir, "events").select("event_id", text.alias("text"))).select("event_id", "families", "body")


@query("""with i as (select user_id, max_by(event_type, (ts, event_id)) as last from events where event_id % 3 <> 0 group by user_id)
 select distinct user_id from events where user_id not in (select user_id from i where last in ('view', 'error'))""")
def inspected_anew(spark, sf_dir):
    """Users whose latest inspection asks for another one, or who had none."""
    events = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "view", "LIMITE_ORGAO").when(F.col("event_type") == "error", "FORA_DO_ESCOPO").otherwise("SEM_CADEIA")
    inspections = events.where("event_id % 3 <> 0").select(F.col("user_id").alias("number"), status.alias("status"), F.struct("ts", "event_id").alias("at"))
    return V.inspected_anew(events.select(F.col("user_id").alias("number")).distinct(), inspections).select(F.col("number").alias("user_id"))


@query("""select doc_id, doc_id % 5 <> 0 and doc_id % 7 <> 0 and doc_id % 3 <> 0 and doc_id % 4 <> 0 and coalesce(length(text), 0) > 0 and doc_id % 11 <> 0 as usable from documents""")
def recognition_usable(spark, sf_dir):
    """Recognised texts that can be audited: some not opened or not used, some whose digest or version is missing, some that still need recognition."""
    d = F.col("doc_id")
    sha = F.when(d % 3 == 0, F.sha2("text", 224)).otherwise(F.upper(F.sha2(F.coalesce("text", F.lit("")), 256)))
    usable = V.recognition_usable(d % 5 != 0, F.when(d % 7 != 0, F.lit(True)), sha, F.when(d % 4 == 0, " ").otherwise("1"), F.lit("pt"), F.length("text"), F.when(d % 11 == 0, F.lit(True)))
    return table(spark, sf_dir, "documents").select("doc_id", usable.alias("usable"))
