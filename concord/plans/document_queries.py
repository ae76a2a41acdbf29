"""Tables, word confidences, tasks, assembly and annotations over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from concord.functions import text as X
from concord.operators.tables import tabular_items
from concord.plans.registry import query
from concord.session import table

_POS = "row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity, l_extendedprice)"


@query(f"""with l as (select *, {_POS} as pos, l_orderkey % 5 as kind from lineitem where l_orderkey % 5 <> 4)
 select l_orderkey::bigint as table_id, 'item-' || lpad(l_linenumber::varchar, 4, '0') || case when row_number() over (partition by l_orderkey, l_linenumber order by pos) > 1
  then '-' || lpad((row_number() over (partition by l_orderkey, l_linenumber order by pos))::varchar, 2, '0') else '' end as item_id,
 'part ' || l_partkey as description, l_quantity::int::double as quantity, case kind when 0 then l_returnflag when 3 then 'CX' else 'UN' end as unit, case when kind <> 1 then l_partkey + 0.5 end::double as unit_price,
 case when kind = 3 then l_partkey * 2 end::double as total_price, case when kind = 3 then l_suppkey::varchar end as code from l""")
def table_items(spark, sf_dir):
    """Each order's lines laid out as a table: with headings in one of two orders and a closing total, without headings in four or seven columns, or as a table of risks."""
    lines = table(spark, sf_dir, "lineitem").withColumn("row", F.expr(_POS)).withColumn("kind", F.col("l_orderkey") % 5)
    item, text, amount, price = F.col("l_linenumber").cast("string"), F.concat(F.lit("part "), "l_partkey"), F.col("l_quantity").cast("int").cast("string"), F.concat(F.col("l_partkey").cast("string"), F.lit(",50"))
    wide = F.array(item, text, F.col("l_suppkey").cast("string"), F.lit("cx"), amount, price, F.concat(F.lit("R$ "), (F.col("l_partkey") * 2).cast("string"), F.lit(",00")))
    odd = F.col("l_linenumber") % 2 == 1
    # an odd line of the second kind has its text in the next column
    said = F.when(F.col("kind") == 0, F.array(item, text, F.lower("l_returnflag"), amount, price)).when(F.col("kind") == 1, F.array(item, F.when(odd, "").otherwise(text), F.when(odd, text).otherwise(""), amount)).when(F.col("kind") == 3, wide).otherwise(F.array(item, text, amount, price))
    head = F.when(F.col("kind") == 0, F.array(*map(F.lit, ("Item", "Descrição", "Unid.", "Qtd.", "Valor unitário")))).otherwise(F.array(*map(F.lit, ("#", "Discriminação", "Obs.", "Quantidade"))))
    # the first line of a table also carries its heading and its total
    total = F.struct(F.lit(1_000_000).alias("row"), F.when(F.col("kind") == 4, F.array(F.lit("Grau do risco"), F.lit("9 alto"))).otherwise(F.array(F.lit("Total"), F.lit("9 soma"))).alias("said"))
    here = F.struct("row", said.alias("said"))
    rows = F.when((F.col("row") == 1) & (F.col("kind") < 2), F.array(F.struct(F.lit(0).alias("row"), head.alias("said")), here, total)).when((F.col("row") == 1) & (F.col("kind") == 4), F.array(here, total)).otherwise(F.array(F.struct((F.col("row") - F.when(F.col("kind").isin(2, 3), 1).otherwise(0)).alias("row"), said.alias("said"))))
    cells = lines.select(F.col("l_orderkey").cast("long").alias("table_id"), F.explode(rows).alias("r")).select("table_id", "r.row", F.posexplode("r.said").alias("col", "text"))
    return tabular_items(cells).select("table_id", "item_id", "description", F.col("quantity").cast("double"), "unit", F.col("unit_price").cast("double"), F.col("total_price").cast("double"), "code")


@query("""with w as (select l_orderkey as page, l_linestatus = 'F' as word, case when l_linenumber % 7 = 0 then null else l_quantity::int end as conf from lineitem), u as (select *, bool_or(word) over (partition by page) as any_word from w)
 select page::bigint as page, count(*)::bigint as n_words, case when bool_and(coalesce(conf between 0 and 100, false)) then round(sum(conf) / count(*), 4) end as confidence from u where word or not any_word group by page""")
def tsv_confidence(spark, sf_dir):
    """Recognised words as tab-separated lines; a page's mean confidence, null if any word's is invalid; word lines (level 5) count, or all where there are none."""
    line = F.concat_ws("\t", F.when(F.col("l_linestatus") == "F", "5").otherwise("4"), F.col("l_orderkey").cast("string"), F.when(F.col("l_linenumber") % 7 == 0, "?").otherwise(F.col("l_quantity").cast("int").cast("string")), F.lit("word"))
    read = table(spark, sf_dir, "lineitem").select(F.from_csv(line, "level int, page long, conf double, word string", {"sep": "\t"}).alias("x")).select("x.*")
    word, valid = F.col("level") == 5, F.coalesce(F.col("conf").between(0, 100), F.lit(False))

    def over(chosen):
        n = F.count_if(chosen)
        return F.struct(n.alias("n_words"), F.when(F.bool_and(~chosen | valid), F.round(F.sum(F.when(chosen, F.col("conf"))) / n, 4)).alias("confidence"))

    pages = read.groupBy("page").agg(F.bool_or(word).alias("any_word"), over(word).alias("words"), over(F.lit(True)).alias("all"))
    return pages.select("page", F.when(F.col("any_word"), F.col("words")).otherwise(F.col("all")).alias("x")).select("page", "x.*")


@query("""select event_type, min_by(event_id, (coalesce(case when event_id % 3 > 0 then ts + to_days((event_id % 5)::int) end, ts), event_id))::bigint as event_id, count(*)::bigint as n_ready from events group by event_type""")
def next_ready_task(spark, sf_dir):
    """The task of each kind that is due first: by its next try, else its creation, then its id."""
    ready = table(spark, sf_dir, "events").withColumn("due", F.expr("coalesce(case when event_id % 3 > 0 then ts + make_dt_interval(event_id % 5) end, ts)"))
    return ready.groupBy("event_type").agg(F.min_by("event_id", F.struct("due", "event_id")).cast("long").alias("event_id"), F.count("*").alias("n_ready"))


@query("""with own as (select distinct l_orderkey, l_returnflag as attribute from lineitem where l_linenumber <= 2), extra as (select distinct l_orderkey, lower(l_returnflag) as attribute from lineitem where l_linenumber > 2)
 select l_orderkey::bigint as l_orderkey, attribute, 'own' as origin from own union all select l_orderkey, attribute, 'added' from extra where not exists (select 1 from own where own.l_orderkey = extra.l_orderkey and lower(own.attribute) = extra.attribute)""")
def requirement_enrichment(spark, sf_dir):
    """Found attributes are added where a record has none of that name, whatever the case; one grouping, no join."""
    late = F.col("l_linenumber") > 2
    attributes = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.lower("l_returnflag").alias("key")).agg(F.min(F.when(~late, F.col("l_returnflag"))).alias("own"))
    return attributes.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.coalesce("own", "key").alias("attribute"), F.when(F.col("own").isNotNull(), "own").otherwise("added").alias("origin"))


_LINES = "select doc_id, ord, l from (select doc_id, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) as ord from documents)"
_FILLER = f"(regexp_full_match(trim(l), '[-_.x*# ]*') or contains({X.sql_fold('l')}, 'lorem'))"


@query(f"""with b as (select *, length(l) between 1 and 60 as header, sum((length(l) between 1 and 60)::int) over (partition by doc_id order by ord) as section from ({_LINES}))
 select doc_id, count(distinct section)::bigint as n_sections, count(distinct case when not header and not {_FILLER} then section end)::bigint as n_with_content from b group by doc_id""")
def section_content(spark, sf_dir):
    """How many of a document's sections hold a line that is neither heading nor placeholder."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "l")).withColumn("header", F.length("l").between(1, 60))
    # the window is one document's lines
    running = F.sum(F.col("header").cast("int")).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    filler = F.trim("l").rlike("^[-_.x*# ]*$") | F.contains(X.fold_letters(F.col("l")), F.lit("lorem"))
    sections = lines.withColumn("section", running).groupBy("doc_id", "section").agg(F.bool_or(~F.col("header") & ~filler).alias("content"))
    return sections.groupBy("doc_id").agg(F.count("*").alias("n_sections"), F.count_if("content").alias("n_with_content"))


@query("""select l_orderkey::bigint as l_orderkey, case when bool_or(l_returnflag = 'R') then 'R' when bool_or(l_returnflag = 'A') then 'A' end as owner,
 (case when bool_or(l_returnflag = 'R') then count_if(l_returnflag = 'R') else count_if(l_returnflag = 'A') end)::bigint as n_items from lineitem group by l_orderkey""")
def process_assembly(spark, sf_dir):
    """A process takes its items from the preferred document, else from the other one, never from both."""
    count = {flag: F.count_if(F.col("l_returnflag") == flag) for flag in "RA"}
    owned = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(count["R"].alias("r"), count["A"].alias("a"))
    return owned.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.when(F.col("r") > 0, "R").when(F.col("a") > 0, "A").alias("owner"), F.when(F.col("r") > 0, F.col("r")).otherwise(F.col("a")).alias("n_items"))


@query("""select l.doc_id, quality, d.doc_id is not null as found, coalesce(contains(d.text, 'the'), false) as quoted from labels l left join documents d on l.doc_id = d.doc_id""")
def annotation_join(spark, sf_dir):
    """Annotations against the catalogue and the text they quote; only a flag of each text is shuffled."""
    quoted = table(spark, sf_dir, "documents").select("doc_id", F.contains("text", F.lit("the")).alias("quoted"), F.lit(True).alias("found"))
    joined = table(spark, sf_dir, "labels").select("doc_id", "quality").join(quoted, "doc_id", "left")
    return joined.select("doc_id", "quality", F.coalesce("found", F.lit(False)).alias("found"), F.coalesce("quoted", F.lit(False)).alias("quoted"))
