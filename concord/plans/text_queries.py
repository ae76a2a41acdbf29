"""Text functions, classifiers, extraction and reuse over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions import text as X
from concord.operators import document_rules as D
from concord.operators import reuse, rules
from concord.plans.registry import query
from concord.session import table

_FOLD = X.sql_fold("text")
_WORDS = f"regexp_extract_all({_FOLD}, '[a-z]+')"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query(f"""select doc_id, md5(trim(regexp_replace({_FOLD}, '\\s+', ' ', 'g'))) as fold_spaces,
 md5(trim(regexp_replace({_FOLD}, '[^a-z0-9]+', ' ', 'g'))) as fold_alnum from documents""")
def text_fold(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(X.fold_spaces(F.col("text"))).alias("fold_spaces"), F.md5(X.fold_alnum(F.col("text"))).alias("fold_alnum"))


@query(f"select doc_id, len({_WORDS})::bigint as n_words, len(list_distinct({_WORDS}))::bigint as n_distinct from documents")
def word_tokens(spark, sf_dir):
    words = X.letter_words(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.size(words).cast("long").alias("n_words"), F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))


@query(f"""select p_partkey, coalesce(nullif(regexp_replace(left(regexp_replace({X.sql_fold("p_name || ' / ' || p_type")}, '[^a-z0-9]+', '-', 'g'), 60), '^-+|-+$', '', 'g'), ''), 'untitled') as slug from part""")
def slugify(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.slug(F.concat_ws(" / ", "p_name", "p_type")).alias("slug"))


_SHINGLES = f"""w as (select doc_id, {_WORDS} as w from documents where text is not null),
 s as (select distinct doc_id, array_to_string(w[i:i+7], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from w))"""


@query(f"with {_SHINGLES} select d.doc_id, count(s.s)::bigint as n_shingles from documents d left join s using (doc_id) group by d.doc_id")
def shingle_counts(spark, sf_dir):
    return reuse.shingle_sets(_docs(spark, sf_dir)).select("doc_id", F.size("shingles").cast("long").alias("n_shingles"))


@query("""select doc_id, min(doc_id) over (partition by sha256(text)) as class_id, count(*) over (partition by sha256(text)) as class_size
 from documents where text is not null""")
def reuse_exact(spark, sf_dir):
    return reuse.exact_classes(_docs(spark, sf_dir))


#: Near-identical texts are a class (its smallest id), other marks are pairs of different classes.
_MARKS = f"""with recursive {_SHINGLES}, head as (select min(doc_id) as doc_id from documents where text is not null group by text),
 h as (select s.* from s join head using (doc_id)),
 n as (select doc_id, count(*) as n from h group by doc_id having count(*) >= 40),
 p as (select x.doc_id as a, y.doc_id as b, count(*) as shared from h x join h y on x.s = y.s and x.doc_id < y.doc_id group by all),
 j as (select a, b, shared / (na.n + nb.n - shared) as j, shared / na.n as ca, shared / nb.n as cb from p join n na on na.doc_id = a join n nb on nb.doc_id = b),
 e as (select a, b from j where j >= 0.8 union all select b, a from j where j >= 0.8),
 reach(a, b) as (select a, b from e union select reach.a, e.b from reach join e on reach.b = e.a),
 near as (select a as doc_id, min(b) as near_id from reach group by a),
 k as (select j.*, case when ca >= 0.8 or cb >= 0.8 then 'contained_in' when j >= 0.35 then 'partial_reuse' end as kind
  from j left join near x on x.doc_id = a left join near y on y.doc_id = b where coalesce(x.near_id, a) <> coalesce(y.near_id, b)),
 marks as (select kind, case when kind = 'contained_in' and cb > ca then b else a end as doc_id, case when kind = 'contained_in' and cb > ca then a else b end as other_id,
 round(j, 4) as jaccard, round(greatest(ca, cb), 4) as containment from k where kind is not null
 union all select 'near_identical', doc_id, near_id, null, null from near)"""


@query(f"{_MARKS} select * from marks")
def reuse_marks(spark, sf_dir):
    return reuse.reuse_marks(_docs(spark, sf_dir))


@query(f"""{_MARKS} select kind, a.source = b.source as same_source, count(*)::bigint as n from marks
 join documents a on a.doc_id = marks.doc_id join documents b on b.doc_id = marks.other_id group by all""")
def reuse_summary(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "source")
    marks = reuse.reuse_marks(_docs(spark, sf_dir))
    sided = marks.join(docs, "doc_id").join(docs.toDF("other_id", "other_source"), "other_id")
    return sided.groupBy("kind", (F.col("source") == F.col("other_source")).alias("same_source")).agg(F.count("*").alias("n"))


@query(f"""{_MARKS} select doc_id, count(*)::bigint as n_marks, max(containment) as most from
 (select doc_id, containment from marks union all select other_id, containment from marks) group by doc_id""")
def reuse_symmetric_list(spark, sf_dir):
    marks = reuse.reuse_marks(_docs(spark, sf_dir))
    # both sides of a mark in one pass, as a union would compute the marks twice
    both = marks.select(F.explode(F.array("doc_id", "other_id")).alias("doc_id"), "containment")
    return both.groupBy("doc_id").agg(F.count("*").alias("n_marks"), F.max("containment").alias("most"))


@query(f"""with {_SHINGLES}, iw as (select item_id, {_WORDS} as w from benchmark),
 i as (select distinct item_id, array_to_string(w[i:i+7], ' ') as s from (select item_id, w, unnest(range(1, len(w) - 6)) as i from iw)),
 n as (select item_id, count(*) as n from i group by item_id)
 select item_id, doc_id, round(count(*) / any_value(n.n), 4) as containment from i join s using (s) join n using (item_id) group by item_id, doc_id having count(*) >= any_value(n.n) * 0.8""")
def benchmark_containment(spark, sf_dir):
    return reuse.contained_items(table(spark, sf_dir, "benchmark"), _docs(spark, sf_dir))


_CONTROL = "len(regexp_extract_all(text, '[\\x00-\\x08\\x0e-\\x1f]'))"


@query(f"""select conv_id, turn, length(text)::bigint as chars, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+'))::bigint as words,
 nullif(concat_ws(',', case when length(text) < 40 then 'few_chars' end, case when len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')) < 8 then 'few_words' end,
 case when {_CONTROL} >= 8 and {_CONTROL} > 0.05 * length(text) then 'control' end), '') as reasons from conversations""")
def page_quality(spark, sf_dir):
    """Why a text is not enough: few characters or words, or at least eight control characters that are more than a twentieth."""
    words = F.size(F.regexp_extract_all("text", F.lit(r"[^ \t\n\r\f]+"), F.lit(0)))
    control = F.regexp_count("text", F.lit(r"[\x00-\x08\x0e-\x1f]"))
    reasons = F.concat_ws(",", F.when(F.length("text") < 40, "few_chars"), F.when(words < 8, "few_words"), F.when((control >= 8) & (control > 0.05 * F.length("text")), "control"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("chars"), words.cast("long").alias("words"), F.nullif(reasons, F.lit("")).alias("reasons"))


_LINE_FOLD = f"trim(regexp_replace({X.sql_fold('l')}, '\\s+', ' ', 'g'))"
_IS_PLACEHOLDER = f"(regexp_replace(l, '[\\s.\\-_–—\\[\\]()<>Xx#*]+', '', 'g') = '' or {_LINE_FOLD} in ({', '.join(f"'{p}'" for p in D.PLACEHOLDERS)}) or regexp_matches({_LINE_FOLD}, '^(?:< ?responsavel ?>|\\[ ?servidor/comissao a indicar ?\\]|\\[ ?preencher ?\\])$'))"
_MORE_LINES = "case doc_id % 5 when 0 then 'A  Definir' when 1 then '[ Preencher ]' when 2 then 'xx-XX_##' when 3 then 'responsável pela entrega' else '< Responsável >' end"


@query(f"""select doc_id, count(*)::bigint as n_lines, count_if({_IS_PLACEHOLDER})::bigint as n_placeholder
 from (select doc_id, unnest(string_split(text || chr(10) || {_MORE_LINES}, chr(10))) as l from documents) group by doc_id""")
def placeholder_filter(spark, sf_dir):
    """Lines that only hold a place, of whole texts with one line more that does or does not."""
    text = F.concat("text", F.lit("\n"), F.expr(_MORE_LINES))
    lines = _docs(spark, sf_dir).select("doc_id", F.explode(F.split(text, "\n")).alias("l"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(D.is_placeholder(F.col("l"))).alias("n_placeholder"))


@query("""select p_partkey, case when p_size in (1, 2, 3) and regexp_matches(p_name, '(hot|cold)') then 'other' when p_size in (1, 2, 3) then 'notice'
 when p_size not in (16, 17, 18, 19, 20) then 'other' when regexp_matches(p_name, '(hot|cold)') then 'other'
 when regexp_matches(p_name, 'ring$') then 'reference' when regexp_matches(p_name, '^(red|blue)') then 'study' else 'other' end as role from part""")
def role_classifier(spark, sf_dir):
    negative, code = F.col("p_name").rlike("(hot|cold)"), F.col("p_size")
    role = F.when(code.isin(1, 2, 3) & negative, "other").when(code.isin(1, 2, 3), "notice").when(~code.isin(16, 17, 18, 19, 20), "other").when(negative, "other")
    return table(spark, sf_dir, "part").select("p_partkey", role.otherwise(rules.first_match(F.col("p_name"), [("ring$", "reference"), ("^(red|blue)", "study")], "other")).alias("role"))


_TERMS = [("fasteners", ["bolt", "screw", "nut"]), ("moving", ["gear", "ring", "wheel"]), ("colours", ["red", "blue", "green"]), ("sizes", ["small", "large"])]


@query("select p_partkey, case " + " ".join(f"when {' or '.join(f"contains(' ' || p_name || ' ', ' {t} ')" for t in terms)} then '{name}'" for name, terms in _TERMS) + " else 'other' end as category from part")
def category_first_match(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", rules.first_term(F.concat(F.lit(" "), X.fold_alnum(F.col("p_name")), F.lit(" ")), _TERMS, "other").alias("category"))


@query("select p_partkey, case when regexp_matches(p_name, 'hot|cold') then false when regexp_matches(p_name, 'gear|bolt') then true else p_type = 'ECONOMY' end as in_scope from part")
def scope_filter(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select("p_partkey", F.when(name.rlike("hot|cold"), False).when(name.rlike("gear|bolt"), True).otherwise(F.col("p_type") == "ECONOMY").alias("in_scope"))


@query("select c_custkey, regexp_extract(c_name, '^Customer#([0-9]+)$', 1) as number, try_cast(nullif(regexp_extract(c_name, '^Customer#([0-9]+)$', 1), '') as bigint) as seq, not regexp_matches(c_name, '^Customer#[0-9]{9}$') as invalid from customer")
def control_number_parse(spark, sf_dir):
    number = F.regexp_extract("c_name", "^Customer#([0-9]+)$", 1)
    return table(spark, sf_dir, "customer").select("c_custkey", number.alias("number"), F.nullif(number, F.lit("")).try_cast("long").alias("seq"), (~F.col("c_name").rlike("^Customer#[0-9]{9}$")).alias("invalid"))


_BR = "'R$ ' || replace(printf('%.2f', o_totalprice), '.', ',')"
_RUN = f"regexp_extract({_BR}, '[0-9.,]+')"


@query(f"""select o_orderkey, (try_cast(case when contains({_RUN}, ',') and contains({_RUN}, '.') then replace(replace({_RUN}, '.', ''), ',', '.')
 when contains({_RUN}, ',') then replace({_RUN}, ',', '.') else {_RUN} end as decimal(20,2)))::double as amount from orders""")
def money_parse(spark, sf_dir):
    written = F.concat(F.lit("R$ "), F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(",")))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.money(written).cast("double").alias("amount"))


_Q = "case when l_linenumber % 2 = 0 then l_quantity::int || '.000 un' else l_quantity::int || ',5 kg' end"


@query(f"""select l_orderkey, l_linenumber, l_partkey, (case when regexp_matches(regexp_extract({_Q}, '[0-9]+([.,][0-9]+)?'), '^[0-9]{{1,3}}(\\.[0-9]{{3}})+$')
 then try_cast(replace(regexp_extract({_Q}, '[0-9]+([.,][0-9]+)?'), '.', '') as decimal(20,3)) else try_cast(replace(regexp_extract({_Q}, '[0-9]+([.,][0-9]+)?'), ',', '.') as decimal(20,3)) end)::double as quantity from lineitem""")
def quantity_parse(spark, sf_dir):
    n = F.col("l_quantity").cast("int").cast("string")
    said = F.when(F.col("l_linenumber") % 2 == 0, F.concat(n, F.lit(".000 un"))).otherwise(F.concat(n, F.lit(",5 kg")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", X.quantity(said).cast("double").alias("quantity"))


_UNITS = {"ECONOMY": "UN", "STANDARD": "UN", "SMALL": "KG", "MEDIUM": "KG", "LARGE": "CX"}


@query("select p_partkey, case upper(trim(p_type)) " + " ".join(f"when '{k}' then '{v}'" for k, v in _UNITS.items()) + " else upper(trim(p_type)) end as unit from part")
def unit_canonical(spark, sf_dir):
    raw = F.upper(F.trim("p_type"))
    alias = F.create_map(*(F.lit(x) for kv in _UNITS.items() for x in kv))
    return table(spark, sf_dir, "part").select("p_partkey", F.coalesce(F.try_element_at(alias, raw), raw).alias("unit"))


_LINES = "select doc_id, ord, l from (select doc_id, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) as ord from documents)"
_HEADER = "length(l) between 1 and 60"


@query(f"""with b as (select *, sum(({_HEADER})::int) over (partition by doc_id order by ord) as section from ({_LINES}))
 select doc_id, section::bigint as section, coalesce(max(case when {_HEADER} then l end), 'BODY') as title, count_if(not coalesce({_HEADER}, false))::bigint as n_blocks from b group by doc_id, section""")
def section_segmentation(spark, sf_dir):
    from pyspark.sql import Window

    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "l")).withColumn("header", F.length("l").between(1, 60))
    running = F.sum(F.col("header").cast("int")).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    # a document's own lines are the window, bounded by its text
    cut = lines.withColumn("section", running)
    return cut.groupBy("doc_id", "section").agg(F.coalesce(F.max(F.when(F.col("header"), F.col("l"))), F.lit("BODY")).alias("title"), F.count_if(~F.col("header")).alias("n_blocks"))


@query("""select page_id, len(regexp_extract_all(html, '<li>'))::bigint as n_items, nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '') as title,
 list_sort(list_distinct(regexp_extract_all(html, '<a href="/([^"]*)"', 1)))[1] as first_link from pages""")
def html_items(spark, sf_dir):
    links = F.array_sort(F.array_distinct(F.regexp_extract_all("html", F.lit('<a href="/([^"]*)"'), F.lit(1))))
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_count("html", F.lit("<li>")).cast("long").alias("n_items"), F.nullif(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1), F.lit("")).alias("title"), F.get(links, 0).alias("first_link"))


@query(f"""select doc_id, ord::bigint as ord, regexp_extract(l, '^([A-Z][a-z]+) ', 1) as item, try_cast(nullif(regexp_extract(l, '([0-9]+)', 1), '') as decimal(38,0)) is not null as quantified from ({_LINES})
 where regexp_matches(l, '^[A-Z][a-z]+ ') qualify row_number() over (partition by doc_id, regexp_extract(l, '^([A-Z][a-z]+) ', 1) order by ord) = 1""")
def prose_items(spark, sf_dir):
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "l")).where(F.col("l").rlike("^[A-Z][a-z]+ "))
    items = lines.select("doc_id", (F.col("ord") + 1).cast("long").alias("ord"), F.regexp_extract("l", "^([A-Z][a-z]+) ", 1).alias("item"), F.nullif(F.regexp_extract("l", "([0-9]+)", 1), F.lit("")).try_cast("decimal(38,0)").isNotNull().alias("quantified"))
    return items.groupBy("doc_id", "item").agg(F.min_by(F.struct("ord", "quantified"), "ord").alias("x")).select("doc_id", "x.ord", "item", "x.quantified")


_FIELDS = [("email", r"[a-z0-9.]+@[a-z0-9.]+"), ("phone", r"\+1 \([0-9]{3}\)"), ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"), ("license", r"licensed under the ([A-Z]+)")]


@query("select doc_id, case " + " ".join(f"when regexp_matches(text, '{p}') then '{n}'" for n, p in _FIELDS) + " end as field, case " + " ".join(f"when regexp_matches(text, '{p}') then regexp_extract(text, '{p}')" for n, p in _FIELDS) + " end as found from documents")
def field_first_match(spark, sf_dir):
    field = found = F.lit(None).cast("string")
    for name, pattern in reversed(_FIELDS):
        field = F.when(F.col("text").rlike(pattern), name).otherwise(field)
        found = F.when(F.col("text").rlike(pattern), F.regexp_extract("text", pattern, 0)).otherwise(found)
    return _docs(spark, sf_dir).select("doc_id", field.alias("field"), found.alias("found"))


_ATOMIC = [("size", "(small|large)"), ("colour", "(red|blue|green)"), ("heat", "(hot|cold)")]


@query(" union all ".join(f"select p_partkey, '{n}' as attribute, regexp_extract(p_name, '{p}', 1) as value from part where regexp_matches(p_name, '{p}')" for n, p in _ATOMIC))
def atomic_requirements(spark, sf_dir):
    found = F.array(*(F.struct(F.lit(n).alias("attribute"), F.regexp_extract("p_name", p, 1).alias("value")) for n, p in _ATOMIC))
    return table(spark, sf_dir, "part").select("p_partkey", F.inline(F.filter(found, lambda x: x["value"] != "")))


_VAGUE = ["good", "the best", "adequate", "reasonable", "and the", "of the"]


@query(" union all ".join(f"select doc_id, '{p}' as term, len(regexp_extract_all({_FOLD}, '{p}'))::bigint as n from documents where contains({_FOLD}, '{p}')" for p in _VAGUE))
def sem_vague_terms(spark, sf_dir):
    folded = _docs(spark, sf_dir).select("doc_id", X.fold_letters(F.col("text")).alias("t"))
    counts = F.array(*(F.struct(F.lit(p).alias("term"), F.regexp_count("t", F.lit(p)).cast("long").alias("n")) for p in _VAGUE))
    return folded.select("doc_id", F.inline(F.filter(counts, lambda x: x["n"] > 0)))


@query("select p_partkey, p_brand, p_name from part where regexp_matches(p_brand, '^Brand#1[0-9]?$') and not regexp_matches(p_name, 'ring')")
def sem_brand(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_brand").rlike("^Brand#1[0-9]?$") & ~F.col("p_name").rlike("ring")).select("p_partkey", "p_brand", "p_name")


@query(f"""with f as (select doc_id, {_FOLD} as t from documents) select doc_id, case when contains(t, 'the') and contains(t, 'for') then 'simultaneous' when contains(t, 'not') then 'not_applicable'
 when contains(t, 'und') then 'normal' else 'undefined' end as mode from f""")
def rule_receipt_mode(spark, sf_dir):
    folded = _docs(spark, sf_dir).select("doc_id", X.fold_letters(F.col("text")).alias("t"))
    has = lambda w: F.contains("t", F.lit(w))
    return folded.select("doc_id", F.when(has("the") & has("for"), "simultaneous").when(has("not"), "not_applicable").when(has("und"), "normal").otherwise("undefined").alias("mode"))


@query(f"""select doc_id, min(ord)::bigint as first_line from ({_LINES}) where regexp_matches(l, '[0-9]+') and not regexp_matches(l, '@|http') group by doc_id""")
def rule_metric_without_method(spark, sf_dir):
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "l"))
    return lines.where(F.col("l").rlike("[0-9]+") & ~F.col("l").rlike("@|http")).groupBy("doc_id").agg((F.min("ord") + 1).cast("long").alias("first_line"))


@query("select doc_id, contains(text, substr(text, 11, 40)) as reopened, contains(text, upper(substr(text, 11, 40)) || '#') as mutated_reopened from documents")
def evidence_reopen(spark, sf_dir):
    quote = F.substring("text", 11, 40)
    return _docs(spark, sf_dir).select("doc_id", F.contains("text", quote).alias("reopened"), F.contains("text", F.concat(F.upper(quote), F.lit("#"))).alias("mutated_reopened"))


@query("""select quality, count(*)::bigint as n, count_if(length(text) >= 400)::bigint as found, count_if(length(text) >= 400 and quality = 1)::bigint as hit
 from labels join documents using (doc_id) group by quality""")
def precision_recall(spark, sf_dir):
    said = F.length("text") >= 400
    joined = table(spark, sf_dir, "labels").join(_docs(spark, sf_dir), "doc_id")
    return joined.groupBy("quality").agg(F.count("*").alias("n"), F.count_if(said).alias("found"), F.count_if(said & (F.col("quality") == 1)).alias("hit"))
