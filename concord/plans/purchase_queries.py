"""Attachments, purchases, contracts, files and review states laid out from the given tables; their SQL reads the columns directly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions import records as N
from concord.operators import classify as C
from concord.operators import relational as R
from concord.plans.registry import query
from concord.session import fresh_path, table
from concord.sources import files


def _pick(values: list, index: str):
    """The value at ``index`` modulo their number."""
    return F.get(F.array(*map(F.lit, values)), F.expr(f"cast(({index}) % {len(values)} as int)"))


def _sql_pick(values: list, index: str) -> str:
    said = ", ".join("null" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values)
    return f"[{said}][({index}) % {len(values)} + 1]"


_TITLES = [("Estudo Técnico Preliminar", "ETP"), ("TERMO DE REFERÊNCIA", "TR"), ("Errata do Edital", "OUTROS"), ("Contrato nº 5", "CONTRATO"), ("Edital de pregão", "EDITAL"), ("Planilha", "OUTROS"), ("Minuta de contrato", "OUTROS"), ("D.F.D.", "OUTROS"), ("DFD 01", "DFD"), ("Pesquisa de Preços", "PESQUISA_PRECOS")]
_NEGATIVE = "(p_partkey % 10 in (2, 6))"
_BY_TITLE = _sql_pick([r for _, r in _TITLES], "p_partkey")
_CODES = "case when p_size % 9 = 8 then null when p_size % 9 = 7 then 16 else p_size % 9 end"


@query(f"""select p_partkey, case when {_NEGATIVE} then 'OUTROS' when c is null or c = 16 then {_BY_TITLE} when c in (1, 3) then 'OUTROS' when c = 2 then 'EDITAL' when c = 4 then 'TR' else 'OUTROS' end as role,
 case when {_NEGATIVE} or p_size % 6 = 1 then 'OUTROS' when p_size % 6 = 0 then 'CONTRATO' when c = 3 then 'OUTROS' when p_size % 6 = 2 then 'CONTRATO' else {_BY_TITLE} end as contract_role from (select *, {_CODES} as c from part)""")
def attachment_roles(spark, sf_dir):
    """Attachments with an official code or a generic one, of purchases and of contracts."""
    code = F.expr(_CODES)
    title, kind = _pick([t for t, _ in _TITLES], "p_partkey"), _pick(["Contrato (termo inicial)", "Termo Aditivo", "Contrato de fornecimento", "", None, "Outros"], "p_size")
    return table(spark, sf_dir, "part").select("p_partkey", C.document_role(code.cast("string"), title).alias("role"), C.contract_role(kind, title, code).alias("contract_role"))


_TERMS = [("mobiliario", ["mesa", "cadeira", "cadeiras"]), ("informatica", ["notebook", "software"])]
_OBJECTS = [("Aquisição de mesas", "outros", True), ("MESA e notebook", "mobiliario", True), ("Serviços de manutenção de Notebook", "informatica", False), ("cadeirantes", "outros", False), ("licenças de software", "informatica", True), (None, "outros", False), ("Compra de papel", "outros", True)]
_GOODS = "o_orderkey % 7 in (0, 1, 4, 6)"


@query(f"""select o_orderkey, {_sql_pick([c for _, c, _ in _OBJECTS], "o_orderkey")} as category, {_GOODS} as goods, {_GOODS} and o_custkey % 5 in (0, 1) and o_orderkey % 3 = 0 and o_custkey % 2 = 0 as in_profile from orders""")
def purchase_scope(spark, sf_dir):
    """Category, goods and profile of purchases whose object, sphere, legal basis and mode vary."""
    said, sphere, basis, mode = _pick([o for o, _, _ in _OBJECTS], "o_orderkey"), _pick([" m", "F", "X", "", None], "o_custkey"), _pick(["LEI 14.133/2021, Art. 28", "Lei 8.666", None], "o_orderkey"), _pick(["6", "8"], "o_custkey")
    found = C.category(said, _TERMS, "outros")
    goods = C.goods_purchase(said, found != "outros")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(found, F.lit("outros")).alias("category"), goods.alias("goods"), C.in_profile(sphere, basis, mode, goods).alias("in_profile"))


@query("""select doc_id, n_chars > 0 and doc_id % 5 <> 0 and doc_id % 7 <> 0 and doc_id % 3 <> 1 as usable from documents""")
def document_usable(spark, sf_dir):
    """Documents that opened, have text and need no recognition, and whose title says what their role says."""
    title = F.when(F.col("doc_id") % 3 == 0, "Termo de referência").when(F.col("doc_id") % 3 == 1, "Extrato do contrato").otherwise("")
    role = F.when(F.col("doc_id") % 3 == 0, "TR").when(F.col("doc_id") % 3 == 1, "CONTRATO").otherwise("ETP")
    none = F.lit(None)
    return table(spark, sf_dir, "documents").select("doc_id", C.usable(F.col("doc_id") % 5 != 0, F.col("n_chars"), F.col("doc_id") % 7 == 0, role, none.cast("int"), title, none.cast("string")).alias("usable"))


@query("""select o_orderkey, bool_or(l_linenumber % 3 = 0 and l_returnflag <> 'A') as linked from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey""")
def contract_links(spark, sf_dir):
    """A purchase is linked if one of its contracts names its number by the exact criterion."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.struct(F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit(" "), F.col("l_orderkey").cast("string"))).otherwise("other").alias("purchase"), F.when(F.col("l_returnflag") != "A", C.EXACT).otherwise("titulo").alias("criterion")).alias("c"))
    contracts = lines.groupBy("o_orderkey").agg(F.collect_set("c").alias("contracts"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey").join(contracts, "o_orderkey")
    return orders.select("o_orderkey", C.exactly_linked(F.col("o_orderkey").cast("string"), F.col("contracts")).alias("linked"))


_NUMBER = "lpad({0}::varchar, 14, '0') || '-1-' || lpad(({0} % 1000)::varchar, 6, '0') || '/2024'"


@query(f"""select o_orderkey, case when o_orderkey % 5 = 0 then 'no_purchase' when o_orderkey % 5 = 1 then 'other_purchase' when o_orderkey % 5 = 2 then 'bad_number' end as invalid_reason,
 case when o_orderkey % 5 > 2 then lpad(o_orderkey::varchar, 14, '0') end as org, case when o_orderkey % 5 > 2 then 2024 end::int as year, case when o_orderkey % 5 > 2 then o_orderkey % 1000 end::bigint as seq,
 case when o_orderkey % 2 = 0 then 'initial' else o_orderpriority end as kind, case when o_custkey % 3 = 0 then c_name else 'x' || o_custkey end as supplier from orders join customer on o_custkey = c_custkey""")
def contract_normalise(spark, sf_dir):
    """Contracts from records whose fields have several names and whose type is an object or a text; a wrong tie or number is a reason."""
    number = lambda key: F.concat(F.lpad(key.cast("string"), 14, "0"), F.lit("-1-"), F.lpad((key % 1000).cast("string"), 6, "0"), F.lit("/2024"))
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 5
    record = F.struct(
        F.when(kind == 0, "").when(kind != 1, number(key)).otherwise(F.lit("other")).alias("numeroControlePNCPCompra"),
        F.when(kind == 2, "12/2024").otherwise(number(key)).alias("numeroControlePncp"),
        F.when(key % 2 == 0, F.to_json(F.struct(F.lit(1).alias("id"), F.lit("initial").alias("nome")))).otherwise(F.col("o_orderpriority")).alias("tipoContrato"),
        F.when(F.col("o_custkey") % 3 == 0, F.col("c_name")).alias("fornecedor"),
        F.when(F.col("o_custkey") % 3 != 0, F.concat(F.lit("x"), F.col("o_custkey").cast("string"))).alias("nomeRazaoSocialFornecedor"),
    )
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.select("o_orderkey", record.alias("r"), number(key).alias("purchase"))
    return rows.select("o_orderkey", N.contract(F.col("r"), rows.schema["r"].dataType.names, F.col("purchase")).alias("x")).select("o_orderkey", "x.*")


@query("""select event_type, role, count(*)::bigint as n, count_if(active)::bigint as active from (select *, case event_id % 3 when 0 then 'ETP' when 1 then 'OUTROS' else 'EDITAL' end as role, event_id % 4 <> 0 as active from events) group by all""")
def attachment_summary(spark, sf_dir):
    """Raw attachments under the names of either source, summed up by role and state."""
    title = F.when(F.col("event_id") % 3 == 0, "ETP final").when(F.col("event_id") % 3 == 1, "anexo")
    raw = F.struct(title.alias("titulo"), F.when(F.col("event_id") % 3 == 2, "edital").alias("nome"), F.lit(None).cast("int").alias("tipoDocumentoId"), F.lit(None).cast("string").alias("url"), F.lit("u").alias("uri"), F.when(F.col("event_id") % 4 == 0, "Inativo").alias("statusAtivo"))
    rows = table(spark, sf_dir, "events").select("event_type", raw.alias("r"))
    rows = rows.select("event_type", N.attachment(F.col("r"), rows.schema["r"].dataType.names).alias("a"))
    return rows.withColumn("role", C.document_role(F.col("a.code"), F.col("a.title"))).groupBy("event_type", "role").agg(F.count("*").alias("n"), F.count_if("a.active").alias("active"))


_TASKS = "case event_type when 'purchase' then 'done' when 'error' then 'retry' when 'view' then 'leased' else 'pending' end"


@query(f"""select user_id, count(*)::bigint as tasks, count_if(s = 'done')::bigint as done, count_if(s = 'pending')::bigint as pending, count_if(s = 'retry')::bigint as retry,
 coalesce(string_agg(case when s = 'retry' then event_id::varchar end, ',' order by event_id), '') as errors, count_if(s in ('pending', 'retry')) > 0 as incomplete from (select *, {_TASKS} as s from events) group by user_id""")
def queue_summary(spark, sf_dir):
    """A queue's tasks by state, those to be tried again, and whether its coverage is incomplete."""
    return R.queue_summary(table(spark, sf_dir, "events").withColumn("status", F.expr(_TASKS)), ["user_id"], "status", "event_id")


@query("""select l_orderkey::bigint as process, count(distinct l_suppkey)::bigint as documents, count(distinct (l_suppkey, l_linenumber))::bigint as items, count_if(l_returnflag = 'N')::bigint as extracted, count_if(l_returnflag = 'A')::bigint as confirmed, count_if(l_returnflag = 'R')::bigint as rejected from lineitem group by l_orderkey""")
def review_summary(spark, sf_dir):
    """Documents, items and values of a process by review state."""
    lines = table(spark, sf_dir, "lineitem")
    state = lambda flag: F.count_if(F.col("l_returnflag") == flag)
    return lines.groupBy(F.col("l_orderkey").cast("long").alias("process")).agg(F.count_distinct("l_suppkey").alias("documents"), F.count_distinct("l_suppkey", "l_linenumber").alias("items"), state("N").alias("extracted"), state("A").alias("confirmed"), state("R").alias("rejected"))


_ELIGIBLE = "o_orderstatus <> 'P'"
_CORPUS = """p as (select o_orderkey, o_custkey, o_orderstatus <> 'P' as eligible, nullif(c_mktsegment, '') as category, c_nationkey % 4 as sphere from orders left join customer on o_custkey = c_custkey),
 d as (select l_orderkey, l_returnflag as role, l_quantity > 5 as opened, l_quantity > 45 as ocr from lineitem),
 c as (select o_orderkey, count_if(role = 'A') as a, count_if(role = 'N') as n, count_if(role = 'R') as r, count(l_orderkey) as docs, bool_and(opened and not ocr) as sound from p left join d on l_orderkey = o_orderkey group by 1)"""
_STATS = {
    "processes": "(select count(*) from p)", "eligible": "(select count_if(eligible) from p)", "out_of_scope": "(select count_if(not eligible) from p)",
    "owners": "(select count(distinct o_custkey) from p)", "owners_eligible": "(select count(distinct o_custkey) filter (eligible) from p)",
    "categories": "(select count(distinct category) from p)", "categories_eligible": "(select count(distinct category) filter (eligible) from p)",
    "documents": "(select count(*) from d)", "opened": "(select count_if(opened) from d)", "with_text": "(select count_if(opened and not ocr) from d)", "need_ocr": "(select count_if(ocr) from d)",
    "with_A": "(select count_if(a > 0) from c)", "with_N": "(select count_if(n > 0) from c)", "with_R": "(select count_if(r > 0) from c)",
    "with_pair": "(select count_if(a > 0 and n > 0) from c)", "with_pair_eligible": "(select count_if(a > 0 and n > 0 and eligible) from c join p using (o_orderkey))",
    "complete": "(select count_if(a = 1 and n = 1 and r = 1 and docs = 3 and sound) from c)",
}


@query(f"with {_CORPUS}, s as (" + " union all ".join(f"select '{k}' as key, '' as value, {v}::bigint as n" for k, v in _STATS.items()) + """)
 select * from s union all select 'by_role', role, count(*) from d group by role union all select 'by_sphere', coalesce(sphere::varchar, '-'), count(*) from p group by sphere
 union all select 'by_category', category, count(*) from p where category is not null group by category union all select 'by_category_eligible', category, count(*) from p where category is not null and eligible group by category
 union all select 'by_eligible_role', role, count(*) from d join p on l_orderkey = o_orderkey where eligible group by role""")
def catalogue_statistics(spark, sf_dir):
    """All keys of the catalogue's statistics as rows: totals (value empty) and histograms."""
    processes, documents = _catalogue(spark, sf_dir)
    return R.catalogue_statistics(processes, documents, ["A", "N", "R"], ["A", "N"])


def _catalogue(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    owner = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    processes = table(spark, sf_dir, "orders").join(owner, "o_custkey", "left").select(F.col("o_orderkey").alias("process"), F.col("o_custkey").alias("owner"), F.expr(_ELIGIBLE).alias("eligible"), F.col("c_mktsegment").alias("category"), (F.col("c_nationkey") % 4).cast("string").alias("sphere"))
    documents = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("process"), F.col("l_returnflag").alias("role"), (F.col("l_quantity") > 5).alias("opened"), (F.col("l_quantity") > 45).alias("needs_ocr"))
    return processes, documents


_GATE = [
    ("processes", "n_eligible", ">=", 20), ("owners", "owners", ">=", 5), ("most_per_owner", "most", "<=", 5), ("categories", "categories", ">=", 3), ("spheres", "spheres", "<=", 4),
    ("exact_pair", "pairs", "=", None), ("usable", "sound", "=", None), ("related", "related", "=", None), ("complete", "complete", "=", None), ("no_other_role", "others", "=", 0),
]


@query(f"""with {_CORPUS}, e as (select p.*, a, n, r, docs, sound from p join c using (o_orderkey) where eligible),
 f as (select count(*) as n_eligible, count(distinct o_custkey) as owners, count(distinct category) as categories, count(distinct sphere) as spheres, count_if(a = 1 and n = 1) as pairs, count_if(coalesce(sound, false)) as sound, count_if(a > 0 and n > 0) as related,
  count_if(a = 1 and n = 1 and r = 1 and docs = 3 and sound) as complete, count_if(docs > a + n + r) as others, (select max(k) from (select count(*) as k from e group by o_custkey)) as most from e)
 """ + " union all ".join(f"select '{name}' as criterion, {'n_eligible' if least is None else least}::bigint as required, {column}::bigint as found, {column} {op} {'n_eligible' if least is None else least} as passed from f" for name, column, op, least in _GATE))
def gate_report(spark, sf_dir):
    """Every criterion of the gate over the eligible processes: what is required, what was found, whether it passes."""
    processes, documents = _catalogue(spark, sf_dir)
    return R.gate(processes, documents, ["A", "N", "R"], ["A", "N"], _GATE)


@query("select sha256(text) as sha256, octet_length(encode(text))::bigint as length, min(doc_id)::varchar as name from documents where text is not null and doc_id % 10 <> 0 and sha256(text) not in (select sha256(text) from documents where text is not null and doc_id % 10 = 0) group by text")
def stored_files(spark, sf_dir):
    """Contents written once under their digest, but those that the first write's manifest holds; read again and verified."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("name"), F.col("text").cast("binary").alias("content"), (F.col("doc_id") % 10 == 0).alias("first"))
    path, more = fresh_path(spark, "store"), fresh_path(spark, "store")
    held = files.store(rows.where("first").drop("first"), path)
    # names are compared as numbers in the oracle
    return files.store(rows.where("not first").withColumn("name", F.lpad("name", 12, "0")).drop("first"), more, held).withColumn("name", F.regexp_replace("name", "^0+(?=.)", ""))


@query("""select o_orderkey, case when o_orderkey % 4 = 3 then 0 else count(l_partkey) end::bigint as n, case when o_orderkey % 4 = 3 then null else sum(l_partkey) end::bigint as total,
 'https://portal/editais/' || lpad(o_orderkey::varchar, 14, '0') || '/2024/' || (o_orderkey % 1000) as url from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey""")
def attachment_envelopes(spark, sf_dir):
    """Answers that are a bare list, one wrapped under either name, or something else; and the address of each process."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_json(F.collect_list(F.struct(F.col("l_partkey").alias("id")))).alias("list"))
    wrapped = lambda name: F.concat(F.lit(f'{{"total": 9, "{name}": '), "list", F.lit("}"))
    kind = F.col("o_orderkey") % 4
    payload = F.when(kind == 0, F.col("list")).when(kind == 1, wrapped("documentos")).when(kind == 2, wrapped("Documentos")).otherwise('{"erro": []}')
    orders = table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey")
    read = orders.select("o_orderkey", N.listed_records(payload, "struct<id:bigint>").alias("r"))
    number = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 14, "0"), F.lit("-1-"), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 6, "0"), F.lit("/2024"))
    total = F.when(F.size("r") > 0, F.aggregate(F.transform("r", lambda x: x["id"]), F.lit(0).cast("long"), lambda a, x: a + x))
    return read.select("o_orderkey", F.size("r").cast("long").alias("n"), total.alias("total"), N.portal_url("https://portal", "editais", number).alias("url"))


_FAULT = "o_orderkey % 13"
_RECORD_DDL = """numeroControlePNCP string, numero_controle_pncp string, anoCompra string, ano_compra string, sequencialCompra string, sequencial_compra string, objetoCompra string, description string, modalidadeId string, modalidade_licitacao_id string,
 tipoInstrumentoConvocatorioCodigo string, instrumento_convocatorio_codigo string, amparo_legal_codigo string, amparo_legal_nome string, esfera_id string, orgao_nome string, uf string, dataPublicacaoPncp string, createdAt string, srp string, valorTotalEstimado string, valor_global string, title string,
 orgaoEntidade struct<cnpj: string, razaoSocial: string, esferaId: string>, unidadeOrgao struct<nomeUnidade: string, ufSigla: string, municipioNome: string>, amparoLegal struct<codigo: string, nome: string, descricao: string>"""
_SAID = ["Aquisição de mesas", "Prestação de serviços", "Material", ""]
_BASES = ["LEI 14.133/2021, Art. 28", "Lei 8.666"]


def _purchase_records(spark, sf_dir) -> DataFrame:
    """Orders as JSON records of two sources, one with objects and one flat, with planted faults, read back as purchases."""
    key, fault = F.col("o_orderkey"), F.expr(_FAULT)
    text = lambda c: c.cast("string")
    year, seq = text(F.year("o_orderdate")), text(key % 1000)
    number = F.when(fault == 1, "12/2024").when(fault != 0, F.concat(F.lit(" "), F.lpad(text(key), 14, "0"), F.lit("-1-"), F.lpad(seq, 6, "0"), F.lit("/"), year))
    told_year = F.when(fault == 2, "x").when(fault == 3, "1900").when(fault != 7, year)
    told_seq = F.when(fault == 4, "").when(fault == 5, "7777").when(fault != 7, seq)
    day = F.when(fault == 6, "2024-13-01").when(fault != 8, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    said, basis = _pick(_SAID, "o_orderkey"), _pick(_BASES, "o_custkey")
    sphere, code = F.col("o_orderpriority").substr(1, 1), text(F.when(key % 5 != 0, 1 + F.floor(F.col("o_custkey") / 3) % 2))
    mode = F.when(F.col("o_custkey") % 4 == 0, "8").when(F.col("o_custkey") % 4 != 3, "6")
    spheres = F.create_map(*(F.lit(x) for kv in (("1", "F"), ("2", "e"), ("3", "M"), ("4", "X"), ("5", "")) for x in kv))[sphere]
    nested = F.struct(number.alias("numeroControlePNCP"), told_year.alias("anoCompra"), told_seq.alias("sequencialCompra"), said.alias("objetoCompra"), mode.alias("modalidadeId"), code.alias("tipoInstrumentoConvocatorioCodigo"), day.alias("dataPublicacaoPncp"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("valorTotalEstimado"), F.lit("").alias("orgao_nome"),
        F.struct(F.lit("1").alias("cnpj"), F.col("c_name").alias("razaoSocial"), spheres.alias("esferaId")).alias("orgaoEntidade"), F.struct(F.lit("u").alias("nomeUnidade"), F.lit("SP").alias("ufSigla")).alias("unidadeOrgao"), F.struct(code.alias("codigo"), basis.alias("nome")).alias("amparoLegal"))
    flat = F.struct(number.alias("numero_controle_pncp"), told_year.alias("ano_compra"), told_seq.alias("sequencial_compra"), said.alias("description"), mode.alias("modalidade_licitacao_id"), code.alias("instrumento_convocatorio_codigo"), day.alias("createdAt"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("valor_global"), F.col("c_name").alias("orgao_nome"), spheres.alias("esfera_id"), F.lit("SP").alias("uf"), code.alias("amparo_legal_codigo"), basis.alias("amparo_legal_nome"), F.col("o_orderpriority").alias("title"))
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.select("o_orderkey", F.from_json(F.when(key % 2 == 0, F.to_json(nested)).otherwise(F.to_json(flat)), _RECORD_DDL).alias("r"))
    fields = [f"{f.name}.{g.name}" if f.dataType.typeName() == "struct" else f.name for f in rows.schema["r"].dataType for g in (f.dataType if f.dataType.typeName() == "struct" else [f])]
    found = N.purchase(F.col("r"), fields, "feed", "https://portal.test/api", lambda c: F.coalesce(C.category(c, _TERMS, "outros"), F.lit("outros")))
    return rows.select("o_orderkey", found.alias("x")).select("o_orderkey", "x.*")


_PURCHASES = f"""select *, {_FAULT} as f, case {_FAULT} when 0 then 'no_number' when 1 then 'bad_number' when 2 then 'bad_year' when 3 then 'other_year' when 4 then 'bad_seq' when 5 then 'other_seq' when 6 then 'bad_date' end as why,
 {_sql_pick(_SAID, "o_orderkey")} as said, {_sql_pick(_BASES, "o_custkey")} as basis, case when o_orderkey % 5 <> 0 then 1 + (o_custkey // 3) % 2 end::varchar as code, case o_custkey % 4 when 0 then '8' when 3 then null else '6' end as mode,
 case o_orderpriority[1] when '1' then 'F' when '2' then 'e' when '3' then 'M' when '4' then 'X' when '5' then '' end as sphere, lpad(o_orderkey::varchar, 14, '0') as org, year(o_orderdate)::int as y, (o_orderkey % 1000)::bigint as s, o_orderkey % 2 = 0 as nested
 from orders join customer on o_custkey = c_custkey"""
_PLACE = "'/orgaos/' || org || '/compras/' || y || '/' || s"
_COLUMNS = {
    "control_number": "org || '-1-' || lpad(s::varchar, 6, '0') || '/' || y", "org": "case when nested then '1' else org end", "year": "y", "seq": "s", "object": "said", "category": "cat", "org_name": "c_name", "sphere": "case when nested then sphere else nullif(sphere, '') end", "power": "null::varchar", "unit": "case when nested then 'u' end", "state": "'SP'", "city": "null::varchar",
    "title": "case when not nested then o_orderpriority end", "mode_id": "mode", "mode": "null::varchar", "instrument_code": "code", "instrument": "null::varchar", "basis_code": "code", "basis_name": "basis", "basis_text": "null::varchar", "price_register": "null::varchar", "published": "case when f <> 8 then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') end",
    "proposals_from": "null::varchar", "proposals_to": "null::varchar", "situation": "null::varchar", "has_result": "null::varchar", "value": "o_totalprice::decimal(18,2)::varchar", "value_approved": "null::varchar", "process": "null::varchar", "origin": "'feed'", "detail_url": f"'https://portal.test/api/consulta/v1' || {_PLACE}", "files_url": f"'https://portal.test/api/pncp/v1' || {_PLACE} || '/arquivos'",
}


@query("select o_orderkey, why as invalid_reason, " + ", ".join(f"case when why is null then {sql} end as {name}" for name, sql in _COLUMNS.items()) + f" from (select *, 'outros' as cat from ({_PURCHASES}))")
def purchase_records(spark, sf_dir):
    """All 32 columns of purchases out of two sources' records, or why a record is none."""
    return _purchase_records(spark, sf_dir)


@query(f"""with p as (select *, said = 'Aquisição de mesas' as goods, upper(sphere) in ('F', 'E', 'M') as sphere_ok from ({_PURCHASES}) where why is null)
 select o_orderkey, case when not sphere_ok then 'sphere' when code <> '1' then 'instrument' when mode <> '6' then 'mode' when said <> '' and not goods then 'object' end as preliminary,
 case when not sphere_ok then 'sphere' when code is null or code <> '1' then 'instrument' when not (basis = '{_BASES[0]}' and mode is not null and mode = '6' and goods) then 'profile' end as strict from p""")
def purchase_refusals(spark, sf_dir):
    """Why purchases are refused at a preliminary look, which passes what is unknown, and at the strict one."""
    rows = _purchase_records(spark, sf_dir).where("invalid_reason is null")
    refusal = lambda early: C.refusal(F.col("sphere"), F.col("instrument_code"), F.col("basis_code"), F.col("basis_name"), F.col("mode_id"), F.col("object"), F.lit(False), early)
    return rows.select("o_orderkey", refusal(True).alias("preliminary"), refusal(False).alias("strict"))


_KINDS = ["Contrato (termo inicial)", "Empenho", "TERMO DE CONTRATO", "Termo aditivo", None]


@query(f"""with c as (select l_orderkey as purchase, l_suppkey as seq, l_partkey as part, l_shipdate as day, l_linenumber % 7 = 1 or l_suppkey % 5 in (0, 2) as initial from (select distinct l_orderkey, l_suppkey, l_partkey, l_shipdate, l_linenumber from lineitem)),
 r as (select *, row_number() over (partition by purchase order by initial desc, day, seq desc, part, initial) as place from c)
 select purchase, seq, part, initial, place::bigint as place from r where initial or place = 1""")
def initial_contracts(spark, sf_dir):
    """A purchase's initial contracts in their order, alternatives included; where there is none, the first of its others."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_shipdate", "l_linenumber").distinct()
    initial = C.initial_contract(F.col("l_linenumber") % 7, _pick(_KINDS, "l_suppkey"))
    rows = lines.select(F.col("l_orderkey").alias("purchase"), F.col("l_suppkey").alias("seq"), F.col("l_partkey").alias("part"), F.col("l_shipdate").alias("day"), initial.alias("initial"), (-F.col("l_suppkey")).alias("back"))
    return R.initial_candidates(rows, "purchase", "initial", ["day", "back", "part"], F.trunc("day", "month")).select("purchase", "seq", "part", "initial", "place")
