"""Facts and findings of documents that the given tables are laid out as; their SQL reads the columns directly.

Each order is a reference document (its clauses say what its columns hold, with
clauses beside them that must not count), each part an item's description.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions import records as N
from concord.functions import text as X
from concord.operators import document_rules as D
from concord.operators import fields as E
from concord.plans.registry import query
from concord.session import table

_BLOCK = "section int, title string, section_type string, pos int, type string, text string"


def _lay_out(df: DataFrame, key: str, blocks: list[tuple[int, str | Column, str, Column]]) -> DataFrame:
    """A row per block (section, title, type, text) whose text is not null, in their order."""
    rows = [F.struct(F.lit(s).alias("section"), (F.lit(t) if isinstance(t, str) else t).alias("title"), F.lit(None).cast("string").alias("section_type"), F.lit(k).alias("pos"), F.lit(kind).alias("type"), text.alias("text")) for k, (s, t, kind, text) in enumerate(blocks)]
    return df.select(F.col(key).cast("long").alias("document_id"), F.inline(F.filter(F.array(*rows), lambda b: b["text"].isNotNull())))


def _said(template: str) -> Column:
    """A text with column expressions in braces."""
    parts = [F.lit(p) if k % 2 == 0 else F.expr(p).cast("string") for k, p in enumerate(template.replace("}", "{").split("{")) if p or k % 2]
    return F.concat(*parts)


def _when(condition: str, template: str) -> Column:
    return F.when(F.expr(condition), _said(template))


_BR = "replace(replace(replace(format_number(o_totalprice, 2), ',', 'x'), '.', ','), 'x', '.')"
_K, _DAYS, _TERM = "o_orderkey % 6", "o_custkey % 60 + 1", "o_custkey % 5 + 1"


@query(f"""select o_orderkey::bigint as document_id, 'DELIVERY_DEADLINE' as field, ({_DAYS})::double as value, 'DIAS' as unit, case {_K} when 2 then 3 else 2 end::int as pos from orders where {_K} <= 2
 union all select o_orderkey, 'WARRANTY_TERM', case when {_K} % 2 = 0 then 12 * ({_TERM}) else {_TERM} end, 'MESES', 5 from orders where {_K} < 5
 union all select o_orderkey, 'TOTAL_PRICE', round(o_totalprice, 2), 'BRL', 6 from orders where {_K} < 4
 union all select o_orderkey, 'TOTAL_PRICE', 7, 'BRL', 9 from orders where {_K} = 0""")
def document_fields(spark, sf_dir):
    blocks = [
        (0, "", "PARAGRAPH", F.lit("O pagamento será efetuado no prazo de 30 dias após a autorização de fornecimento")),
        (0, "", "TABLE", F.lit("Prazo de entrega 77 dias; garantia de 9 anos")),
        (0, "", "PARAGRAPH", _when(f"{_K} < 2", f"O  PRAZO de ENTREGA {{{_DAYS}}} (por extenso) dias corridos")),
        (0, "", "PARAGRAPH", _when(f"{_K} = 2", f"Os bens serão entregues no prazo de {{{_DAYS}}} dias contados do recebimento da Ordem")),
        (0, "", "PARAGRAPH", _when(f"{_K} = 3", f"Vigência do contrato e prazo de entrega {{{_DAYS}}} dias")),
        (0, "", "PARAGRAPH", F.coalesce(_when(f"{_K} % 2 = 0", f"Garantia técnica de {{{_TERM}}} (n) anos"), _when(f"{_K} < 5", f"a garantia mínima de {{{_TERM}}} meses"))),
        (0, "", "PARAGRAPH", _when(f"{_K} < 4", f"Valor total estimado: R$ {{{_BR}}}")),
        (0, "", "PARAGRAPH", _when(f"{_K} < 3", "entrega em 99 dias e garantia de 99 meses")),
        (0, "", "PARAGRAPH", F.lit(" ")),
        (0, "", "PARAGRAPH", _when(f"{_K} = 0", "orçamento estimado em R$ 7")),
    ]
    found = E.document_fields(_lay_out(table(spark, sf_dir, "orders"), "o_orderkey", blocks))
    return found.withColumn("value", F.col("value").cast("double"))


_VOLTS, _KNOWN = "case p_partkey % 3 when 0 then '110' when 1 then '127' else '220' end", "p_partkey % 7 = 0"
_REQ = [
    ("potencia_motor", ">=", "p_size::varchar", "p_size", "null", "true"),
    ("potencia_cv", ">=", "p_size::varchar", "p_size", "'CV'", "true"),
    ("cor", "=", "'azul'", "null", "null", f"not ({_KNOWN})"),
    ("tensao_voltagem", "=", _VOLTS, f"({_VOLTS})::double", "'V'", "true"),
    ("capacidade", ">=", "p_size || ',5'", "p_size + 0.5", "'LITROS'", "true"),
    ("ano_fabricacao", ">=", "(2000 + p_size % 20)::varchar", "2000 + p_size % 20", "null", "p_partkey % 4 > 0"),
    ("opcional_ar_condicionado", "exists", "'true'", "null", "null", "p_partkey % 2 = 0"),
    ("opcional_airbag", "exists", "'true'", "null", "null", "p_partkey % 2 = 0"),
]


@query(" union all ".join(f"select p_partkey::bigint as document_id, p_name as item_id, '{a}' as attribute, '{op}' as operator, {v} as value, ({n})::double as number, {u}::varchar as unit from part where {c}" for a, op, v, n, u, c in _REQ))
def item_requirements(spark, sf_dir):
    volts = F.expr(_VOLTS)
    said = F.concat(_said("Motor de {p_size} CV, Cor: azul, cor preta, "), volts, _said(" V, Capacidade de {p_size},5 litros, 220v"), F.coalesce(_when("p_partkey % 4 > 0", ", ano {2000 + p_size % 20}"), F.lit("")), F.coalesce(_when("p_partkey % 2 = 0", ", Ar Condicionado, airbag e ar condicionado"), F.lit("")))
    known = F.when(F.expr(_KNOWN), F.array(F.lit("COR")))
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("document_id"), F.col("p_name").alias("item_id"), said.alias("description"), known.alias("known"))
    return E.atomic_requirements(items).select("document_id", "item_id", "attribute", "operator", "value", "number", "unit")


@query("""with c as (select o_custkey::bigint as document_id, o_orderkey::bigint as table_id, o_orderkey % 3 + 1 as n, o_orderkey % 4 as kind, o_orderpriority, o_orderkey % 50 as q from orders where o_orderkey % 4 <> 3)
 select document_id, table_id, 'item-' || lpad(n::varchar, 4, '0') || case when row_number() over w > 1 then case when row_number() over w < 10 then '-0' else '-' end || row_number() over w else '' end as item_id,
 case when kind = 1 then 'lado ' || table_id else 'bem ' || o_orderpriority end as description, case when kind <> 2 and q > 0 then q end::double as quantity, case when kind <> 2 and q > 0 then case when q % 2 = 0 then 'PARES' else 'UN' end end as unit
 from c window w as (partition by document_id, n order by table_id)""")
def card_items(spark, sf_dir):
    kind, n, q = F.col("o_orderkey") % 4, F.col("o_orderkey") % 3 + 1, F.col("o_orderkey") % 50
    cell = lambda row, col, text: F.struct(F.lit(row).alias("row"), F.lit(col).alias("col"), text.alias("text"))
    cells = F.array(
        cell(0, 0, F.concat(F.lit("Item  Nº 0"), n.cast("string"))),
        cell(0, 1, F.concat(F.lit("lado  "), F.col("o_orderkey").cast("string"))),
        cell(1, 0, F.when(kind != 1, "DESCRIÇÃO do bem").otherwise("outro")),
        cell(1, 1, F.concat(F.lit("bem "), "o_orderpriority")),
        cell(2, 0, F.when(kind != 2, "Quantidade").otherwise("prazo")),
        cell(2, 1, F.concat(q.cast("string"), F.when(q % 2 == 0, " pares").otherwise(""))),
        cell(3, 0, F.when(kind == 3, "Grau do risco").otherwise("fim")),
    )
    laid = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long").alias("document_id"), F.col("o_orderkey").cast("long").alias("table_id"), F.inline(cells))
    return E.item_cards(laid).withColumn("quantity", F.col("quantity").cast("double"))


_NAMES = ["objeto", "fundamentacao", "solucao", "requisitos", "execucao", "gestao", "medicao_pagamento", "selecao", "estimativa", "adequacao_orcamentaria"]
_TITLES = ["1. DO OBJETO", "2.1 - Da Justificativa", "Seção IV – Descrição da Solução como um todo", "4 Especificações Técnicas dos bens", "5. Modelo de Execução do Objeto", "6 Gestão do Contrato", "item 7: Critérios de Medição", "Seleção do Fornecedor", "9. Valor Estimado", "10. Dotação Orçamentária"]


def _state(k: int) -> str:
    """0: no section, 1: a placeholder, 2: the heading alone, else content."""
    return f"(o_orderkey + {k}) % 8"


_HAS = {n: f"{_state(k)} > 2" for k, n in enumerate(_NAMES)}
_HAS["objeto"] += " or o_orderkey % 7 = 0"
_HAS["estimativa"] += " or o_orderkey % 11 = 0"
_HAS["local_entrega"] = f"{_state(4)} > 2 and o_custkey % 3 = 0"
_HAS["recebimento"] = f"{_state(5)} > 2 and o_custkey % 5 < 2"
_MISSING = "concat_ws(','" + "".join(f", case when not ({c}) then '{n}' end" for n, c in _HAS.items()) + ")"


@query(f"select o_orderkey::bigint as document_id, {_MISSING} as missing from orders where {_MISSING} <> ''")
def tr_mandatory_elements(spark, sf_dir):
    orders, blocks = table(spark, sf_dir, "orders"), []
    for k, title in enumerate(_TITLES):
        text = {4: "{case when o_custkey % 3 = 0 then 'Entregar no Almoxarifado' else 'Executar' end}", 5: "{case when o_custkey % 5 < 2 then 'após o recebimento provisório' else 'conforme a lei' end}"}.get(k, "texto da seção")
        blocks += [(k, title, "HEADER", _when(f"{_state(k)} > 0", title)), (k, title, "PARAGRAPH", F.coalesce(_when(f"{_state(k)} = 1", "[ Preencher ]"), _when(f"{_state(k)} > 2", text)))]
    blocks.append((99, "FIM", "PARAGRAPH", F.lit("fim")))
    facts = orders.select(F.col("o_orderkey").cast("long").alias("document_id"), F.array_compact(F.array(F.expr("case when o_orderkey % 7 = 0 then 'objeto' end"), F.expr("case when o_orderkey % 11 = 0 then 'estimativa' end"))).alias("elements"))
    return D.mandatory_elements(_lay_out(orders, "o_orderkey", blocks), facts)


def _order_items(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").cast("long").alias("document_id"), F.concat(F.lit("item-"), F.col("l_linenumber").cast("string")).alias("item_id"), F.col("l_linenumber").alias("pos"), "l_quantity", "l_returnflag", "l_partkey")


@query("""select l_orderkey::bigint as document_id, 'item-' || l_linenumber as item_id, case when bool_and(l_quantity <= 10) then 'quantidade' else 'unidade' end as missing from lineitem
 group by l_orderkey, l_linenumber having bool_and(l_quantity <= 10 or l_returnflag = 'A')""")
def tr_quantity_missing(spark, sf_dir):
    """A line of more than ten has its quantity in a field, with a unit unless it was returned; lines may be repeated."""
    items = _order_items(spark, sf_dir)
    fields = items.where("l_quantity > 10").select("document_id", "item_id", F.lit("QUANTITY").alias("field"), F.when(F.col("l_returnflag") != "A", "UN").alias("unit"))
    return D.quantity_missing(items.select("document_id", "item_id").distinct(), fields)


@query("select o_orderkey::bigint as document_id from orders where o_orderkey % 5 >= 3 and o_custkey % 4 > 0")
def tr_delivery_deadline(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    blocks = [
        (0, "", "PARAGRAPH", F.lit("A vigência será de 12 meses; o pagamento em 30 dias")),
        (0, "", "PARAGRAPH", _when("o_orderkey % 5 = 0", "A entrega dos materiais ocorrerá em até {o_custkey % 30 + 1} (tantos) dias úteis")),
        (0, "", "PARAGRAPH", _when("o_orderkey % 5 = 1", "No prazo de quinze dias corridos a contar do recebimento")),
        (0, "", "PARAGRAPH", _when("o_orderkey % 5 = 2", "Pronta  ENTREGA")),
        (0, "", "PARAGRAPH", _when("o_orderkey % 5 = 3", "XX dias")),
    ]
    held = orders.where("o_custkey % 4 <= 1").select(F.col("o_orderkey").cast("long").alias("document_id"), F.lit("DELIVERY_DEADLINE").alias("field"), F.expr("case when o_custkey % 4 = 0 then '10' else 'a definir' end").alias("value"))
    return D.delivery_deadline_missing(_lay_out(orders, "o_orderkey", blocks), held)


_W1, _W2 = "o_custkey % 4 + 1", "o_orderkey % 3 + 1"


@query(f"""select o_orderkey::bigint as document_id, 'item-1' as item_id, (12 * ({_W1}))::bigint as first_months, (12 * ({_W2}))::bigint as other_months, -1 as first_pos, 1 as other_pos from orders where o_orderkey % 4 < 3 and {_W1} <> {_W2}
 union all select o_orderkey, 'item-2', 24, 6, 2, 3 from orders where o_orderkey % 4 = 1""")
def tr_warranty_contradiction(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    blocks = [
        (0, "", "PARAGRAPH", _when("o_orderkey % 4 = 3", "Não se exige garantia neste caso")),
        (0, "", "PARAGRAPH", _said(f"Garantia técnica integral pela contratada: {{{_W2}}} anos")),
        (0, "", "PARAGRAPH", _when("o_orderkey % 4 = 1", "Garantia do item 2 de 24 meses")),
        (0, "", "PARAGRAPH", _when("o_orderkey % 4 = 1", "para o item 2 a garantia será de 6 meses, garantia de 7 meses")),
    ]
    held = orders.select(F.col("o_orderkey").cast("long").alias("document_id"), F.lit("WARRANTY_TERM").alias("field"), F.lit(None).cast("string").alias("item_id"), F.expr(_W1).alias("value"), F.lit("ANOS").alias("unit"), F.lit(-1).alias("pos"))
    items = orders.select(F.col("o_orderkey").cast("long").alias("document_id"), F.lit("item-1").alias("item_id"), F.lit(0).alias("pos"))
    return D.warranty_contradictions(_lay_out(orders, "o_orderkey", blocks), held, items)


_RECEIPTS = [
    "Os bens serão recebidos simultaneamente por servidor, com conferência e termo",
    "Recebimento provisório no ato da entrega; recebimento definitivo por comissão, com ateste",
    "Não se aplica etapa provisória em razão do balcão de retirada; aceite aplicável por fiscal, com verificação e registro",
    "recebidos provisoriamente por < responsável > e definitivamente em XXXX dias",
    "conforme o art. 140 da Lei",
    "recebidos provisoriamente pelo fiscal",
    "recebimento definitivo por servidor com ateste",
    "simultaneamente por [ servidor/comissão a indicar ] com conferência e termo",
]


@query("""select * from (select o_orderkey::bigint as document_id, case o_orderkey % 8 when 3 then 'normal' when 4 then 'indefinido' when 5 then 'normal' when 6 then 'normal' when 7 then 'normal' end as mode,
 case o_orderkey % 8 when 3 then 'responsavel_provisorio,prazo_definitivo' when 4 then 'provisorio,definitivo' when 5 then 'definitivo' when 6 then 'provisorio' when 7 then 'responsavel_definitivo' end as lacks from orders) where mode is not null""")
def tr_receipt_rules(spark, sf_dir):
    said = F.get(F.array(*map(F.lit, _RECEIPTS)), (F.col("o_orderkey") % 8).cast("int"))
    return D.receipt_rules(_lay_out(table(spark, sf_dir, "orders"), "o_orderkey", [(0, "", "HEADER", F.lit("Do objeto")), (1, "", "PARAGRAPH", said)]))


@query(f"""with m as (select o_orderkey::bigint as document_id, o_custkey % 20 + 1 as n, o_custkey % 20 = 4 as five from orders)
 select document_id, case when n <= 15 then {"['I','II','III','IV','V','VI','VII','VIII','IX','X','XI','XII','XIII','XIV','XV']"}[n] else n::varchar end as anchor, 1 as pos from m where n not in (2, 3) and document_id % 3 > 0
 union all select document_id, 'B', 2 from m where document_id % 2 = 0""")
def tr_annex_references(spark, sf_dir):
    """Annex 2 stands in the document, annex III in the package, both in the other numerals; the tender's annexes are not its own."""
    orders = table(spark, sf_dir, "orders")
    n = F.col("o_custkey") % 20 + 1
    numeral = F.coalesce(N.roman(n.cast("int")), n.cast("string"))
    blocks = [
        (0, "Corpo", "HEADER", F.lit("ANEXO II - Planta")),
        (0, "Corpo", "PARAGRAPH", F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("conforme o anexo "), numeral, F.lit(" e o Anexo "), numeral, F.lit(" adiante")))),
        (0, "Corpo", "PARAGRAPH", _when("o_orderkey % 2 = 0", "Ver o Apêndice B. " + "x" * 100 + " Já o Anexo C do edital nada diz")),
    ]
    package = orders.select(F.col("o_orderkey").cast("long").alias("document_id"), F.lit("pasta/anexo_3-final.pdf").alias("name"))
    return D.unresolved_annexes(_lay_out(orders, "o_orderkey", blocks), package)


@query("""select o_orderkey::bigint as document_id, 'item-4' as item_id, 'voltagem,material' as attributes, 0 as first_pos, 1 as other_pos from orders where o_orderkey % 4 = 0
 union all select o_orderkey, 'item-4', 'material', 0, 1 from orders where o_orderkey % 4 = 1
 union all select o_orderkey, 'item-9', 'cor', -1, -1 from orders where o_custkey % 5 = 0""")
def tr_attribute_contradiction(spark, sf_dir):
    """220 V against 110 V, steel against MDF; brushed steel refines steel, and 5 l is 5 litres."""
    orders = table(spark, sf_dir, "orders")
    blocks = [
        (0, "", "PARAGRAPH", F.lit("Item 4: mesa em aço inox, 220 V, 5 l")),
        (0, "", "PARAGRAPH", F.coalesce(_when("o_orderkey % 4 = 0", "item 4 com 110V e MDF"), _when("o_orderkey % 4 = 1", "item 4 com 220V e MDF"), _when("o_orderkey % 4 = 2", "item 4 em Aço Inox escovado, 5 Litros"))),
    ]
    value = lambda v: orders.where("o_custkey % 5 < 2").select(F.col("o_orderkey").cast("long").alias("document_id"), F.lit("item-9").alias("item_id"), F.lit("cor").alias("attribute"), F.expr(v).alias("value"), F.lit(-1).alias("pos"))
    requirements = value("'Azul'").unionByName(value("case when o_custkey % 5 = 0 then 'preto' else 'azul claro' end"))
    items = orders.select(F.col("o_orderkey").cast("long").alias("document_id"), F.lit("item-1").alias("item_id"), F.lit(0).alias("pos"))
    return D.attribute_contradictions(_lay_out(orders, "o_orderkey", blocks), requirements, items)


@query("""select o_orderkey::bigint as document_id, 0 as section, case when o_orderkey % 3 = 0 then 1 else 2 end as pos from orders where o_orderkey % 3 < 2
 union all select o_orderkey, 1, 3 from orders where o_custkey % 2 = 0""")
def tr_verifiable_metric(spark, sf_dir):
    blocks = [
        (0, "", "PARAGRAPH", F.lit("Resistência de 200 Joules, com laudo de ensaio")),
        (0, "", "PARAGRAPH", _when("o_orderkey % 3 = 0", "Proteção IP54")),
        (0, "", "PARAGRAPH", _when("o_orderkey % 3 < 2", "Calçado SRC com proteção solar UV")),
        (1, "", "PARAGRAPH", _when("o_custkey % 2 = 0", "inflamabilidade classe B")),
    ]
    return D.metrics_without_method(_lay_out(table(spark, sf_dir, "orders"), "o_orderkey", blocks))


@query("""select 'SEM-001' as rule_id, p_partkey::bigint as document_id, 1 as place, 'primeira linha' as label, 'de primeira linha' as quote from part where p_size % 3 = 0
 union all select 'SEM-001', p_partkey, 1, 'ótima qualidade', 'otima qualidade' from part where p_size % 3 = 1 union all select 'SEM-001', p_partkey, 2, 'alto padrão', 'alto padrao' from part
 union all select 'SEM-002', p_partkey, 1, 'bosch', 'bosch' from part where p_size % 5 = 0 union all select 'SEM-002', p_partkey, 1, 'dell', 'dell' from part where p_size % 5 = 0""")
def sem_lint(spark, sf_dir):
    item = F.concat(F.coalesce(_when("p_size % 3 = 0", "Bem de Primeira  Linha"), _when("p_size % 3 = 1", "ÓTIMA qualidade"), F.lit("bem")), F.coalesce(_when("p_size % 5 = 0", " Bosch, Dell e modelo"), _when("p_size % 5 = 1", " Bosch ou similar"), F.lit(" shelldell")))
    texts = F.array(F.struct(F.lit(1).alias("place"), F.lit("item").alias("level"), item.alias("text")), F.struct(F.lit(2).alias("place"), F.lit("block").alias("level"), F.lit("Bens de alto padrão Samsung").alias("text")))
    return D.semantic_findings(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("document_id"), F.inline(texts)))


@query(f"""select o_orderkey, ({_DAYS})::bigint as written, case when o_orderkey % 2 = 0 then round(o_totalprice, 2) else round(o_totalprice) end as amount, case o_custkey % 3 when 0 then null when 1 then 1500 else 2.5 end::double as quantity,
 case when o_orderkey % 3 = 0 then 'do objeto' when o_orderkey % 3 = 1 then 'garantia' else 'item unico' end as title from orders""")
def field_scalars(spark, sf_dir):
    """Numbers in digits or written out, amounts and quantities of whole fields, headings without their numbers."""
    days = F.expr(_DAYS)
    words = {v: k for k, v in X.WRITTEN_OUT.items() if k not in ("uma", "duas")}
    written = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for n, w in words.items() for x in (n, w))), days.cast("int")), days.cast("string"))
    amount = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("R$ "), F.expr(_BR), F.lit(" ao ano"))).otherwise(F.format_string("R$%.0f", "o_totalprice"))
    quantity = F.when(F.col("o_custkey") % 3 == 0, "zero 0").when(F.col("o_custkey") % 3 == 1, "1.500 un").otherwise("2,5 kg")
    title = F.when(F.col("o_orderkey") % 3 == 0, "1.2 -  DO  OBJETO").when(F.col("o_orderkey") % 3 == 1, "Capítulo IV – Garantia").otherwise("Item único")
    return table(spark, sf_dir, "orders").select("o_orderkey", X.written_number(F.upper(written)).cast("long").alias("written"), X.money_field(amount).cast("double").alias("amount"), X.quantity_field(quantity).cast("double").alias("quantity"), X.section_title(title).alias("title"))


@query("""select o_orderkey, case when o_orderkey % 4 < 2 then o_orderdate::date::varchar end as strict, case when o_orderkey % 4 < 3 then o_orderdate::date::varchar end as lenient,
 (case o_custkey % 3 when 0 then 0.25 when 1 then 0 else 1 end)::double as overlap from orders""")
def dates_and_boxes(spark, sf_dir):
    """ISO dates and timestamps, with or without anything after them; boxes a quarter within another, beside it, and without area within it."""
    day, kind = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 4
    said = F.when(kind == 0, day).when(kind == 1, F.concat(day, F.lit("T10:20:30Z"))).when(kind == 2, F.concat(day, F.lit(" (sic)"))).otherwise(F.concat(F.lit("em "), day))
    box = lambda *v: F.struct(*(x.cast("double").alias(n) for n, x in zip(("left", "top", "right", "bottom"), v, strict=True)))
    c = F.col("o_custkey") % 3
    inner = F.when(c == 0, box(*map(F.lit, (8, 8, 12, 12)))).when(c == 1, box(*map(F.lit, (20, 20, 30, 30)))).otherwise(box(*map(F.lit, (5, 5, 5, 9))))
    return table(spark, sf_dir, "orders").select("o_orderkey", N.iso_date(said, strict=True).cast("string").alias("strict"), N.iso_date(said).cast("string").alias("lenient"), N.overlap_ratio(inner, box(*map(F.lit, (0, 0, 10, 10)))).alias("overlap"))


@query("""select c_custkey, nullif(c_mktsegment, '') as c_mktsegment, case when c_custkey % 3 = 0 then null else c_name end as c_name, c_nationkey from customer""")
def detail_merge(spark, sf_dir):
    """Details with gaps, filled from the records they refine; a value that both lack stays null or empty."""
    customers = table(spark, sf_dir, "customer")
    base = customers.select("c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("c_name"), "c_nationkey")
    detail = customers.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), F.lit(None).cast("string").alias("c_name"))
    return N.filled_from(detail, base, "c_custkey")
