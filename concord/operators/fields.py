"""Facts out of document texts: deadlines, warranties, budgets, requirements and item cards.

Blocks are rows (document_id, pos, type, text); positions order a document's blocks.
Patterns are parameters; the defaults are written for folded text (lower case, no
accents, single blanks), so that one ASCII pattern serves every spelling. A
document's first match is a grouped minimum by position, never a sort of its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.functions import text as X

#: Blocks that are no prose (fixed values).
NOT_PROSE = ["TABLE", "IMAGE"]
#: What a clause of delivery follows upon, and the two forms of its deadline (fixed values).
TRIGGERS = "autorizacao de fornecimento|ordem de fornecimento|nota de empenho|recebimento da (?:ordem|af|autoriza)|solicitacao|assinatura d[oa] contrato"
DEADLINES = [
    r"(?:prazo de entrega|prazo de fornecimento|prazo de execucao d[oa] entrega|entreg\w+ (?:no prazo de|em ate|em)|sera entregue (?:no prazo de|em)) ?([0-9]{1,3}) ?(?:\([^)]*\))? ?(?:dias?|horas?)",
    rf"no prazo de ([0-9]{{1,3}}) ?(?:\([^)]*\))? ?(?:dias?|horas?).{{0,80}}?(?:{TRIGGERS})",
]
#: Words that make a clause one of payment, anywhere, or of the contract's term, near its start (fixed values).
PAYMENT, TERM, TERM_CHARS = "pagamento", "vig", 60
WARRANTY = r"garantia(?: tecnica| do produto| minima| contra defeitos)?(?: de| sera de| minima de| ?:)? ?([0-9]{1,3}) ?(?:\([^)]*\))? ?(mes(?:es)?|anos?)"
BUDGET = r"\b(?:valor total (?:estimado|da contratacao)|estimativa de precos?|orcamento estimado|valor global) ?(?:[:=]| de| em)? ?r\$ ?([0-9.,]+)"
#: Requirements: pattern, operator, attribute and unit where the text names none, in order (fixed values).
REQUIREMENTS = [
    (r"(?:motor|pot[êe]ncia)\s*(?:de)?\s*(\d+(?:[.,]\d+)?)\s*(?:cv|hp|cilindros|cc)?", ">=", "potencia_motor", None),
    (r"(\d+(?:[.,]\d+)?)\s*(?:cv|hp)\b", ">=", "potencia_cv", "CV"),
    (r"(?:tipo\s*de\s*)?combust[íi]vel\s*:\s*([a-zA-Z\+]+)", "=", "combustivel", None),
    (r"\b(flex|gasolina|diesel|etanol|el[ée]trico|h[íi]brido)\b", "=", "combustivel", None),
    (r"(?:com\s*)?(\d{1,2})\s*(?:\([a-zA-Z]+\)\s*)?lugares\b", ">=", "lugares", "LUGARES"),
    (r"c[âa]mbio\s*:\s*([a-zA-Z]+)", "=", "cambio", None),
    (r"\bc[âa]mbio\s*(manual|autom[áa]tico|automatizado|cvt)\b", "=", "cambio", None),
    (r"\btra[çc][ãa]o\s*(4x4|4x2|integral|dianteira|traseira)\b", "=", "tracao", None),
    (r"(?:ano(?:/modelo)?|modelo)\s*:\s*(\d{4}(?:/\d{4})?)", "=", "ano_modelo", None),
    (r"\bano\s*(\d{4})\b", ">=", "ano_fabricacao", None),
    (r"\bcor\s*:\s*([a-zA-Z]+)", "=", "cor", None),
    (r"\bcor\s*(branca|preta|prata|cinza|vermelha|azul)\b", "=", "cor", None),
    (r"\b(\d{3})\s*v(?:olts)?\b", "=", "tensao_voltagem", "V"),
    (r"\b(110|127|220)\s*v\b", "=", "tensao_voltagem", "V"),
    (r"\b(bivolt)\b", "=", "tensao_voltagem", None),
    (r"capacidade\s*(?:de)?\s*(\d+(?:[.,]\d+)?)\s*(m[³3]|litros?|kg|l|ml)\b", ">=", "capacidade", None),
    (r"(\d+)\s*(?:folhas|fls)\b", "=", "quantidade_folhas", "FOLHAS"),
    (r"largura\s*(?:m[íi]nima\s*de\s*)?(\d+(?:[.,]\d+)?)\s*(m|cm|mm)\b", ">=", "largura", None),
    (r"(\d+)\s*rotores\b", "=", "quantidade_rotores", "ROTORES"),
    (r"(\d+)\s*facas\b", "=", "quantidade_facas", "FACAS"),
    (r"\b(airbags?|ar\s*condicionado|dire[çc][ãa]o\s*hidr[áa]ulica|dire[çc][ãa]o\s*el[ée]trica|trava\s*el[ée]trica|vidros?\s*el[ée]tricos?)\b", "exists", "item_opcional", None),
]
#: Requirements whose second group is their unit.
_WITH_UNIT = {"capacidade", "largura"}
OPTIONAL = "opcional_"


def _prose(blocks: DataFrame) -> DataFrame:
    return blocks.where(~F.col("type").isin(NOT_PROSE) & (F.trim("text") != "")).withColumn("folded", X.fold_spaces(F.col("text")))


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def document_fields(blocks: DataFrame, deadlines: Sequence[str] = DEADLINES, warranty: str = WARRANTY, budget: str = BUDGET) -> DataFrame:
    """document_id, field, value, unit and pos: the first deadline and warranty of a document, and every budget.

    Clauses of payment and of the contract's term give no deadline; warranties are in
    months. A null or empty block gives nothing.
    """
    text = F.col("folded")
    deadline = F.coalesce(*(_found(text, p) for p in deadlines)).try_cast("decimal(20,2)")
    elsewhere = F.contains(text, F.lit(PAYMENT)) | F.contains(F.left(text, F.lit(TERM_CHARS)), F.lit(TERM))
    length = _found(text, warranty).try_cast("decimal(20,2)")
    months = F.when(F.regexp_extract(text, warranty, 2).startswith("ano"), length * 12).otherwise(length).cast("decimal(20,2)")
    money = X.money(_found(text, budget))
    rows = F.array(
        F.struct(F.lit("DELIVERY_DEADLINE").alias("field"), F.when(~elsewhere, deadline).alias("value"), F.lit("DIAS").alias("unit")),
        F.struct(F.lit("WARRANTY_TERM").alias("field"), months.alias("value"), F.lit("MESES").alias("unit")),
        F.struct(F.lit("TOTAL_PRICE").alias("field"), money.alias("value"), F.lit("BRL").alias("unit")),
    )
    found = _prose(blocks).select("document_id", "pos", F.explode(F.filter(rows, lambda x: x["value"].isNotNull())).alias("x"))
    once = F.col("x.field") != "TOTAL_PRICE"
    first = found.groupBy("document_id", "x.field", F.when(~once, F.col("pos")).alias("each")).agg(F.min_by(F.struct("x.value", "x.unit", "pos"), "pos").alias("y"))
    return first.select("document_id", "field", "y.value", "y.unit", "y.pos")


def atomic_requirements(items: DataFrame, patterns: Sequence[tuple[str, str, str, str | None]] = REQUIREMENTS) -> DataFrame:
    """items (document_id, item_id, description, known: attributes held already) to a row per requirement found.

    Result: document_id, item_id, attribute, operator, value, number (where the value
    is one), unit, quote. Patterns are tried in their order, and an attribute counts
    once; "exists" makes an attribute of every distinct match.
    """
    text = F.col("description")
    found: list[Column] = []
    for pattern, operator, attribute, unit in patterns:
        p = f"(?iuU){pattern}"
        quote = _found(text, p, 0)
        if operator == "exists":
            every = F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(0)), lambda m: F.lower(F.trim(m)))
            found.append(F.transform(F.array_distinct(every), lambda m: _requirement(F.concat(F.lit(OPTIONAL), F.regexp_replace(m, r"(?U)\W", "_")), F.lit("exists"), F.lit("true"), F.lit(None).cast("string"), m)))
        else:
            named = F.coalesce(F.upper(_found(text, p, 2)), F.lit(unit)) if attribute in _WITH_UNIT else F.lit(unit)
            row = _requirement(F.lit(attribute), F.lit(operator), F.trim(F.regexp_extract(text, p, 1)), named.cast("string"), quote)
            found.append(F.when(quote.isNotNull(), F.array(row)).otherwise(F.array().cast(_REQUIREMENTS)))
    listed = items.select("document_id", "item_id", F.coalesce("known", F.array().cast("array<string>")).alias("known"), F.concat(*found).alias("found"))
    known = F.transform("known", lambda k: F.lower(k))
    # at most a row per pattern and option, so each looks at those before it
    fresh = F.filter("found", lambda x, i: ~F.array_contains(known, x["attribute"]) & ~F.exists(F.slice("found", F.lit(1), i), lambda y: y["attribute"] == x["attribute"]))
    return listed.select("document_id", "item_id", F.inline(fresh)).withColumn("number", F.replace("value", F.lit(","), F.lit(".")).try_cast("double"))


_REQUIREMENTS = "array<struct<attribute:string,operator:string,value:string,unit:string,quote:string>>"


def _requirement(attribute: Column, operator: Column, value: Column, unit: Column, quote: Column) -> Column:
    return F.struct(attribute.alias("attribute"), operator.alias("operator"), value.alias("value"), unit.alias("unit"), quote.alias("quote"))


#: A card's first cell, on folded text, and the rows that hold its text and number (fixed values).
CARD, CARD_TEXT, CARD_QUANTITY = r"^item ?(?:no|n|numero)? ?([0-9]+)", "descricao", "quantidade"
CARD_UNIT = r"[0-9]+(?:[.,][0-9]+)? ?(unidades?|pares?|pecas?|conjuntos?|rolos?|pct|cx)"


def item_cards(cells: DataFrame) -> DataFrame:
    """cells (document_id, table_id, row, col, text) of card tables to item_id, description, quantity and unit, a row per table.

    The first cell names the item; the text beside "descrição" describes it, else the
    second cell of the first row. Tables of a document that name the same item get the
    suffixes -02, -03 in their order; tables of risks are no cards.
    """
    folded = X.fold_spaces(F.col("text"))
    at = lambda row, col: F.max(F.when((F.col("row") == row) & (F.col("col") == col), F.col("text")))
    labels = cells.withColumn("folded", folded)
    beside = Window.partitionBy("document_id", "table_id", "row")
    told = labels.withColumn("label", F.max(F.when(F.col("col") == 0, F.col("folded"))).over(beside)).where("col in (0, 1)")
    last = lambda word: F.max_by(F.when(F.contains("label", F.lit(word)) & (F.col("col") == 1), X.clean_spaces(F.col("text"))), F.when(F.contains("label", F.lit(word)) & (F.col("col") == 1), F.col("row")))
    cards = told.groupBy("document_id", "table_id").agg(
        F.max(F.when((F.col("row") == 0) & (F.col("col") == 0), F.col("folded"))).alias("head"),
        last(CARD_TEXT).alias("described"),
        X.clean_spaces(at(0, 1)).alias("beside"),
        last(CARD_QUANTITY).alias("counted"),
    )
    numbered = cards.join(risk_tables(cells), ["document_id", "table_id"], "left_anti").where(~F.contains("head", F.lit("risco"))).withColumn("number", _found(F.col("head"), CARD).try_cast("long"))
    kept = numbered.withColumn("description", F.coalesce("described", F.nullif("beside", F.lit("")))).where("number is not null and description is not null")
    turn = F.row_number().over(Window.partitionBy("document_id", "number").orderBy("table_id"))
    suffix = F.when(turn > 1, F.format_string("-%02d", turn)).otherwise("")
    quantity = X.quantity(F.col("counted"))
    unit = F.upper(F.coalesce(_found(X.fold_spaces(F.col("counted")), CARD_UNIT), F.lit("un")))
    return kept.select("document_id", "table_id", F.concat(F.format_string("item-%04d", "number"), suffix).alias("item_id"), "description", quantity.alias("quantity"), F.when(quantity.isNotNull(), unit).alias("unit"))


#: Marks of a table of risks, in capitals; of the last two both are asked for (fixed values).
RISK_MARKS, RISK_BOTH = ["MATRIZ DE RISCO", "GRAU DO RISCO"], ["PROBABILIDADE", "IMPACTO"]


def risk_tables(cells: DataFrame) -> DataFrame:
    """(document_id, table_id) of the tables of risks: one mark in a cell, or both of the pair anywhere."""
    upper = F.upper("text")
    has = lambda mark: F.bool_or(F.contains(upper, F.lit(mark)))
    marks = has(RISK_MARKS[0]) | has(RISK_MARKS[1]) | (has(RISK_BOTH[0]) & has(RISK_BOTH[1]))
    return cells.groupBy("document_id", "table_id").agg(marks.alias("risk")).where("risk").drop("risk")
