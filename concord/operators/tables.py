"""Items out of document tables: a heading row names the columns, or their number does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.functions import text as X
from concord.operators.fields import RISK_BOTH, RISK_MARKS

#: What a column's folded heading says it holds; the first pattern that matches counts (fixed values).
HEADINGS = [
    ("item", r"^(item.*|no|n|numero|lote|it)$"),
    ("description", r"^(descri|especifica)|^(objeto|material|produto|discriminacao)$"),
    ("code", r"catmat|codigo|^cod$"),
    ("unit", r"unid|^(un|und|u m|um)$"),
    ("quantity", r"quant|qtd|qnt|^(q|qt)$"),
    ("unit_price", r"unit|^(r|valor)$"),
    ("total_price", r"total"),
]
#: A heading that is this sign alone names the items (fixed value).
NUMBER_SIGN = "#"
#: Texts of a description cell that only repeat a heading (fixed values).
ECHOES = ["descricao", "especificacao", "objeto", "total"]
#: Columns of a table without headings, by its number of columns (fixed values).
BY_WIDTH = {
    3: ["item", "description"],
    4: ["item", "description", "quantity", "unit_price"],
    5: ["item", "description", "quantity", "unit_price", "total_price"],
    6: ["item", "description"],
    7: ["item", "description", "code", "unit", "quantity", "unit_price", "total_price"],
}
HEADING_ROWS, UNIT_CHARS, DEFAULT_UNIT = 5, 15, "UN"


def _role(heading: Column, headings: Sequence[tuple[str, str]] = HEADINGS) -> Column:
    def first(folded: Column) -> Column:
        out = F.lit(None).cast("string")
        for role, pattern in reversed(headings):
            out = F.when(folded.rlike(pattern), F.lit(role)).otherwise(out)
        return out

    return F.when(F.trim(heading) == NUMBER_SIGN, "item").otherwise(X.bound_once(X.fold_alnum(heading), first))


def _by_width(role: str, width: Column) -> Column:
    """The column of a role by the number of columns; wider tables are read as those of seven."""
    out = F.lit(None).cast("int")
    for n, roles in BY_WIDTH.items():
        out = F.when(width >= n, F.lit(roles.index(role) if role in roles else None).cast("int")).otherwise(out)
    return out


def tabular_items(cells: DataFrame, headings: Sequence[tuple[str, str]] = HEADINGS) -> DataFrame:
    """cells (table_id, row, col, text) to a row per item: number, item_id, description, quantity, unit, unit_price, total_price, code.

    One shuffle, by table. A blank description is taken from the next filled one of
    the columns 1 to 3. Rows without a description or number, repeated headings,
    totals and risks are no items, nor is any row of a table of risks; a number that
    comes again in a table gets the suffix -02, -03. Without a quantity column, a
    table of five columns or more gives the first positive number of the columns 2 to
    4. Of columns with the same heading the last one counts.
    """
    by_table = Window.partitionBy("table_id")
    roles = [role for role, _ in headings]
    named = cells.select("table_id", "row", F.col("col").cast("int").alias("col"), "text", F.when(F.col("row") < HEADING_ROWS, _role(F.col("text"), headings)).alias("role"), F.upper("text").alias("upper"))
    places = [F.max(F.when(F.col("role") == role, F.col("col"))).alias(role) for role in roles]
    texts = F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("cells")
    marks = [F.bool_or(F.contains("upper", F.lit(m))).alias(f"m{k}") for k, m in enumerate([*RISK_MARKS, *RISK_BOTH])]
    rows = named.repartition("table_id").groupBy("table_id", "row").agg(texts, F.max("col").alias("last"), F.struct(*places).alias("named"), *marks, F.bool_or(F.contains("upper", F.lit("RISCO"))).alias("risk"))
    is_head = F.col("named.item").isNotNull() & (F.col("named.description").isNotNull() | (F.size("cells") >= 3))
    head = F.min(F.when(is_head, F.struct("row", "named"))).over(by_table)
    m = [F.bool_or(f"m{k}").over(by_table) for k in range(len(RISK_MARKS) + len(RISK_BOTH))]
    of_risks = m[0] | m[1] | (m[2] & m[3])
    placed = rows.withColumn("head", head).withColumn("width", F.max("last").over(by_table) + 1).withColumn("of_risks", of_risks).withColumn("risky", F.bool_or("risk").over(by_table))
    placed = placed.where("not of_risks and (head is null or row > head.row)")
    by_heading = F.col("head.named.description").isNotNull()

    def at(role: str) -> Column:
        # a table that speaks of risks is not read by its number of columns
        return F.when(by_heading, F.col(f"head.named.{role}")).when(~F.col("risky"), _by_width(role, F.col("width"))).otherwise(F.col(f"head.named.{role}"))

    def cell(place: Column) -> Column:
        return F.trim(F.try_element_at("cells", place))

    item_at, text_at = F.coalesce(at("item"), F.lit(0)), F.coalesce(at("description"), F.lit(1))
    filled = lambda k: F.when(item_at != k, F.nullif(cell(F.lit(k)), F.lit("")))
    description = F.coalesce(F.nullif(cell(text_at), F.lit("")), filled(1), filled(2), filled(3))
    candidate = lambda k: F.when((item_at != k) & (text_at != k), X.quantity(cell(F.lit(k))))
    guessed = F.when(at("quantity").isNull() & (F.col("width") >= 5), F.coalesce(candidate(2), candidate(3), candidate(4)))
    read = placed.select("table_id", "row", cell(item_at).alias("item"), description.alias("description"), *(cell(at(r)).alias(r) for r in ("quantity", "unit", "unit_price", "total_price", "code")), guessed.alias("guessed"))
    number = F.coalesce(F.nullif(F.regexp_extract("item", "^([0-9]+)", 1), F.lit("")), F.nullif(F.regexp_extract("description", "^(?i:item *)?([0-9]+)", 1), F.lit(""))).try_cast("long")
    says = lambda word, below: F.contains(F.upper("item"), F.lit(word)) | (F.contains(F.upper("description"), F.lit(word)) & (F.length("description") < below))
    no_item = F.coalesce(says("TOTAL", 20) | says("RISCO", 30), F.lit(False)) | X.fold_alnum(F.col("description")).isin(ECHOES)
    items = read.withColumn("number", number).where(F.col("description").isNotNull() & F.col("number").isNotNull() & ~no_item)
    turn = F.row_number().over(Window.partitionBy("table_id", "number").orderBy("row"))
    told = X.quantity(F.col("quantity"))
    quantity = F.coalesce(told, F.col("guessed"))
    unit = F.when(told.isNotNull() & (F.col("unit") != "") & (F.length("unit") <= UNIT_CHARS), F.upper("unit")).otherwise(DEFAULT_UNIT)
    suffix = F.when(turn > 1, F.format_string("-%02d", turn)).otherwise("")
    code = F.when(F.col("code").rlike("^[0-9]+$"), F.col("code"))
    return items.select("table_id", "row", "number", F.concat(F.format_string("item-%04d", "number"), suffix).alias("item_id"), "description", quantity.alias("quantity"), F.when(quantity.isNotNull(), unit).alias("unit"), X.money(F.col("unit_price")).alias("unit_price"), X.money(F.col("total_price")).alias("total_price"), code.alias("code"))
