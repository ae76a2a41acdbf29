"""Record normalisation: flags, durations, numerals, comparisons, keys (column expressions only)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that mean an inactive record (fixed values).
FALSE_WORDS = ["0", "false", "inactive", "inativo", "nao", "não"]
#: Roman numerals of 1 to 15 (fixed values).
ROMAN = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII", "XIV", "XV"]


def active(flag: Column) -> Column:
    """Null counts as active; otherwise any word but the inactive ones."""
    return flag.isNull() | ~F.lower(F.trim(flag)).isin(FALSE_WORDS)


def first_filled(*candidates: Column) -> Column:
    """The first candidate that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in candidates))


def months(text: Column) -> Column:
    """A written duration in months: years times twelve, months, or a bare number; null if none."""
    folded = F.lower(F.trim(text))
    number = F.nullif(F.regexp_extract(folded, r"[0-9]+", 0), F.lit("")).try_cast("int")
    return F.when(folded.rlike(r"[0-9] *(ano|year)"), number * 12).when(folded.rlike(r"[0-9] *(m[eê]s|month)"), number).when(folded.rlike(r"^[0-9]+$"), number)


def first_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"[0-9]+", 0), F.lit("")).try_cast("long")


def roman(number: Column) -> Column:
    """Roman numeral of 1 to 15; null beyond."""
    return F.when(number.between(1, len(ROMAN)), F.get(F.array(*(F.lit(r) for r in ROMAN)), number - 1))


def anchor_variants(word: str, number: Column) -> Column:
    """How a numbered annex may be called: in digits and, where there is one, as a Roman numeral."""
    return F.array_compact(F.array(F.concat(F.lit(word + " "), number.cast("string")), F.concat(F.lit(word + " "), roman(number))))


def comparison(text: Column) -> Column:
    """(operator, operand) of a requirement's value; no prefix means equality."""
    operator = F.nullif(F.regexp_extract(text, r"^ *(>=|<=|>|<)", 1), F.lit(""))
    return F.struct(F.coalesce(operator, F.lit("=")).alias("operator"), F.trim(F.regexp_replace(text, r"^ *(>=|<=|>|<)", "")).alias("operand"))


def canonical_value(text: Column) -> Column:
    """Numbers without trailing zeros, other text trimmed and in lower case."""
    plain = F.lower(F.trim(text))
    return F.when(plain.rlike(r"^-?[0-9]+\.[0-9]+$"), F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", "")).otherwise(plain)


def stable_key(columns: Sequence[str]) -> Column:
    """SHA-256 of the columns as compact JSON, names sorted, nulls left out."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


#: Keys under which an answer holds its rows (fixed values).
LIST_KEYS = ["items", "resultado", "resultados", "data", "content"]


def is_empty_payload(text: Column) -> Column:
    """No answer, or one without content: null, an empty text, list or object; a pair whose first part is empty (rows, total);
    an object whose only member is empty, or that has an empty member under one of LIST_KEYS. Zero and false are content.
    """
    plain = F.trim(text)
    blank = lambda v: v.isNull() | v.isin("", "[]", "{}")
    members = F.from_json(F.when(plain.startswith("{"), plain), "map<string,string>")
    only = (F.size(members) == 1) & F.exists(F.map_values(members), blank)
    for key in LIST_KEYS:
        only |= F.map_contains_key(members, key) & blank(F.try_element_at(members, F.lit(key)))
    parts = F.from_json(F.when(plain.startswith("["), plain), "array<string>")
    first = F.get(parts, F.lit(0))
    pair = (F.size(parts) == 2) & (first.isNull() | first.isin("[]", "{}"))
    return text.isNull() | F.regexp_replace(plain, r"\s", "").isin("null", "[]", "{}", '""', "") | F.coalesce(only, F.lit(False)) | F.coalesce(pair, F.lit(False))


def iso_date(text: Column, strict: bool = False) -> Column:
    """The date of an ISO date or timestamp; the lenient form also takes a valid date with anything after it."""
    plain = F.trim(text)
    whole = plain.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?$")
    day = F.when(plain.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.left(plain, F.lit(10)).try_cast("date"))
    return F.when(whole, day) if strict else day


def overlap_ratio(inner: Column, outer: Column) -> Column:
    """How much of box ``inner`` lies in ``outer`` (structs of left, top, right, bottom); of a box without area, whether its centre does."""
    zero = F.lit(0.0)
    side = lambda low, high: F.greatest(zero, high - low)
    shared = side(F.greatest(inner["left"], outer["left"]), F.least(inner["right"], outer["right"])) * side(F.greatest(inner["top"], outer["top"]), F.least(inner["bottom"], outer["bottom"]))
    x, y = (inner["left"] + inner["right"]) / 2, (inner["top"] + inner["bottom"]) / 2
    centre = x.between(outer["left"], outer["right"]) & y.between(outer["top"], outer["bottom"])
    area = box_area(inner)
    return F.when(area == 0, centre.cast("double")).otherwise(shared / F.nullif(area, zero))


def box_area(box: Column) -> Column:
    return F.greatest(F.lit(0.0), box["right"] - box["left"]) * F.greatest(F.lit(0.0), box["bottom"] - box["top"])


def filled_from(detail: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """``detail`` with its null or empty values taken from ``base``'s row of the same key; columns of either."""
    names = list(dict.fromkeys([*detail.columns, *base.columns]))
    joined = detail.alias("d").join(base.alias("b"), key, "left")

    def value(c: str) -> Column:
        sides = [F.col(f"{x}.{c}") for x, df in (("d", detail), ("b", base)) if c in df.columns]
        blank = F.when(sides[0].cast("string") != "", sides[0])
        return F.coalesce(blank, *sides[1:], sides[0]).alias(c) if len(sides) > 1 else sides[0].alias(c)

    return joined.select(key, *(value(c) for c in names if c != key))


#: Names of supply units, in capitals without signs (fixed values).
UNITS = {
    "UNIDADE": ["UN", "UND", "UNID", "UNIDADE", "UNIDADES"],
    "PECA": ["PC", "PCA", "PECA", "PECAS", "PÇ", "PÇA"],
    "CAIXA": ["CX", "CXA", "CAIXA", "CAIXAS"],
    "PACOTE": ["PCT", "PCTE", "PACOTE", "PACOTES"],
    "QUILOGRAMA": ["KG", "KILO", "QUILOGRAMA"],
    "LITRO": ["L", "LT", "LITRO", "LITROS"],
    "METRO": ["M", "MT", "METRO"],
    "METRO_QUADRADO": ["M2"],
    "METRO_CUBICO": ["M3"],
    "ROLO": ["RL", "ROLO"],
    "PAR": ["PAR", "PARES"],
    "CONJUNTO": ["CJ", "CONJUNTO"],
    "EMBALAGEM": ["EMB", "EMBALAGEM"],
}


def canonical_unit(text: Column, units: Mapping[str, Sequence[str]] = UNITS) -> Column:
    """A unit's one name: in capitals, without signs, by the table of names; unknown ones stay; null and empty ones are null."""
    plain = F.regexp_replace(F.upper(F.trim(text)), r"(?U)\W", "")
    names = F.create_map(*(F.lit(x) for name, said in units.items() for alias in said for x in (alias, name)))
    return F.when(F.trim(text) != "", F.coalesce(F.try_element_at(names, plain), plain))


#: A control number: owner, sequence and year (fixed value).
CONTROL_NUMBER = r"^([0-9]{14})-[0-9]+-([0-9]{1,10})/([0-9]{4})$"


def named(record: Column, fields: Sequence[str], *names: str) -> Column:
    """The first filled one of a record's fields of these names; ``fields`` are those it has."""
    return first_filled(*(record[n].cast("string") for n in names if n in fields), F.lit(None).cast("string"))


def contract(record: Column, fields: Sequence[str], purchase: Column) -> Column:
    """A contract's columns from a record of any of the sources' field names, or the reason that it is none of ``purchase``.

    The tie is the purchase's own control number; owner, year and sequence come from
    the contract's. Its type is an object (JSON) or a text.
    """
    tie = F.trim(named(record, fields, "numeroControlePNCPCompra", "numeroControlePncpCompra", "numero_controle_pncp_compra"))
    number = F.trim(named(record, fields, "numeroControlePNCP", "numeroControlePncp", "numero_controle_pncp", "numeroContratoPncp"))
    part = lambda k: F.nullif(F.regexp_extract(number, CONTROL_NUMBER, k), F.lit(""))
    reason = F.when(tie.isNull(), "no_purchase").when(~tie.eqNullSafe(purchase), "other_purchase").when(~tie.rlike(CONTROL_NUMBER), "bad_purchase").when(number.isNull(), "no_number").when(~number.rlike(CONTROL_NUMBER), "bad_number")
    kind = named(record, fields, "tipoContrato", "tipoContratoNome", "tipo_contrato_nome")
    sound = lambda c: F.when(reason.isNull(), c)
    return F.struct(
        reason.alias("invalid_reason"),
        sound(F.coalesce(named(record, fields, "orgaoEntidadeCnpj", "cnpj_orgao"), part(1))).alias("org"),
        sound(F.coalesce(named(record, fields, "anoContrato", "ano_contrato").try_cast("int"), part(3).try_cast("int"))).alias("year"),
        sound(F.coalesce(named(record, fields, "sequencialContrato", "sequencial_contrato").try_cast("long"), part(2).try_cast("long"))).alias("seq"),
        F.coalesce(F.get_json_object(kind, "$.nome"), F.get_json_object(kind, "$.descricao"), kind).alias("kind"),
        named(record, fields, "nomeRazaoSocialFornecedor", "fornecedor", "fornecedor_nome").alias("supplier"),
    )


#: A purchase's plain columns and the names that sources give them, a dot where the value is an object's (fixed values).
PURCHASE = {
    "org_name": ["orgaoEntidadeRazaoSocial", "orgao_nome", "orgao", "orgaoEntidade.razaoSocial"],
    "sphere": ["orgaoEntidadeEsferaId", "esfera", "esfera_id", "orgaoEntidade.esferaId"],
    "power": ["orgaoEntidadePoderId", "poder", "poder_id", "orgaoEntidade.poderId"],
    "unit": ["unidadeOrgaoNomeUnidade", "unidade", "unidade_nome", "unidadeOrgao.nomeUnidade"],
    "state": ["unidadeOrgaoUfSigla", "uf", "unidadeOrgao.ufSigla"],
    "city": ["unidadeOrgaoMunicipioNome", "municipio", "municipio_nome", "unidadeOrgao.municipioNome"],
    "title": ["numeroCompra", "title", "titulo"],
    "mode_id": ["modalidadeId", "modalidadeIdPncp", "modalidade_id", "modalidade_licitacao_id"],
    "mode": ["modalidadeNome", "modalidade_nome", "modalidade_licitacao_nome"],
    "instrument_code": ["tipoInstrumentoConvocatorioCodigo", "tipoInstrumentoConvocatorioCodigoPncp", "instrumento_convocatorio_codigo"],
    "instrument": ["tipoInstrumentoConvocatorioNome", "instrumento_convocatorio"],
    "basis_code": ["amparoLegalCodigoPncp", "amparo_legal_codigo", "amparoLegal.codigo"],
    "basis_name": ["amparoLegalNome", "amparo_legal_nome", "amparoLegal.nome"],
    "basis_text": ["amparoLegalDescricao", "amparo_legal_descricao", "amparoLegal.descricao"],
    "price_register": ["srp"],
    "published": ["dataPublicacaoPncp", "data_publicacao_pncp", "createdAt"],
    "proposals_from": ["dataAberturaPropostaPncp", "dataAberturaProposta"],
    "proposals_to": ["dataEncerramentoPropostaPncp", "dataEncerramentoProposta"],
    "situation": ["situacaoCompraNomePncp", "situacaoCompraNome", "situacao"],
    "has_result": ["existeResultado", "tem_resultado"],
    "value": ["valorTotalEstimado", "valor_global"],
    "value_approved": ["valorTotalHomologado", "valor_total_homologado"],
    "process": ["processo"],
}


def purchase(record: Column, fields: Sequence[str], origin: str, base: str, category: Callable[[Column], Column]) -> Column:
    """A purchase's 32 columns from a record of any of the sources' field names, and the first reason that it is none.

    ``fields`` are those the record has, an object's with a dot. The first name with a
    value counts, an empty one too; an object's value stands in where the plain one is
    empty. Year and sequence must be those of the control number, the date of
    publication a whole ISO date. Of an invalid record all columns are null.
    """

    def given(*names: str) -> Column:
        plain = [record[n].cast("string") for n in names if "." not in n and n in fields]
        inner = [record[n.split(".")[0]][n.split(".")[1]].cast("string") for n in names if "." in n and n in fields]
        none = F.lit(None).cast("string")
        outer = F.coalesce(*plain, none)
        return F.coalesce(F.nullif(outer, F.lit("")), *inner, none) if inner else outer

    number = F.trim(given("numeroControlePNCP", "numero_controle_pncp"))
    part = lambda k: F.regexp_extract(number, CONTROL_NUMBER, k)
    year, own_year = given("anoCompraPncp", "anoCompra", "ano_compra"), part(3).try_cast("int")
    seq, own_seq = given("sequencialCompraPncp", "sequencialCompra", "sequencial_compra"), part(2).try_cast("long")
    published, said = given(*PURCHASE["published"]), F.coalesce(given("objetoCompra", "objeto", "description"), F.lit(""))
    reason = (
        F.when(number.isNull() | (number == ""), "no_number")
        .when(~number.rlike(CONTROL_NUMBER), "bad_number")
        .when(year.isNotNull() & F.trim(year).try_cast("int").isNull(), "bad_year")
        .when(F.trim(year).try_cast("int") != own_year, "other_year")
        .when(seq.isNotNull() & F.trim(seq).try_cast("long").isNull(), "bad_seq")
        .when(F.trim(seq).try_cast("long") != own_seq, "other_seq")
        .when(published.isNotNull() & iso_date(published, strict=True).isNull(), "bad_date")
    )
    place = F.concat(F.lit("/orgaos/"), part(1), F.lit("/compras/"), own_year.cast("string"), F.lit("/"), own_seq.cast("string"))
    columns = {
        "control_number": number,
        "org": first_filled(given("orgaoEntidadeCnpj", "cnpj_orgao", "orgao_cnpj", "orgaoEntidade.cnpj"), part(1)),
        "year": own_year,
        "seq": own_seq,
        "object": said,
        "category": category(said),
        **{name: given(*names) for name, names in PURCHASE.items()},
        "origin": F.lit(origin),
        "detail_url": F.concat(F.lit(f"{base}/consulta/v1"), place),
        "files_url": F.concat(F.lit(f"{base}/pncp/v1"), place, F.lit("/arquivos")),
    }
    return F.struct(reason.alias("invalid_reason"), *(F.when(reason.isNull(), c).alias(n) for n, c in columns.items()))


def attachment(record: Column, fields: Sequence[str]) -> Column:
    """An attachment's columns from a record of any of the sources' field names."""
    return F.struct(
        named(record, fields, "sequencialDocumento", "sequencial_documento").try_cast("long").alias("seq"),
        F.coalesce(named(record, fields, "titulo", "nome"), F.lit("")).alias("title"),
        named(record, fields, "tipoDocumentoId").alias("code"),
        named(record, fields, "tipoDocumentoNome").alias("kind"),
        named(record, fields, "url", "uri").alias("url"),
        named(record, fields, "dataPublicacaoPncp").alias("published"),
        active(record["statusAtivo"].cast("string") if "statusAtivo" in fields else F.lit(None).cast("string")).alias("active"),
    )


def in_period(day: Column, first: str, last: str) -> Column:
    """Whether a date lies in a period, both ends included; an unknown date passes."""
    return day.isNull() | day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))


#: Names of the field that wraps a list of attachments (fixed values).
ENVELOPES = ["documentos", "Documentos"]


def listed_records(payload: Column, record: str) -> Column:
    """The records (a DDL struct) of an answer that is a JSON list or an object that wraps one; an empty list for any other."""
    plain = F.trim(payload)
    bare = F.from_json(F.when(plain.startswith("["), plain), f"array<{record}>")
    wrapped = [F.from_json(F.when(plain.startswith("{"), F.get_json_object(plain, f"$.{name}")), f"array<{record}>") for name in ENVELOPES]
    return F.coalesce(bare, *wrapped, F.array().cast(f"array<{record}>"))


def portal_url(base: str, kind: str, control_number: Column) -> Column:
    """base/kind/owner/year/sequence of a control number; null for any other text."""
    part = lambda k: F.nullif(F.regexp_extract(control_number, CONTROL_NUMBER, k), F.lit(""))
    return F.concat(F.lit(f"{base}/{kind}/"), part(1), F.lit("/"), part(3), F.lit("/"), part(2).cast("long").cast("string"))
