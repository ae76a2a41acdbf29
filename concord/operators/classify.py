"""Roles of attachments, categories and scope of purchases, usability of documents: ordered classifiers as column expressions.

Titles are compared folded (lower case, no accents, letters and digits only).
Tables and patterns are parameters; a dictionary of categories has no default, as
it is data.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from concord.functions import text as X
from concord.operators import rules

OTHER, CONTRACT = "OUTROS", "CONTRATO"
#: Roles by an attachment's official code; a generic one tells nothing (fixed values).
ROLE_OF_CODE = {1: OTHER, 2: "EDITAL", 3: OTHER, 4: "TR", 7: "ETP", 12: CONTRACT}
GENERIC_CODE = 16
#: Title rules in order (fixed values).
TITLES = [
    (r"\b(?:documento de formalizacao da demanda|dfd)\b", "DFD"),
    (r"\b(?:estudos? tecnicos? preliminar(?:es)?|etp)\b", "ETP"),
    (r"\b(?:termos? de referencias?|termos? referencias?|tr)\b", "TR"),
    (r"pesquisa de precos?", "PESQUISA_PRECOS"),
    (r"\bcontrato\b", CONTRACT),
    (r"\bedital\b", "EDITAL"),
]
#: Titles that speak of a document and are not it (fixed values).
NOT_ITSELF = r"\b(?:errata|retificacao|adendo|esclarecimento|impugnacao|recurso|resultado|ata de (?:sessao|realizacao)|homologacao|adjudicacao|aviso de licitacao|extrato|publicacao|comprovante|minuta|rascunho)\b"
#: Attachments of a contract: words of accessory ones, types by name, codes, and words of the contract itself (fixed values).
ACCESSORY = r"\b(?:aditivo|apostilamento|empenho|rescisao|minuta|rascunho)\b"
CONTRACT_NAMES = ["contrato", "termo de contrato", "contrato termo inicial", "contrato administrativo", "instrumento contratual"]
ACCESSORY_NAMES = ["termo aditivo", "nota de empenho", "termo de rescisao", "termo de apostilamento"]
DRAFT_CODE, CONTRACT_CODE = 3, 12
CONTRACT_TITLE = r"\b(?:contrato|termo de contrato|instrumento contratual)\b"
#: Purchases of goods, and what puts a purchase out of scope (fixed values).
GOODS = r"\b(?:aquisicao|aquisicoes|compra|fornecimento|registro de precos para (?:a )?aquisicao)\b"
OUT_OF_SCOPE = r"\b(?:prestacao de servicos?|servicos?|obra|obras|engenharia|reformas?|internac(?:ao|oes) hospitalar(?:es)?|exames? laborator(?:ial|iais)|consultas?|procedimentos?|atendimentos?|construcao de|ampliacao de|pavimentacao|locac(?:ao|oes)|aluguel de|contratacao de empresa (?:especializada )?para (?:a )?(?:prestacao|execucao|realizacao)|mao de obra|terceirizacao|manutenc(?:ao|oes)|consultoria|assessoria|capacitacao|treinamento|seguro|transporte escolar|coleta de residuos?|show|artistic(?:o|a|os|as)?|leilao|credenciamento|instalacao de|implantacao de|desenvolvimento de|suporte tecnico|energia(?: eletrica)?)\b"
#: The profile: spheres, the law in a folded basis, the mode of purchase (fixed values).
SPHERES, LAW, MODE = ["F", "E", "D", "M"], "lei 14 133", 6
#: Roles that a document's title must confirm (fixed values).
CONFIRMED_ROLES = ["ETP", "TR", "EDITAL"]


def document_role(code: Column, title: Column, roles: Mapping[int, str] = ROLE_OF_CODE, titles: Sequence[tuple[str, str]] = TITLES) -> Column:
    """The role of an attachment: by its code (text or number) unless its title says it only speaks of one; by its title where the code is generic or null."""
    folded, number = X.fold_alnum(F.coalesce(title, F.lit(""))), code.cast("string").try_cast("int")
    by_code = F.try_element_at(F.create_map(*(F.lit(x) for kv in roles.items() for x in kv)), number)
    other = (number.isNotNull() & by_code.isNull() & (number != GENERIC_CODE)) | folded.rlike(NOT_ITSELF)
    return F.when(other, OTHER).otherwise(F.coalesce(by_code, rules.first_match(folded, titles, OTHER)))


def contract_role(kind: Column, title: Column, code: Column) -> Column:
    """The role of a contract's attachment: accessory ones are OTHER; then the type's name, the code, and the title decide."""
    name, folded, number = X.fold_alnum(F.coalesce(kind, F.lit(""))), X.fold_alnum(F.coalesce(title, F.lit(""))), code.cast("string").try_cast("int")
    either = lambda pattern: name.rlike(pattern) | folded.rlike(pattern)
    return (
        F.when(either(NOT_ITSELF) | either(ACCESSORY) | name.isin(ACCESSORY_NAMES), OTHER)
        .when(name.isin(CONTRACT_NAMES), CONTRACT)
        .when(number == DRAFT_CODE, OTHER)
        .when((number == CONTRACT_CODE) | name.startswith("contrato ") | folded.rlike(CONTRACT_TITLE), CONTRACT)
        .otherwise(document_role(F.lit(None).cast("int"), title))
    )


def category(text: Column, terms: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The first category one of whose terms stands in the text as whole words."""
    padded = F.concat(F.lit(" "), X.fold_alnum(text), F.lit(" "))
    return rules.first_term(padded, terms, default)


def goods_purchase(text: Column, known: Column) -> Column:
    """Whether a purchase is of goods: out-of-scope words say no, words of purchase yes, else whether its category is ``known``."""
    folded = X.fold_alnum(F.coalesce(text, F.lit("")))
    return F.when(folded.rlike(OUT_OF_SCOPE), False).when(folded.rlike(GOODS), True).otherwise(F.coalesce(known, F.lit(False)))


def in_profile(sphere: Column, basis: Column, mode: Column, goods: Column) -> Column:
    """Public sphere, the law, the mode of purchase and goods; any unknown one says no."""
    law = F.contains(X.fold_alnum(basis), F.lit(LAW))
    return F.coalesce(F.upper(F.trim(sphere)).isin(SPHERES) & law & (mode.cast("string").try_cast("int") == MODE) & goods, F.lit(False))


#: Codes of a notice and of the law's article (fixed values).
NOTICE, ARTICLE = 1, 1
#: Names of a contract's initial term, and its type's code (fixed values).
INITIAL_NAMES = ["contrato", "contrato termo inicial", "contrato administrativo", "termo de contrato", "instrumento contratual"]
INITIAL_CODE = 1


def refusal(sphere: Column, instrument: Column, article: Column, basis: Column, mode: Column, said: Column, known: Column, preliminary: bool = False, spheres: Collection[str] = SPHERES) -> Column:
    """The first reason to refuse a purchase, null for none: sphere, instrument, article, then mode and object, or profile.

    A preliminary look passes what is not known (null or no number, an empty object) but
    the sphere; the strict one wants all of it. ``known`` as in ``goods_purchase``.
    ``spheres`` must be a part of the known ones.
    """
    wanted = {s.strip().upper() for s in spheres if s.strip()}
    if not wanted or not wanted <= set(SPHERES):
        raise ValueError(f"spheres must be some of {SPHERES}")
    code = lambda c: F.trim(c.cast("string")).try_cast("int")
    differs = lambda c, v: (code(c) != v) if preliminary else ~code(c).eqNullSafe(F.lit(v))
    goods = goods_purchase(said, known)
    reason = F.when(~F.coalesce(F.upper(F.trim(sphere)).isin(*wanted), F.lit(False)), "sphere").when(differs(instrument, NOTICE), "instrument").when(differs(article, ARTICLE), "article")
    if preliminary:
        return reason.when(differs(mode, MODE), "mode").when((F.coalesce(said, F.lit("")) != "") & ~goods, "object")
    return reason.when(~in_profile(sphere, basis, mode, goods), "profile")


def initial_contract(code: Column, name: Column) -> Column:
    """Whether a contract is an initial term, by its type's code or its name."""
    return F.coalesce(F.trim(code.cast("string")).try_cast("int") == INITIAL_CODE, F.lit(False)) | X.fold_alnum(F.coalesce(name, F.lit(""))).isin(INITIAL_NAMES)


def usable(opened: Column, characters: Column, needs_ocr: Column, role: Column, code: Column, title: Column, kind: Column) -> Column:
    """A document that opened with text, and whose title, where it has one, confirms its role."""
    described = (F.trim(F.coalesce(title, F.lit(""))) != "") | code.isNotNull() | F.coalesce(kind != "", F.lit(False))
    confirmed = F.when(role.isin(CONFIRMED_ROLES), document_role(code, title) == role).when(role == CONTRACT, contract_role(kind, title, code) == CONTRACT).otherwise(True)
    sound = F.coalesce(opened, F.lit(False)) & (F.coalesce(characters.cast("string").try_cast("long"), F.lit(0)) > 0) & ~F.coalesce(needs_ocr, F.lit(False))
    return sound & (~described | confirmed)


#: How a contract's record names the tie to its purchase (fixed value).
EXACT = "numeroControlePncpCompra"


def exactly_linked(number: Column, contracts: Column) -> Column:
    """Whether one of the contracts (array of structs purchase, criterion) names the purchase's own number by the exact criterion."""
    own = F.trim(F.coalesce(number, F.lit("")))
    return F.coalesce(F.exists(contracts, lambda c: (F.trim(F.coalesce(c["purchase"], F.lit(""))) == own) & (c["criterion"] == EXACT)), F.lit(False))
