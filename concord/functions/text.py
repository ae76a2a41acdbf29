"""Text folding and scalar parsing as column expressions (no Python on the data path)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F



def _foldings() -> tuple[str, str, dict[str, str]]:
    """Characters that compatibility decomposition without marks (NFKD) changes: those to be replaced or, at the end, removed; what one becomes; and those that become several.

    Derived from Python's Unicode tables. Hangul syllables, which decompose by
    arithmetic, stay composed.
    """
    one, many, marks = {}, {}, []
    for c in map(chr, [*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x110000)]):
        if unicodedata.combining(c):
            marks.append(c)
            continue
        bare = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if bare != c:
            (one if len(bare) == 1 else many)[c] = bare
    return "".join([*one, *marks]), "".join(one.values()), many


_FROM, _TO, _MANY = _foldings()
#: Those that become several pass as private characters of plane 15, so that one range tells their texts.
_FIRST = 0xF0000
_ONE_EACH = "".join(chr(_FIRST + k) for k in range(len(_MANY)))
_SPREAD = f"[\\x{{{_FIRST:x}}}-\\x{{{_FIRST + len(_MANY):x}}}]"
_PAIR, _NEXT = "\ue000", "\ue001"
_MANY_TEXT = _NEXT.join(f"{c}{_PAIR}{bare}" for c, bare in _MANY.items())


def fold_letters(text: Column) -> Column:
    """Lower case of the text decomposed by compatibility (NFKD) without its marks: é, e with a mark, ª, ² and ﬁ become e, e, a, 2 and fi."""

    def several(passed: Column) -> Column:
        table = F.str_to_map(F.lit(_MANY_TEXT), F.lit(_NEXT), F.lit(_PAIR))
        each = F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: F.when(F.octet_length(c) > 1, F.coalesce(F.try_element_at(table, c), c)).otherwise(c))
        return F.when(passed.rlike(_SPREAD), F.translate(F.array_join(each, ""), _FROM, _TO)).otherwise(passed)

    decomposed = bound_once(F.translate(text, "".join(_MANY) + _FROM, _ONE_EACH + _TO), several)
    return F.lower(F.when(F.octet_length(text) == F.length(text), text).otherwise(decomposed))


#: White space by Unicode's rule, less what the fold has made a blank.
_SPACES = r"[\s\x1c-\x1f\x85\u1680\u2028\u2029]+"


def fold_spaces(text: Column) -> Column:
    """Folded letters, runs of white space as one blank, no blanks at the ends."""
    return F.trim(F.regexp_replace(fold_letters(text), _SPACES, " "))


def fold_alnum(text: Column) -> Column:
    """Folded letters and digits, anything else as one blank."""
    return F.trim(F.regexp_replace(fold_letters(text), "[^a-z0-9]+", " "))


def letter_words(text: Column) -> Column:
    return F.regexp_extract_all(fold_letters(text), F.lit("[a-z]+"), F.lit(0))


def slug(text: Column, length: int = 60, default: str = "untitled") -> Column:
    cut = F.left(F.regexp_replace(fold_letters(text), "[^a-z0-9]+", "-"), F.lit(length))
    return F.coalesce(F.nullif(F.regexp_replace(cut, "^-+|-+$", ""), F.lit("")), F.lit(default))


def bound_once(value: Column, body) -> Column:
    """``body(value)`` with value computed once a row, wherever the optimiser moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(words: Column, n: int) -> Column:
    """Distinct runs of n words, as 64-bit digests of their words' digests, each of which is taken once; none for shorter texts."""

    def runs(w: Column) -> Column:
        at = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(at, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(n)))))

    return bound_once(F.transform(words, lambda word: F.xxhash64(word)), runs)


def money(text: Column) -> Column:
    """First run of digits and separators; with both, the comma is decimal; a lone comma too; lone dots as they are."""
    run = F.regexp_extract(text, r"[0-9.,]+", 0)
    both = F.contains(run, F.lit(",")) & F.contains(run, F.lit("."))
    plain = F.when(both, F.replace(F.replace(run, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(F.contains(run, F.lit(",")), F.replace(run, F.lit(","), F.lit("."))).otherwise(run)
    return plain.try_cast("decimal(20,2)")


def quantity(text: Column) -> Column:
    """First number; groups of three after dots are thousands; only positive values."""
    run = F.regexp_extract(text, r"[0-9]+([.,][0-9]+)?", 0)
    value = F.when(run.rlike(r"^[0-9]{1,3}(\.[0-9]{3})+$"), F.replace(run, F.lit("."), F.lit(""))).otherwise(F.replace(run, F.lit(","), F.lit("."))).try_cast("decimal(20,3)")
    return F.when(value > 0, value)


def sql_fold(text: str) -> str:
    """The fold of texts without compatibility characters as DuckDB SQL."""
    return f"lower(strip_accents({text}))"


def clean_spaces(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def money_field(text: Column) -> Column:
    """The amount that remains of a whole field without all but digits and separators, by the rule of ``money``; no negative one."""
    return money(F.regexp_replace(text, "[^0-9.,]", ""))


def quantity_field(text: Column) -> Column:
    """The number that remains of a whole field: dots before three digits are thousands, with both separators the comma is decimal; only positive values."""
    run = F.regexp_replace(text, "[^0-9.,]", "")
    thousands = run.rlike(r"^[0-9]{1,3}(\.[0-9]{3})+$") | (F.contains(run, F.lit(",")) & F.contains(run, F.lit(".")))
    value = F.replace(F.when(thousands, F.replace(run, F.lit("."), F.lit(""))).otherwise(run), F.lit(","), F.lit(".")).try_cast("decimal(20,3)")
    return F.when(value > 0, value)


#: Numbers written out, folded (fixed values).
WRITTEN_OUT = {
    "um": 1, "uma": 1, "dois": 2, "duas": 2, "tres": 3, "quatro": 4, "cinco": 5, "seis": 6, "sete": 7, "oito": 8, "nove": 9, "dez": 10,
    "quinze": 15, "vinte": 20, "trinta": 30, "quarenta": 40, "sessenta": 60, "noventa": 90, "cento e vinte": 120,
}


def written_number(text: Column) -> Column:
    """A number in digits or written out; null if it is neither."""
    folded = fold_spaces(text)
    words = F.create_map(*(F.lit(x) for kv in WRITTEN_OUT.items() for x in kv))
    return F.when(folded.rlike("^[0-9]+$"), folded.try_cast("int")).otherwise(F.try_element_at(words, folded))


def section_title(text: Column) -> Column:
    """A heading, folded, without its number or its label and number in front."""
    return F.trim(F.regexp_replace(fold_spaces(text), r"^(?:(?:item|secao|capitulo) [0-9ivxlcdm]+(?:\.[0-9ivxlcdm]+)*|[0-9]+(?:\.[0-9]+)*)\s*[-–—:.]*\s*", ""))
