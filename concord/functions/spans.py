"""Matches of a pattern with their places, and running totals of arrays, as column expressions.

Places come from split() and regexp_extract_all() of one pattern; running totals go
by blocks, so that the work on a text grows with its length and matches, not with
their product or square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from concord.functions.text import bound_once

#: Values that one block of a running total holds.
BLOCK = 256


def running(values: Column, kind: str, zero: Column, step: Callable[[Column, Column], Column], block: int = BLOCK) -> Column:
    """array<kind>: for each value, what the associative ``step`` makes of ``zero`` and the values before it; the total comes last.

    Blocks are folded by themselves and then joined, as an array that grows by one
    entry at a time would be copied as often as it has entries.
    """
    none = F.array().cast(f"array<{kind}>")

    def fold(xs: Column) -> Column:
        begin = F.struct(zero.cast(kind).alias("total"), none.alias("seen"))
        return F.aggregate(xs, begin, lambda s, x: F.struct(step(s["total"], x).cast(kind).alias("total"), F.concat(s["seen"], F.array(s["total"])).alias("seen")))

    def joined(parts: Column) -> Column:
        return bound_once(
            fold(F.transform(parts, lambda p: p["total"])),
            lambda before: F.concat(
                F.flatten(F.transform(parts, lambda p, k: F.transform(p["seen"], lambda v: step(F.get(before["seen"], k), v).cast(kind)))),
                F.array(before["total"]),
            ),
        )

    def blocks(xs: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int"))
        return F.when(F.size(xs) == 0, F.array(zero.cast(kind))).otherwise(bound_once(F.transform(at, lambda b: fold(F.slice(xs, b * block + 1, F.lit(block)))), joined))

    return bound_once(values, blocks)


_MATCH = "array<struct<s:int,e:int,bs:int,be:int,match:string,before:string,after:string>>"


def matches(text: Column, pattern: str, needs: str | None = None, where: Callable[[Column], Column] | None = None) -> Column:
    """array<struct<s, e, bs, be, match, before, after>>: the matches for which ``where`` holds, with their positions and surroundings.

    s and e count code points, bs and be bytes; before and after are the 40
    characters before a match and the 4 after it, up to its neighbours of the same pattern.
    """
    empty = F.array().cast(_MATCH)

    def placed(found: Column) -> Column:
        def rows(between: Column) -> Column:
            # a match follows all earlier texts between and all earlier matches
            sizes = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct((F.length(b) + F.length(m)).alias("n"), (F.octet_length(b) + F.octet_length(m)).alias("bytes")))

            def cut(before: Column) -> Column:
                def row(m: Column, i: Column) -> Column:
                    start = F.get(before, i)
                    ahead = F.get(between, i)
                    return F.struct(
                        (start["n"] + F.length(ahead)).alias("s"),
                        (start["n"] + F.length(ahead) + F.length(m)).alias("e"),
                        (start["bytes"] + F.octet_length(ahead)).alias("bs"),
                        (start["bytes"] + F.octet_length(ahead) + F.octet_length(m)).alias("be"),
                        m.alias("match"),
                        F.substring(ahead, -40, 40).alias("before"),
                        F.substring(F.get(between, i + 1), 1, 4).alias("after"),
                    )

                every = F.transform(found, lambda m, i: F.when(where(m), row(m, i)) if where is not None else row(m, i))
                return F.filter(every, lambda x: x.isNotNull()) if where is not None else every

            add = lambda a, x: F.struct((a["n"] + x["n"]).alias("n"), (a["bytes"] + x["bytes"]).alias("bytes"))
            return bound_once(running(sizes, "struct<n:int,bytes:int>", F.struct(F.lit(0).alias("n"), F.lit(0).alias("bytes")), add), cut)

        some = F.size(found) > 0 if where is None else F.exists(found, where)
        return F.when(some, bound_once(F.split(text, pattern, -1), rows)).otherwise(empty)

    listed = bound_once(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return F.when(F.contains(text, F.lit(needs)), listed).otherwise(empty) if needs else listed
