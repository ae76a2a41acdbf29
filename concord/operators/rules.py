"""Ordered classifiers, document rules and bilateral comparison as declarative plans."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """The name of the first pattern found in ``text``: patterns are literals, so each compiles once."""
    out = F.lit(default)
    for pattern, name in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def first_term(padded: Column, terms: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The first category one of whose whole-word terms stands in ``padded`` (folded, blanks at the ends)."""
    out = F.lit(default)
    for name, words in reversed(terms):
        found = F.lit(False)
        for word in words:
            found |= F.contains(padded, F.lit(f" {word} "))
        out = F.when(found, F.lit(name)).otherwise(out)
    return out


def missing(present: Column, required: Sequence[str]) -> Column:
    """Required names that are not present, in the canonical order, comma-joined."""
    return F.array_join(F.filter(F.array(*(F.lit(r) for r in required)), lambda r: ~F.array_contains(present, r)), ",")


def match_sides(items: DataFrame, pair: str = "pair_id", dealt: bool = False) -> DataFrame:
    """Items of two documents in three stages: equal numbers (first of each), sole items, then equally many left in order.

    ``items``: pair, side (0 or 1), item_id, number (nullable), pos and any other
    columns. Result: pair, stage, left and right (structs of the items' columns). One
    exchange, by pair: all stages are windows and a grouping within it. Items that are
    ``dealt`` out by pair already need none.
    """
    carried = F.struct(*(F.col(c) for c in items.columns if c not in (pair, "side")))
    rows = items.select(pair, "side", "item_id", "number", "pos", carried.alias("item"))
    rows = rows if dealt else rows.repartition(pair)
    by_number = F.row_number().over(Window.partitionBy(pair, "number", "side").orderBy("pos", "item_id"))
    rows = rows.withColumn("first", F.col("number").isNotNull() & (by_number == 1))
    met = F.size(F.collect_set(F.when(F.col("first"), F.col("side"))).over(Window.partitionBy(pair, "number"))) == 2
    rows = rows.withColumn("numbered", F.col("first") & met)
    both = Window.partitionBy(pair)
    count = lambda condition: F.sum(F.when(condition, 1).otherwise(0)).over(both)
    alone = (count(F.col("side") == 0) == 1) & (count(F.col("side") == 1) == 1) & (count(F.col("numbered")) == 0)
    left_over = ~F.col("numbered")
    rows = rows.withColumn("sole", alone).withColumn("n0", count(left_over & (F.col("side") == 0))).withColumn("n1", count(left_over & (F.col("side") == 1)))
    rank = F.row_number().over(Window.partitionBy(pair, "numbered", "side").orderBy("pos", "item_id"))
    rows = rows.withColumn("rank", rank)
    stage = F.when(F.col("numbered"), "number").when(F.col("sole"), "sole").when(F.col("n0") == F.col("n1"), "position")
    key = F.when(F.col("numbered"), F.col("number")).otherwise(F.col("rank"))
    side = lambda n: F.first(F.when(F.col("side") == n, F.col("item")), ignorenulls=True)
    matched = rows.withColumn("stage", stage).where("stage is not null").groupBy(pair, "stage", key.alias("key")).agg(side(0).alias("left"), side(1).alias("right"))
    return matched.select(pair, "stage", "left", "right")


def match_items(left: DataFrame, right: DataFrame, pair: str = "pair_id") -> DataFrame:
    """``match_sides`` of two tables (pair, item_id, number, pos): pair, left_id, right_id, stage."""
    columns = [pair, "item_id", "number", "pos"]
    both = left.select(*columns, F.lit(0).alias("side")).unionByName(right.select(*columns, F.lit(1).alias("side")))
    return match_sides(both, pair).select(pair, F.col("left.item_id").alias("left_id"), F.col("right.item_id").alias("right_id"), "stage")


#: A comparison: rule, level, severity, and the canonical value of a side.
Comparison = tuple[str, str, Column | str, Callable[[Column], Column]]


def compare(pairs: DataFrame, comparisons: Sequence[Comparison], keys: Sequence[str], left: str = "left", right: str = "right") -> DataFrame:
    """Findings of bilateral rules, in one pass: both sides' canonical values are known and differ.

    ``pairs`` holds a struct for each side, with pos, its evidence. Result: rule_id,
    level, severity, ``keys``, left_value, right_value, left_pos, right_pos.
    """
    rows = []
    for rule, level, severity, canonical in comparisons:
        a, b = canonical(F.col(left)), canonical(F.col(right))
        graded = F.lit(severity) if isinstance(severity, str) else severity
        row = F.struct(F.lit(rule).alias("rule_id"), F.lit(level).alias("level"), graded.alias("severity"), a.cast("string").alias("left_value"), b.cast("string").alias("right_value"))
        rows.append(F.when(a.isNotNull() & b.isNotNull() & (a != b), row))
    found = pairs.select(*keys, F.col(f"{left}.pos").alias("left_pos"), F.col(f"{right}.pos").alias("right_pos"), F.inline(F.array_compact(F.array(*rows))))
    return found.select("rule_id", "level", "severity", *keys, "left_value", "right_value", "left_pos", "right_pos")


def first_fields(fields: DataFrame, canonical: Mapping[str, Callable[[Column], Column]], pair: str = "pair_id") -> DataFrame:
    """fields (pair, side, field, value, pos) to pair and a struct for each side: per field its first value that can be read, and pos.

    A grouped minimum: values that cannot be read are passed over.
    """
    aggregates = []
    for side in (0, 1):
        columns = []
        for field, read in canonical.items():
            mine = (F.col("side") == side) & (F.col("field") == field) & read(F.col("value")).isNotNull()
            columns.append(F.min_by(F.when(mine, read(F.col("value"))), F.when(mine, F.col("pos"))).alias(field))
        aggregates.append(F.struct(*columns, F.min(F.when(F.col("side") == side, F.col("pos"))).alias("pos")).alias("left" if side == 0 else "right"))
    return fields.groupBy(pair).agg(*aggregates)


def contradictions(mentions: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Per key the first mention and the first later one that differs from it."""
    first = mentions.groupBy(*keys).agg(F.min_by(value, order).alias("first_value"))
    other = mentions.join(first, list(keys)).where(F.col(value) != F.col("first_value"))
    return other.groupBy(*keys).agg(F.min("first_value").alias("first_value"), F.min_by(value, order).alias("other_value"), F.count("*").alias("n_other"))
