"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Sources share a number of words by weight; a target stops at ``most`` times its
source's size and the excess goes on by weight, which is the level of water in
vessels of that height and is read off the sources sorted by size over weight.

Within a source a document's expected number of copies is proportional to a power
of its size (longer documents more often, 0: all alike), at most ``most``, such
that the expected words are the target; the factor is read off the source's
distinct sizes in the same way. The whole part of the expected copies is allocated
for certain. For the rest, documents are ranked by random odds divided by the odds
of their remaining inclusion, u / (1 - u) over p / (1 - p), and the first ones are
taken: as many as bring the source's words nearest to its target.

That place in the order is found without sorting a source: ranks are hexadecimal
keys; the words of each source are summed by the keys' next three digits, the
digits that hold the place are settled, and so on until few rows share them.

Defined results: null texts have no words and are never taken; null sources are one
source, the last; rows that repeat an id are drawn apart; equal rows are told apart
by their place in the input, so that reruns give the same rows as often; an empty
table gives no rows; columns named as the result's own are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.llm.common import kept, unused
from concord.session import written

#: Weights of the sources in order, again and again.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words of the mix as a share of all words; copies of a document at most.
SHARE, MOST = 1.5, 2
#: The power of a document's size to which its expected copies are proportional.
POWER = 0.5
SEED = 13
#: Rows that a source's order is sorted for; more are told apart by further digits.
FINE = 20_000
_DIGITS, _KEY = 3, 45
ADDED = ("size", "source_size", "target", "copies")
WORD = "[^\\x20\\x09-\\x0D]++"


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) with target: the words each source is to give. A row a source is all that is sorted."""
    order = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    vessel = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("height", F.col("cap") / F.col("weight"))
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"))
    filled = Window.orderBy("height", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("height", F.asc_nulls_last("source")).rowsBetween(0, Window.unboundedFollowing)
    levels = vessel.crossJoin(total).select("source", "source_size", "weight", "cap", "height", (F.col("words") * F.lit(share) - F.coalesce(F.sum("cap").over(filled), F.lit(0.0))).alias("free"), F.sum("weight").over(rest).alias("among"))
    # the lowest vessel that does not fill up has the level
    level = levels.where("free <= height * among").agg(F.min_by(F.struct("free", "among"), F.struct("height", "free")).alias("level"))
    even = F.col("level.free") * F.col("weight") / F.col("level.among")
    return levels.crossJoin(level).select("source", "source_size", F.coalesce(F.least("cap", even), "cap").alias("target"))


def _factors(sizes: DataFrame, wanted: DataFrame, most: int, power: float) -> DataFrame:
    """Per source the factor of size ** power in a document's expected copies; null where all documents have ``most``."""
    grown = sizes.where("size > 0").withColumn("pull", F.pow("size", F.lit(power))).join(wanted.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    order = Window.partitionBy("source").orderBy("size")
    larger = F.coalesce(F.sum(F.col("size") * F.col("documents")).over(order.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    pulled = F.sum(F.col("pull") * F.col("size") * F.col("documents")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    tried = grown.withColumn("factor", (F.col("target") - F.lit(most) * larger) / pulled)
    fits = tried.where((F.col("factor") * F.col("pull") <= most) & (F.col("factor") >= 0) & (F.col("target") < F.col("source_size") * F.lit(float(most))))
    return fits.groupBy("source").agg(F.max_by("factor", "size").alias("factor"))


def _digits(number: Column, length: int) -> Column:
    return F.lpad(F.hex(number), length, "0")


def _cuts(drawn: DataFrame, needs: DataFrame, fine: int) -> DataFrame:
    """(source, last): the greatest key taken. ``drawn`` has (source, size, key), ``needs`` (source, need) the words to take."""
    cuts = needs.select("source", F.lit("").alias("digits"), "need")
    length = 0
    while True:
        open_ = drawn.join(cuts.select(F.col("source").alias("_s"), "digits", "need"), F.col("source").eqNullSafe(F.col("_s")) & F.startswith("key", "digits"))
        length += _DIGITS
        parts = open_.groupBy("source", "need", F.substring("key", 1, length).alias("digits")).agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        ends = parts.withColumn("end", F.sum("words").over(Window.partitionBy("source").orderBy("digits")))
        found = ends.where("end >= need").groupBy("source").agg(F.min_by(F.struct("digits", (F.col("need") - F.col("end") + F.col("words")).alias("need"), "rows"), "digits").alias("at"))
        cuts = written(found.select("source", "at.digits", "at.need", "at.rows"), "cuts")
        most = cuts.agg(F.max("rows")).first()[0] or 0
        if most <= fine or length >= _KEY:
            break
    last = drawn.join(cuts.select(F.col("source").alias("_s"), "digits", "need"), F.col("source").eqNullSafe(F.col("_s")) & F.startswith("key", "digits"))
    end = F.sum("size").over(Window.partitionBy("source").orderBy("key"))
    # the document at the place is taken if that brings the words nearer
    taken = last.withColumn("end", end).where(F.col("need") >= F.col("end") - F.col("size") / 2).groupBy("source").agg(F.max("key").alias("key"))
    joined = cuts.join(taken.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").select("source", F.coalesce("key", "digits").alias("last"))
    # a source whose documents give fewer words than needed gives all of them
    return needs.select(F.col("source").alias("_s")).join(joined, F.col("source").eqNullSafe(F.col("_s")), "left").select(F.col("_s").alias("source"), F.coalesce("last", F.lit("g")).alias("last"))


def mix(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: list[str] | None = None, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, power: float = POWER, seed: int = SEED, fine: int = FINE) -> DataFrame:
    """The documents (columns ``keep``, all by default) with size, source_size, target and copies, the times that the mix has them."""
    columns = kept(documents, keep, ADDED)
    names = [unused(documents, f"_c{i}") for i in range(len(columns))]
    draw = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    named = [F.col(c).alias(n) for c, n in zip(columns, names, strict=True)]
    rows = written(documents.select(*named, F.col(source).alias("source"), size.alias("size"), draw.alias("draw"), F.xxhash64(F.monotonically_increasing_id()).alias("row")), "sized")
    sizes = rows.groupBy("source", "size").agg(F.count("*").alias("documents"))
    wanted = targets(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("documents")).alias("source_size")), weights, share, most)
    factors = _factors(sizes, wanted, most, power).withColumnRenamed("source", "_s")
    per_source = written(wanted.join(factors, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "factors")
    expected = F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("factor").isNull(), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.col("factor") * F.pow("size", F.lit(power))))
    told = rows.join(per_source.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("expected", expected)
    told = told.withColumn("certain", F.floor("expected")).withColumn("p", F.col("expected") - F.col("certain"))
    u = (F.shiftrightunsigned("draw", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    odds = u / (1 - u) * (1 - F.col("p")) / F.col("p")
    key = F.concat(_digits((odds / (1 + odds) * F.lit(float(1 << 52))).cast("long"), 13), _digits(F.col("draw"), 16), _digits(F.col("row"), 16))
    told = told.withColumn("key", F.when(F.col("p") > 0, key))
    drawn = told.where("key is not null").select("source", "size", "key")
    needs = told.groupBy("source").agg((F.first("target") - F.sum(F.col("certain") * F.col("size"))).alias("need"), F.count("key").alias("drawn")).where("drawn > 0").select("source", "need")
    cuts = _cuts(drawn, written(needs, "needs"), fine)
    told = told.join(cuts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
    copies = F.col("certain") + F.when(F.col("key") <= F.col("last"), F.lit(1)).otherwise(F.lit(0))
    return told.select(*(F.col(n).alias(c) for n, c in zip(names, columns, strict=True)), "size", "source_size", "target", copies.alias("copies"))


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it has copies, with its own columns."""
    found = mix(documents, **options)
    return found.withColumn("copies", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop(*ADDED)
