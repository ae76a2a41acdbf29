"""Links between similar sets, without all pairs of the sets that share a key.

Nodes have keys, one of which similar sets share, and every candidate is confirmed
on the two whole sets. A key that many nodes share is not turned into all of its
pairs: a few pivots, its least node and some drawn by a hash, are compared with the
others and leave, groups are joined by connected components, and a key whose nodes
are all in one group is done. Each further round has some times more pivots. Once the pairs left over are few, they are all compared.
Nothing is capped. Groups that another search has linked already may be given to start with.

Nodes may have a sketch: their set's size and a bit for the parity of its members in
each of so many cells as the set has members at least, a power of two. Two sets
differ in at least as many members as their bits do, which bounds what they share
from above: the whole sets are fetched for pairs alone that the bound lets through.
The keys carry the sizes only, as a node's sketch would go along with each of its
keys; the sketches join the distinct pairs of fitting sizes. No link is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.operators.components import connected_components
from concord.session import Scratch, scratch, written

#: Pivots of a key in the first round, and how many times more in each further one.
FIRST_PIVOTS, MORE_PIVOTS = 4, 4
#: Pairs a node that are compared at once, without sketches and with them, which leave few for the whole sets.
DIRECT, SKETCHED_DIRECT = 4, 16


def _confirmed(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similar: tuple[int, int], folders: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of at least ``similar``, a fraction."""
    pairs = written(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = written(sets_of(ends), "sets")
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"_{c}"))
    both = F.size(F.array_intersect("_a", "_b"))
    up, down = similar
    # i / (n - i) >= up / down, with n the sizes' sum
    enough = both * (up + down) >= up * (F.size("_a") + F.size("_b"))
    found = written(pairs.join(side("b"), "b").join(side("a"), "a").where(enough).select("a", "b"), "links")
    folders.drop(pairs, sets)
    return found


def _fitting(similar: tuple[int, int], x: Column, y: Column) -> Column:
    """The smaller of two sets of these sizes has enough members."""
    up, down = similar
    return F.least(x, y) * down >= up * F.greatest(x, y)


def _apart(x: Column, y: Column) -> Column:
    """Bits in which two sketches differ; the longer one, of twice the cells at most, is folded."""
    words = F.least(F.size(x), F.size(y))

    def word(bits: Column, i: Column) -> Column:
        return F.get(bits, i).bitwiseXOR(F.when(F.size(bits) > words, F.get(bits, i + words)).otherwise(F.lit(0)))

    return F.aggregate(F.sequence(F.lit(0), words - 1), F.lit(0), lambda n, i: n + F.bit_count(word(x, i).bitwiseXOR(word(y, i))))


def _may_link(pairs: DataFrame, sketches: DataFrame | None, similar: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that the nodes' sketches (size, bits) allow the similarity; all of them where there are none."""
    if sketches is None:
        return pairs
    side = lambda c: sketches.select(F.col("node").alias(c), F.col("sketch").alias(f"_{c}"))
    x, y = F.col("_a"), F.col("_b")
    up, down = similar
    both = x["size"] + y["size"]
    # what is shared is at most half of what is left of both sizes
    enough = (both - _apart(x["bits"], y["bits"])) * (up + down) >= 2 * up * both
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_fitting(similar, x["size"], y["size"]) & enough).select("a", "b")


def groups_of_pairs(pairs: DataFrame, nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similar: tuple[int, int]) -> DataFrame:
    """(node, group) of the nodes (node, sketch) that the pairs (a, b) connect, as far as they are confirmed: group is the least node."""
    with scratch(nodes.sparkSession) as folders:
        found = _confirmed(_may_link(pairs, nodes, similar), sets_of, similar, folders)
        groups = written(connected_components(found).toDF("node", "group"), "groups")
        folders.discard(groups)
    return groups


def linked_groups(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similar: tuple[int, int], direct: int | None = None, sketches: DataFrame | None = None, start: DataFrame | None = None) -> DataFrame:
    """(node, group) of the nodes (node, keys) that share a key: group is the least node that confirmed candidates connect with it.

    ``sets_of`` gives (node, shingles) of a table of nodes; up to ``direct`` pairs are
    compared at once. ``sketches`` has every node's sketch: a struct of size and bits
    (longs). ``start`` has the groups (node, group) that are known.
    """
    with scratch(nodes.sparkSession) as folders:
        return _linked_groups(nodes, sets_of, similar, direct, sketches, start, folders)


def _linked_groups(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similar: tuple[int, int], direct: int | None, sketches: DataFrame | None, start: DataFrame | None, folders: Scratch) -> DataFrame:
    size = [] if sketches is None else ["size"]
    fit = (lambda x, y: F.lit(True)) if sketches is None else (lambda x, y: _fitting(similar, F.col(x), F.col(y)))
    # dealt by the key, for the count and the join
    keyed = nodes.select(F.explode("keys").alias("key"), "node").repartition("key")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    # most keys are one node's, so sizes join afterwards
    open_ = keyed.join(shared, "key")
    open_ = open_ if sketches is None else open_.join(sketches.select("node", F.col("sketch.size").alias("size")), "node")
    known = open_.withColumn("group", F.col("node")) if start is None else open_.join(start, "node", "left").withColumn("group", F.coalesce("group", "node"))
    live = written(known.select("key", "node", "group", *size), "keys")
    labels = written(live.select("node", "group").distinct(), "members")
    direct = (DIRECT if sketches is None else SKETCHED_DIRECT) * nodes.count() if direct is None else direct
    steps: list[DataFrame] = []  # what each round made of the groups before it
    pivots = FIRST_PIVOTS
    while True:
        parts = live.groupBy("key", "group").agg(F.count("*").alias("n"), F.min("node").alias("least"))
        sized = parts.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("groups"), F.max("n").alias("most"), F.max_by("group", F.struct("n", "group")).alias("big"), F.min("least").alias("first"))
        mixed = written(sized.where("n > most").select("key", "n", "groups", "most", "big", "first"), "mixed")
        left = mixed.agg(F.sum(F.col("n").cast("double") * (F.col("n") - F.col("most")))).first()[0]
        if not left:
            break
        rest = live.join(mixed.select("key", "groups", "big", "first"), "key")
        if left <= direct:
            # two nodes of a key's largest group need no comparison
            x = rest.where(F.col("group") != F.col("big")).select("key", F.col("node").alias("a"), F.col("group").alias("g"), *size)
            y = rest.select("key", F.col("node").alias("b"), F.col("group").alias("h"), *(F.col(c).alias(f"_{c}") for c in size))
            pairs = x.join(y, "key").where((F.col("g") != F.col("h")) & fit("size", "_size")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            steps.append(_joined(_confirmed(_may_link(pairs, sketches, similar), sets_of, similar, folders), live))
            break
        # about ``pivots`` nodes of a key, the same ones of keys that share their nodes, are compared with all of its others, and leave
        share = F.pmod(F.xxhash64(F.lit(pivots), "node"), F.lit(1 << 30))
        drawn = (F.col("node") == F.col("first")) | (share * F.col("groups") < F.lit((pivots - 1) << 30))
        marked = rest.withColumn("pivot", drawn)
        own = marked.where("pivot").select("key", F.col("node").alias("p"), F.col("group").alias("g"), *(F.col(c).alias(f"_{c}") for c in size))
        met = marked.select("key", "node", "group", *size).join(own, "key").where((F.col("group") != F.col("g")) & fit("size", "_size"))
        pairs = met.select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b")).distinct()
        steps.append(_joined(_confirmed(_may_link(pairs, sketches, similar), sets_of, similar, folders), live))
        # the round's components are written, so nothing reads the keys before them any more
        before, live = live, written(marked.where("not pivot").select("key", "node", "group", *size).join(steps[-1], "group", "left").select("key", "node", F.coalesce("fresh", "group").alias("group"), *size), "keys")
        folders.drop(before, mixed)
        pivots *= MORE_PIVOTS
    for step in steps:
        labels = labels.join(step, "group", "left").select("node", F.coalesce("fresh", "group").alias("group"))
    return written(labels, "labels")


def _joined(found: DataFrame, live: DataFrame) -> DataFrame:
    """(group, fresh): the groups that the links (a, b) join, with the least of them."""
    groups = live.select("node", "group").distinct()
    edges = found.join(groups.toDF("a", "g"), "a").join(groups.toDF("b", "h"), "b").select(F.col("g").alias("a"), F.col("h").alias("b"))
    return connected_components(edges).select(F.col("node").alias("group"), F.col("component").alias("fresh"))
