"""Keep-first, latest, interleaving, windows and chains as window and grouping plans."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``; rows with a null key go.

    A grouped minimum, so equal keys are combined before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    first = df.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


def latest(df: DataFrame, keys: Sequence[str], revision: Sequence[str | Column]) -> DataFrame:
    """One row per key: the last in ``revision``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*revision)).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, name: str, lagged: tuple[str, str] | None = None) -> DataFrame:
    """``name``: each row's number within its key, from 1, in ``order``; with ``lagged`` (column, name) also the column's value in the row before.

    ``bucket`` must grow with the order (a day, a range of ids): a key is numbered
    bucket by bucket and the counts of its earlier buckets are added, so that a key
    with very many rows is not one task's. Null keys are one key.
    """
    rows = df.withColumn("_bucket", bucket)
    last = [F.max_by(lagged[0], F.struct(*order)).alias("_last")] if lagged else []
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"), *last)
    earlier = Window.partitionBy(*keys).orderBy("_bucket")
    before = F.coalesce(F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.struct(*keys, "_bucket").alias("_key"), before.alias("_before"), *([F.lag("_last").over(earlier).alias("_last")] if lagged else []))
    own = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(own)).withColumn("_key", F.struct(*keys, "_bucket"))
    if lagged:
        ranked = ranked.withColumn("_lag", F.lag(lagged[0]).over(own))
    joined = ranked.alias("r").join(offsets.alias("o"), F.col("r._key").eqNullSafe(F.col("o._key")))
    out = [*(F.col(f"r.{c}") for c in df.columns), (F.col("_before") + F.col("_rank")).cast("long").alias(name)]
    if lagged:
        out.append(F.when(F.col("_rank") == 1, F.col("o._last")).otherwise(F.col("_lag")).alias(lagged[1]))
    return joined.select(*out)


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column], buckets: Sequence[Column], depth: int = 0) -> DataFrame:
    """Adds to each row the sums over its key's earlier rows, its own value left out, as longs.

    ``buckets``, from fine to coarse, must each grow with the order and with the one
    before: rows are summed within the finest, its totals within the next, and so on,
    so that neither a hot key nor the whole table (no keys) is one task's.
    """
    if not buckets:
        earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.select("*", *(F.coalesce(F.sum(v).over(earlier), F.lit(0)).cast("long").alias(n) for n, v in sums.items()))
    names = [f"_bucket{depth}_{k}" for k in range(len(buckets))]
    rows = df.select("*", *(b.alias(n) for n, b in zip(names, buckets, strict=True)))
    totals = rows.groupBy(*keys, *names).agg(*(F.sum(v).alias(f"_total_{n}") for n, v in sums.items()))
    before = running_sums(totals, keys, names[:1], {f"_before_{n}": F.col(f"_total_{n}") for n in sums}, [F.col(n) for n in names[1:]], depth + 1)
    offsets = before.select(F.struct(*keys, names[0]).alias("_key"), *(f"_before_{n}" for n in sums))
    own = running_sums(rows, [*keys, names[0]], order, {f"_own_{n}": v for n, v in sums.items()}, []).withColumn("_key", F.struct(*keys, names[0]))
    joined = own.alias("r").join(offsets.alias("o"), F.col("r._key").eqNullSafe(F.col("o._key")))
    return joined.select(*(F.col(f"r.{c}") for c in df.columns), *((F.col(f"_own_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums))


def initial_candidates(contracts: DataFrame, purchase: str, initial: str, order: Sequence[str], bucket: Column) -> DataFrame:
    """A purchase's initial contracts with their place (from 1) in ``order``; of a purchase without any, its first contract. ``bucket`` as in ``numbered``; rows without a purchase go."""
    named = contracts.where(F.col(purchase).isNotNull())
    own = named.where(F.col(initial))
    rest = named.join(own.select(purchase).distinct(), purchase, "left_anti")
    return numbered(own, [purchase], order, bucket, "place").unionByName(keep_first(rest, [purchase], order).withColumn("place", F.lit(1).cast("long")))


def round_robin(df: DataFrame, owner: str, order: str, bucket: Column) -> DataFrame:
    """turn and first: sorting by both takes one row of each owner in turn, owners by first appearance; ``bucket`` as in ``numbered``."""
    first = df.groupBy(F.col(owner).alias("_owner")).agg(F.min(order).alias("first"))
    turns = numbered(df, [owner], [order], bucket, "turn")
    return turns.join(first, F.col(owner).eqNullSafe(F.col("_owner"))).drop("_owner")


def reverse_windows(day: Column, end: Column, days: int) -> Column:
    """Number of the window of ``days`` days that holds ``day``, counted back from ``end``."""
    return F.floor(F.datediff(end, day) / days)


def role_edges(df: DataFrame, owner: Sequence[str], role: str, roles: Sequence[str]) -> DataFrame:
    """An edge between each two neighbouring present roles of an owner, in the order of ``roles``: from_role, to_role, n_from, n_to and n_links.

    Every member of the one is linked with every member of the other; the members
    themselves stay in ``df``, so that no pair of them is listed.
    """
    rank = F.array_position(F.array(*(F.lit(r) for r in roles)), F.col(role))
    present = df.withColumn("_rank", rank).where("_rank > 0").groupBy(*owner, "_rank", F.col(role).alias("from_role")).agg(F.count("*").alias("n_from"))
    # as many rows an owner as there are roles
    following = Window.partitionBy(*owner).orderBy("_rank")
    steps = present.withColumn("to_role", F.lead("from_role").over(following)).withColumn("n_to", F.lead("n_from").over(following)).where("to_role is not null")
    return steps.select(*owner, "from_role", "to_role", "n_from", "n_to", (F.col("n_from") * F.col("n_to")).alias("n_links"))


def merge_catalogue(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """New rows, and old ones whose key no new row has."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def first_reason(reasons: Sequence[tuple[Column, str]]) -> Column:
    """The name of the first condition that holds; null if none does."""
    out = F.lit(None).cast("string")
    for condition, name in reversed(reasons):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def gap_clusters(df: DataFrame, owner: str | Sequence[str], value: str, gap: float) -> DataFrame:
    """cluster: number, from 0, of the run of values no further than ``gap`` apart, within each owner."""
    w = Window.partitionBy(owner).orderBy(value)
    starts = df.withColumn("_far", F.when(F.col(value) - F.lag(value).over(w) > gap, 1).otherwise(0))
    return starts.withColumn("cluster", F.sum("_far").over(w).cast("long")).drop("_far")


def queue_summary(tasks: DataFrame, owner: Sequence[str], status: str, task: str, done: str = "done", pending: str = "pending", retry: str = "retry") -> DataFrame:
    """A queue's tasks by state, the ids of those to be tried again, and whether its coverage is incomplete; one row a queue."""
    is_ = lambda s: F.col(status) == s
    errors = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(is_(retry), F.col(task)))), lambda t: t.cast("string")), ",")
    counts = [F.count("*").alias("tasks"), *(F.count_if(is_(s)).alias(n) for n, s in (("done", done), ("pending", pending), ("retry", retry))), errors.alias("errors")]
    return tasks.groupBy(*owner).agg(*counts).withColumn("incomplete", (F.col("pending") > 0) | (F.col("retry") > 0))


def document_chains(documents: DataFrame, roles: Sequence[str]) -> DataFrame:
    """process, the number of its documents of each role, docs, and sound: all opened with text."""
    counts = [F.count_if(F.col("role") == r).alias(r) for r in roles]
    return documents.groupBy("process").agg(*counts, F.count("*").alias("docs"), F.bool_and(F.col("opened") & ~F.col("needs_ocr")).alias("sound"))


def _complete(roles: Sequence[str]) -> Column:
    exact = F.col("docs") == len(roles)
    for r in roles:
        exact &= F.col(r) == 1
    return F.coalesce(exact & F.col("sound"), F.lit(False))


def _each(roles: Sequence[str], holds: Callable[[Column], Column]) -> Column:
    out = F.lit(True)
    for r in roles:
        out &= holds(F.col(r))
    return F.coalesce(out, F.lit(False))


def catalogue_statistics(processes: DataFrame, documents: DataFrame, roles: Sequence[str], pair: Sequence[str]) -> DataFrame:
    """key, value and n: totals (value empty) and histograms of a catalogue.

    processes: process, owner, eligible, category, sphere; documents: process, role,
    opened, needs_ocr. Empty categories are none; a null sphere counts as "-".
    """
    joined = processes.withColumn("category", F.nullif("category", F.lit(""))).join(document_chains(documents, roles), "process", "left")
    eligible = F.col("eligible")
    totals = {
        "processes": F.count("*"),
        "eligible": F.count_if(eligible),
        "out_of_scope": F.count_if(~eligible),
        "owners": F.count_distinct("owner"),
        "owners_eligible": F.count_distinct(F.when(eligible, F.col("owner"))),
        "categories": F.count_distinct("category"),
        "categories_eligible": F.count_distinct(F.when(eligible, F.col("category"))),
        **{f"with_{r}": F.count_if(F.col(r) > 0) for r in roles},
        "with_pair": F.count_if(_each(pair, lambda c: c > 0)),
        "with_pair_eligible": F.count_if(eligible & _each(pair, lambda c: c > 0)),
        "complete": F.count_if(_complete(roles)),
    }
    held = {"documents": F.count("*"), "opened": F.count_if("opened"), "with_text": F.count_if(F.col("opened") & ~F.col("needs_ocr")), "need_ocr": F.count_if("needs_ocr")}

    def rows(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
        one = df.agg(*(c.alias(k) for k, c in counts.items()))
        return one.select(F.inline(F.array(*(F.struct(F.lit(k).alias("key"), F.lit("").alias("value"), F.col(k).alias("n")) for k in counts))))

    def histogram(df: DataFrame, key: str, column: Column) -> DataFrame:
        return df.groupBy(column.alias("value")).agg(F.count("*").alias("n")).select(F.lit(key).alias("key"), "value", "n")

    known = joined.where("category is not null")
    own = documents.join(processes.where("eligible").select("process"), "process", "left_semi")
    out = rows(joined, totals).unionByName(rows(documents, held))
    for part in (histogram(documents, "by_role", F.col("role")), histogram(processes, "by_sphere", F.coalesce("sphere", F.lit("-"))), histogram(known, "by_category", F.col("category")), histogram(known.where("eligible"), "by_category_eligible", F.col("category")), histogram(own, "by_eligible_role", F.col("role"))):
        out = out.unionByName(part)
    return out


def gate(processes: DataFrame, documents: DataFrame, roles: Sequence[str], pair: Sequence[str], criteria: Sequence[tuple[str, str, str, int | None]]) -> DataFrame:
    """criterion, required, found and passed over the eligible processes.

    ``criteria``: name, measure, comparison (">=", "<=", "=") and the required number,
    None for that of the eligible processes. Measures: n_eligible, owners, most (of one
    owner), categories, spheres, pairs (exactly one of each of ``pair``), sound (all
    documents usable), related (both of ``pair``), complete (exactly one of each role
    and usable), others (with documents of other roles).
    """
    eligible = processes.where("eligible").join(document_chains(documents, roles), "process", "left")
    known = sum((F.col(r) for r in roles[1:]), F.col(roles[0]))
    measures = {
        "n_eligible": F.count("*"),
        "owners": F.count_distinct("owner"),
        "categories": F.count_distinct(F.nullif("category", F.lit(""))),
        "spheres": F.count_distinct("sphere"),
        "pairs": F.count_if(_each(pair, lambda c: c == 1)),
        "sound": F.count_if(F.coalesce("sound", F.lit(False))),
        "related": F.count_if(_each(pair, lambda c: c > 0)),
        "complete": F.count_if(_complete(roles)),
        "others": F.count_if(F.col("docs") > known),
    }
    most = eligible.groupBy("owner").agg(F.count("*").alias("k")).agg(F.max("k").alias("most"))
    one = eligible.agg(*(c.alias(k) for k, c in measures.items())).crossJoin(most)  # one row each
    compared = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, "=": lambda a, b: a == b}
    rows = []
    for name, measure, comparison, number in criteria:
        required = F.col("n_eligible") if number is None else F.lit(number).cast("long")
        rows.append(F.struct(F.lit(name).alias("criterion"), required.alias("required"), F.col(measure).alias("found"), compared[comparison](F.col(measure), required).alias("passed")))
    return one.select(F.inline(F.array(*rows)))
