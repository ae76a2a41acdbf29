"""The gate of a collection: flags of every process, and the criteria over its lot as rows.

A process carries the policy that it was collected under. If any carries the current
one, those alone are the lot; otherwise all are. Processes of the current policy need
each role of the chain exactly once, its edges and one linked contract; earlier ones
need the leading pair, have the other roles at most once, and need the pair's edge.

Nothing is gathered by process: identities are compared by counts over (process,
document), edges by a semi join on all of their columns, so that a process of very
many documents is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.operators.classify import SPHERES
from concord.session import written

#: Roles of the chain in order, of which the first two are the pair; the current policy; the rule that links a contract (fixed values).
CHAIN = ["ETP", "TR", "EDITAL", "CONTRATO"]
CURRENT_POLICY = "8-cadeia-completa-documentos-utilizaveis"
LINK_RULE = "numeroControlePncpCompra"


def allowed_spheres(spheres: Sequence[str] | None = None) -> list[str]:
    """The given spheres trimmed, in capitals and sorted, all of them for None; a ValueError unless they are a non-empty part of ``SPHERES``."""
    chosen = set(SPHERES) if spheres is None else {s.strip().upper() for s in spheres if s.strip()}
    if not chosen or not chosen <= set(SPHERES):
        raise ValueError(f"spheres must be a non-empty part of {sorted(SPHERES)}, got {sorted(chosen)}")
    return sorted(chosen)


def judged_processes(processes: DataFrame, chain: DataFrame, documents: DataFrame, edges: DataFrame, contracts: DataFrame, roles: Sequence[str] = CHAIN, policy: str = CURRENT_POLICY) -> DataFrame:
    """The gate's flags, a row per process.

    processes: process (unique), owner, category, sphere, policy, control (its number),
    supported (profile and codes hold). chain: process, role, document. documents:
    process, document, role, usable. edges: process, from_role, to_role, from_doc,
    to_doc. contracts: process, purchase (the number of the purchase it names), rule.

    Returns process, owner, category, sphere, current, supported, exact (roles of the
    chain), documents_exact (the catalogued ones are those of the chain), usable,
    related, contract_ok, n_contracts, contracts_linked, n_expected and n_usable (its
    documents, where both are exact), eligible and unrelated (sound but for the
    edges). A null flag is false, an id is usable if all its rows are, rows of unknown
    processes are left out. Empty tables give no rows.
    """
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    one = F.lit(1).cast("long")
    linked = chain.where("document is not null").select("process", "role", "document").distinct()
    per_role = linked.groupBy("process").agg(
        *(F.count_if(F.col("role") == r).alias(f"_n{i}") for i, r in enumerate(roles)),
        *(F.max(F.when(F.col("role") == r, F.col("document"))).alias(f"_d{i}") for i, r in enumerate(roles)),
        F.count_if(~F.coalesce(F.col("role").isin(*roles), F.lit(False))).alias("_other"),
    )
    # edges that a chain of single documents asks for
    asked = per_role.select("process", F.inline(F.array(*(F.struct(F.lit(i).alias("step"), F.lit(roles[i]).alias("from_role"), F.lit(roles[i + 1]).alias("to_role"), F.when((F.col(f"_n{i}") == 1) & (F.col(f"_n{i + 1}") == 1), F.col(f"_d{i}")).alias("from_doc"), F.col(f"_d{i + 1}").alias("to_doc")) for i in range(len(roles) - 1)))))
    asked = asked.where("from_doc is not null")
    found = asked.join(edges, ["process", "from_role", "to_role", "from_doc", "to_doc"], "left_semi").groupBy("process").agg(F.count("*").alias("_found"), F.count_if(F.col("step") == 0).alias("_pair"))

    catalogued = documents.groupBy("process").agg(F.count("*").alias("_rows"), *(F.count_if(F.col("role") == r).alias(f"_r{i}") for i, r in enumerate(roles)), F.count_if(~F.coalesce(F.col("role").isin(*roles), F.lit(False))).alias("_strange"))
    expected = linked.where(F.col("role").isin(*roles)).select("process", "document", one.alias("c"), F.lit(None).cast("boolean").alias("usable"))
    held = documents.select("process", "document", F.lit(None).cast("long").alias("c"), F.coalesce("usable", F.lit(False)).alias("usable"))
    ids = expected.unionByName(held).groupBy("process", "document").agg(F.max("c").alias("c"), F.bool_and("usable").alias("u"))
    ids = ids.groupBy("process").agg(F.count("c").alias("_ids"), F.count("u").alias("_held"), F.count_if(F.col("c").isNotNull() & F.col("u").isNotNull()).alias("_both"), F.count_if(F.col("c").isNotNull() & F.col("u")).alias("_sound"))

    named = contracts.join(processes.select("process", "control"), "process")
    links = named.groupBy("process").agg(F.count("*").alias("_contracts"), F.count_if((F.col("purchase") == F.col("control")) & (F.col("rule") == LINK_RULE)).alias("_linked"))
    joined = processes.select("process", "owner", "category", "sphere", "policy", "supported")
    for part in (per_role, found, catalogued, ids, links):
        joined = joined.join(part, "process", "left")

    current = F.coalesce(F.col("policy") == policy, F.lit(False))
    all_of = lambda columns: F.forall(F.array(*columns), lambda c: c)
    n, r = [count(f"_n{i}") for i in range(len(roles))], [count(f"_r{i}") for i in range(len(roles))]
    exact = (count("_other") == 0) & F.when(current, all_of([c == 1 for c in n])).otherwise(all_of([c == 1 for c in n[:2]] + [c <= 1 for c in n[2:]]))
    present = sum((F.when(c > 0, 1).otherwise(0) for c in n[1:]), F.when(n[0] > 0, 1).otherwise(0))
    required = F.when(current, all_of([c > 0 for c in r])).otherwise(all_of([c > 0 for c in r[:2]]))
    documents_exact = (count("_rows") == present) & required & (count("_strange") == 0) & (count("_ids") == count("_both")) & (count("_held") == count("_both"))
    steps = sum((F.when((a == 1) & (b == 1), 1).otherwise(0) for a, b in zip(n[1:], n[2:])), F.when((n[0] == 1) & (n[1] == 1), 1).otherwise(0))
    related = F.when(current, (steps > 0) & (count("_found") == steps)).otherwise(count("_pair") > 0)
    contracts_linked = (count("_contracts") > 0) & (count("_linked") == count("_contracts"))
    flags = joined.select(
        *("process", "owner", "category", "sphere"),
        current.alias("current"),
        F.coalesce("supported", F.lit(False)).alias("supported"),
        exact.alias("exact"),
        documents_exact.alias("documents_exact"),
        (documents_exact & (count("_sound") == count("_ids"))).alias("usable"),
        related.alias("related"),
        (~current | ((count("_contracts") == 1) & contracts_linked)).alias("contract_ok"),
        count("_contracts").alias("n_contracts"),
        contracts_linked.alias("contracts_linked"),
        F.when(exact & documents_exact, count("_ids")).otherwise(0).alias("n_expected"),
        F.when(exact & documents_exact, count("_sound")).otherwise(0).alias("n_usable"),
    )
    sound = F.col("supported") & F.col("exact") & F.col("documents_exact") & F.col("usable")
    return flags.withColumn("eligible", sound & F.col("related") & F.col("contract_ok")).withColumn("unrelated", sound & ~F.col("related"))


def _listed(values: Column) -> Column:
    return F.array_join(F.array_sort(values), ",")


def criteria(judged: DataFrame, documents: DataFrame, roles: Sequence[str] = CHAIN, least: int = 15, per_owner: int | None = 5, owners: int = 5, spheres: Sequence[str] | None = None, categories: int = 3) -> DataFrame:
    """criterion, required, found (both text) and passed: fourteen criteria, and one for each role.

    judged: of ``judged_processes``, whose documents are ``documents`` (process, role).
    A lot's share of the documents by role is required where it is of the current
    policy, a least number for the pair (none for the other roles) otherwise. Found
    spheres are the known ones, AUSENTE for none, and the number of processes with any
    other one after a plus. An empty table of processes gives rows that fail where
    something must be there.
    """
    if categories < 1:
        raise ValueError("categories must be positive")
    allowed = allowed_spheres(spheres)
    # read five times below, so that its joins are run once
    judged = written(judged, "judged")
    is_ = F.col
    sphere = F.coalesce(F.nullif(F.upper(F.trim("sphere")), F.lit("")), F.lit("AUSENTE"))
    supported = is_("supported")
    exact = supported & is_("exact") & is_("documents_exact")
    # a lot of the current policy and one of earlier ones are added up side by side: there are two rows at most
    totals = judged.withColumn("sphere", sphere).groupBy("current").agg(
        F.count("*").alias("processes"),
        F.count_if("eligible").alias("eligible"),
        F.count_if(supported).alias("supported"),
        F.count_if(exact).alias("exact"),
        F.count_if(exact & is_("usable")).alias("usable"),
        F.sum(F.when(exact, is_("n_expected")).otherwise(0)).alias("expected"),
        F.sum(F.when(exact, is_("n_usable")).otherwise(0)).alias("sound"),
        F.count_if(supported & is_("exact") & is_("related")).alias("related"),
        F.count_if(exact & is_("usable") & is_("related") & is_("current")).alias("complete"),
        F.count_if(supported & is_("contract_ok") & is_("current")).alias("contracted"),
        F.count_if(is_("n_contracts") > 0).alias("with_contracts"),
        F.count_if("contracts_linked").alias("linked"),
    )
    # counts by owner, category and sphere, each with as many rows as it has values
    owned = judged.where("eligible and cast(owner as string) <> ''").groupBy("current", "owner").agg(F.count("*").alias("k")).groupBy("current").agg(F.count("*").alias("owners"), F.max("k").alias("most"))
    kinds = judged.where("eligible and category <> ''").groupBy("current").agg(F.count_distinct("category").alias("categories"))
    known = F.when(sphere.isin(*SPHERES, "AUSENTE"), sphere)
    found_spheres = judged.groupBy("current").agg(_listed(F.collect_set(known)).alias("spheres"), F.count_if(~sphere.isin(*allowed)).alias("outside"), F.count_if(known.isNull()).alias("strange"))
    member = judged.select("process", "current", "supported", "eligible")
    by_role = documents.join(member, "process").groupBy("current").agg(
        *(F.count_if(supported & (F.col("role") == r)).alias(f"s{i}") for i, r in enumerate(roles)),
        *(F.count_if(F.col("eligible") & (F.col("role") == r)).alias(f"e{i}") for i, r in enumerate(roles)),
        F.count_if(F.col("eligible") & ~F.coalesce(F.col("role").isin(*roles), F.lit(False))).alias("extra"),
    )
    lots = totals
    for part in (owned, kinds, found_spheres, by_role):
        lots = lots.join(part, "current", "left")
    # the lot: the current policy's row if there is one; without any process a row of nulls
    lot = lots.agg(F.max_by(F.struct(*lots.columns), "current").alias("x")).select(*(F.coalesce(F.col(f"x.{c}"), F.lit("" if c == "spheres" else False if c == "current" else 0)).alias(c) for c in lots.columns))

    text = lambda c: c.cast("string")
    rows = []

    def add(name: str, required: Column, found: Column, passed: Column) -> None:
        rows.append(F.struct(F.lit(name).alias("criterion"), text(required).alias("required"), text(found).alias("found"), passed.alias("passed")))

    def at_least(name: str, column: str, number: int) -> None:
        add(name, F.lit(f">={number}"), is_(column), is_(column) >= number)

    def all_supported(name: str, column: str, also: Column | None = None) -> None:
        passed = (is_("supported") > 0) & (is_(column) == is_("supported"))
        add(name, is_("supported"), is_(column), passed if also is None else passed & also)

    newer = F.when(is_("current"), is_("supported")).otherwise(0)
    at_least("processes", "eligible", least)
    at_least("owners", "owners", owners)
    add("most_per_owner", F.lit("no limit" if per_owner is None else f"<={per_owner}"), is_("most"), F.lit(True) if per_owner is None else (is_("eligible") > 0) & (is_("most") <= per_owner))
    at_least("categories", "categories", categories)
    add("spheres", F.lit(",".join(allowed)), F.concat(F.when(is_("spheres") == "", "-").otherwise(is_("spheres")), F.when(is_("strange") > 0, F.concat(F.lit("+"), text(is_("strange")))).otherwise("")), (is_("processes") > 0) & (is_("outside") == 0))
    at_least("profile", "supported", least)
    at_least("processes_in_filter", "eligible", least)
    all_supported("exact_chain", "exact")
    all_supported("usable_documents", "usable", is_("sound") == is_("expected"))
    all_supported("catalogued_relations", "related")
    add("complete_chains", newer, is_("complete"), is_("complete") == newer)
    add("contract_links", is_("with_contracts"), is_("linked"), is_("linked") == is_("with_contracts"))
    add("linked_contract", newer, is_("contracted"), is_("contracted") == newer)
    add("chain_documents_only", F.lit("0"), is_("extra"), is_("extra") == 0)
    fresh = newer > 0
    for i, r in enumerate(roles):
        floor = F.lit(f">={least}") if i < 2 else F.lit("no floor")
        found = F.when(fresh, is_(f"s{i}")).otherwise(is_(f"e{i}"))
        add(f"documents_{r}", F.when(fresh, F.concat(F.lit("="), text(newer))).otherwise(floor), found, F.when(fresh, is_(f"s{i}") == newer).otherwise(F.lit(True) if i >= 2 else is_(f"e{i}") >= least))
    return lot.select(F.inline(F.array(*rows)))


def markdown(rows: DataFrame) -> str:
    """The criteria, a fixed number of rows, as a Markdown table under the verdict."""
    got = rows.collect()
    lines = [f"**{'PASS' if all(r['passed'] for r in got) else 'FAIL'}**", "", "| criterion | required | found | passed |", "|-|-|-|-|"]
    return "\n".join([*lines, *(f"| {r['criterion']} | {r['required']} | {r['found']} | {'yes' if r['passed'] else 'no'} |" for r in got)])
