"""The gate: what makes a process eligible, empty tables, odd rows, and the report."""

import pytest

from concord.operators import gate as G

P = "process string, owner string, category string, sphere string, policy string, control string, supported boolean, usable string"
CHAIN, DOCS = "process string, role string, document string", "process string, document string, role string, usable boolean, exact int"
EDGES, CONTRACTS = "process string, from_role string, to_role string, from_doc string, to_doc string", "process string, purchase string, rule string"
ROLES = G.CHAIN


def whole(p, roles=ROLES):
    """A process's chain, documents, edges and contract with nothing missing."""
    chain = [(p, r, f"{p}-{r}") for r in roles]
    return chain, [(a, d, r, True, 1) for a, r, d in chain], [(p, a, b, f"{p}-{a}", f"{p}-{b}") for a, b in zip(roles, roles[1:])], [(p, p, G.LINK_RULE)]


def tables(spark, processes, parts):
    rows = [sum((p[i] for p in parts), []) for i in range(4)]
    return spark.createDataFrame(processes, P), *(spark.createDataFrame(r, s) for r, s in zip(rows, (CHAIN, DOCS, EDGES, CONTRACTS)))


def process(p, policy=G.CURRENT_POLICY, supported=True, owner=None):
    return (p, owner or f"o{p}", f"c{p}", "e", policy, p, supported, "an extra column")


def test_each_gap_makes_a_process_fail(spark):
    names = "ok role extra document unusable edge contract linked twice stranger unsupported old".split()
    parts = {n: list(map(list, whole(n))) for n in names}
    parts["role"][0].pop()  # the chain lacks a role
    parts["extra"][0].append(("extra", "ETP", "another"))
    parts["document"][1].pop()
    parts["unusable"][1][0] = ("unusable", "unusable-ETP", "ETP", None, 1)
    parts["edge"][2].pop()
    parts["contract"][3].clear()
    parts["linked"][3][0] = ("linked", "other", G.LINK_RULE)
    parts["twice"][3].append(("twice", "twice", G.LINK_RULE))
    parts["stranger"][1].append(("stranger", "x", None, True, 1))
    parts["old"] = list(map(list, whole("old", ["ETP", "TR"])))
    parts["old"][3].clear()
    processes = [process(n, policy=None if n == "old" else G.CURRENT_POLICY, supported=None if n == "unsupported" else True) for n in names]
    processes.append(process("without anything"))
    judged = G.judged_processes(*tables(spark, processes, parts.values()))
    got = {r.process: r for r in judged.collect()}
    assert {n for n, r in got.items() if r.eligible} == {"ok", "old"}
    assert {n for n, r in got.items() if r.unrelated} == {"edge"}
    assert {n for n, r in got.items() if not r.exact} == {"role", "extra", "without anything"}
    assert {n for n, r in got.items() if not r.documents_exact} == {"role", "extra", "document", "stranger", "without anything"}
    assert {n for n, r in got.items() if not r.contract_ok} == {"contract", "linked", "twice", "without anything"}
    assert (got["unusable"].n_expected, got["unusable"].n_usable, got["unusable"].usable) == (4, 3, False)


def test_a_sound_lot_passes_and_earlier_processes_neither_help_nor_harm(spark):
    parts = [*(whole(f"p{i}") for i in range(4)), whole("old", ["ETP"])]
    all_tables = tables(spark, [*(process(f"p{i}") for i in range(4)), process("old", policy="7")], parts)
    rows = G.criteria(G.judged_processes(*all_tables), all_tables[2], least=4, owners=4)
    got = {r.criterion: r for r in rows.collect()}
    assert len(got) == 18 and all(r.passed for r in got.values())
    assert got["documents_CONTRATO"].required == "=4" and got["spheres"].found == "E"
    assert G.markdown(rows).startswith("**PASS**\n\n| criterion |")
    few = {r.criterion: r.passed for r in G.criteria(G.judged_processes(*all_tables), all_tables[2], least=5, owners=4, per_owner=None, spheres=[" f "]).collect()}
    assert {c for c, passed in few.items() if not passed} == {"processes", "profile", "processes_in_filter", "spheres"}


def test_repeated_rows_change_what_they_should_and_edges_may_repeat(spark):
    chain, documents, edges, contracts = whole("p")
    repeated = tables(spark, [process("p")], [(chain * 2, documents, edges * 3, contracts)])
    assert G.judged_processes(*repeated).first().eligible
    copied = tables(spark, [process("p")], [(chain, documents * 2, edges, contracts)])
    assert not G.judged_processes(*copied).first().documents_exact


def test_empty_tables_and_wrong_parameters(spark):
    empty = tables(spark, [], [([], [], [], [])])
    judged = G.judged_processes(*empty)
    assert judged.count() == 0
    rows = G.criteria(judged, empty[2])
    got = {r.criterion: r for r in rows.collect()}
    assert len(got) == 18 and got["spheres"].found == "-" and not got["spheres"].passed and not got["processes"].passed and got["contract_links"].passed
    assert got["documents_ETP"].required == ">=15" and got["documents_EDITAL"].required == "no floor"
    assert G.markdown(rows).startswith("**FAIL**")
    for wrong in ([], ["X"], ["F", "N"]):
        with pytest.raises(ValueError, match="spheres"):
            G.criteria(judged, empty[2], spheres=wrong)
    with pytest.raises(ValueError, match="categories"):
        G.criteria(judged, empty[2], categories=0)
