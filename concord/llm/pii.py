"""Personal data by weak supervision, in DataFrame operations only.

Candidates are the matches of patterns for four kinds: the base patterns, and
looser ones (national phone numbers, spelled-out addresses, and base matches that
failed their check). Labelers vote on each candidate: the pattern's own check, a
gazetteer (top-level domains, issuer prefixes, address ranges), the words before
it, what touches it, and its shape. Expectation-maximisation over the counts of
vote patterns, which cover all candidates of the corpus, estimates how reliable
each labeler is for each kind; its posteriors train a logistic span classifier on
votes and length. Base spans always stay; others are added when the classifier
accepts them and no base span overlaps them.

Only counts of vote patterns reach the driver: at most some thousand rows,
whatever the input. Match positions come from split() and regexp_extract_all() of
one pattern, whose repeated groups are possessive, so that long runs neither
overflow the stack nor take quadratic time. Running totals go by blocks
(``running``), and spans carry byte positions beside code points, so that the work
on a text grows with its length and matches, not with their product or square.

Defined results: null texts are empty; repeated rows come out as often as they
went in; with no candidates nothing is added; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.spans import matches, running
from concord.functions.text import bound_once
from concord.llm.common import kept, unused
from concord.session import written

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns (fixed values), with possessive repeats where nothing could be given back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns of the method.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}(?: at | \(at\) | \[at\] |\(at\)|\[at\])[A-Za-z0-9-]{2,63}(?: dot | \(dot\) | \[dot\] |\(dot\)|\[dot\])[A-Za-z]{2,10}(?![A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.)-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
}
#: Substrings without which a pattern cannot match, to skip its scan.
NEEDS = {"email": "@", "phone": "+"}
#: Gazetteers (fixed values): top-level domains, issuer prefixes, first octets of public addresses.
TOP_LEVEL = "com|org|net|edu|gov|mil|int|info|biz|io|dev|app|de|fr|es|it|uk|us|eu|nl|ch|at|be|pt|br|mx|ca|au|jp|cn|in"
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
CONTEXT = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|address|correo|courriel)\W*(?:\w+\W+)?$",
    "ip": r"(?i)(?:\bip|host|server|address|addr|client|from)\W*(?:\w+\W+)?$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|pan)\W*(?:\w+\W+)?$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|whatsapp|telefon|t[eé]l[eé]phone|tel[eé]fono)\W*(?:\w+\W+)?$",
}
LABELERS = ["check", "gazetteer", "context", "boundary", "shape"]
ABSTAIN, YES, NO = 0, 1, 2
EM_ROUNDS, FIT_ROUNDS = 50, 400
ACCEPT = 0.5


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))
    if kind == "card":
        n = F.length(_digits(match))
        return F.when(n.between(13, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, YES)
    return (vote if no is None else vote.when(no, NO)).otherwise(ABSTAIN)


def _candidate(kind: str, m: Column, base: Column) -> Column:
    """A candidate with its votes (a number a labeler) and length class."""
    text, before, after = m["match"], m["before"], m["after"]
    if kind == "email":
        gazetteer = _vote(text.rlike(rf"(?i)(?:\.|dot[ )\]]*)(?:{TOP_LEVEL})$"), F.lit(True))
        shape = _vote(text.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*[ @(\[]"), F.lit(True))
    elif kind == "ip":
        gazetteer = _vote(text.rlike(r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\."), F.lit(True))
        shape = _vote(text.rlike(r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$"), F.lit(True))
    elif kind == "card":
        gazetteer = _vote(text.rlike(ISSUER), F.lit(True))
        shape = _vote(text.rlike(r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"), F.lit(True))
    else:
        gazetteer = _vote(text.rlike(r"^\+[1-9]") | text.rlike(r"^\(?[2-9]"), F.lit(True))
        shape = _vote(_digits(text).rlike(r"^[0-9]{10,13}$"), F.lit(True))
    touched = before.rlike(r"[A-Za-z0-9_=/.#-]$") | after.rlike(r"^(?:[A-Za-z0-9_=/#]|[.-][0-9])")
    inner = F.regexp_replace(text, "[A-Za-z0-9+@]", "")
    return F.struct(
        F.lit(kind).alias("kind"),
        m["s"].alias("s"),
        m["e"].alias("e"),
        m["bs"].alias("bs"),
        m["be"].alias("be"),
        base.alias("base"),
        F.array(_vote(base, F.lit(True)), gazetteer, _vote(before.rlike(CONTEXT[kind])), _vote(~touched, touched), shape).alias("votes"),
        F.least(F.lit(3), F.floor((m["e"] - m["s"]) / 8).cast("int")).alias("size"),
        # what joins the match's parts, and what stands before it
        F.when(inner == "", "none").when(inner.rlike("^ +$"), "blanks").when(inner.rlike(r"^[.-]+$"), "points").otherwise("mixed").alias("style"),
        F.when(before == "", "start").when(before.rlike(r"[:=]\s*$"), "colon").when(before.rlike(r"\n\s*$"), "line").when(before.rlike(r"[A-Za-z]\s+$"), "word").otherwise("other").alias("lead"),
    )


def _voted(kind: str, found: Column, loose: bool) -> Column:
    return F.transform(found, lambda m: _candidate(kind, m, F.lit(False) if loose else _valid(kind, m["match"])))


def candidates(documents: DataFrame, text: str = "text", found: str = "_found") -> DataFrame:
    """``documents`` with ``found``: all candidates of a text, base spans included."""
    body = F.coalesce(F.col(text), F.lit(""))
    lists = []
    for kind in KINDS:
        # of the runs of digits, most are no card by their length alone
        long_enough = (lambda m: F.length(F.translate(m, " -", "")).between(13, 19)) if kind == "card" else None
        lists.append(_voted(kind, matches(body, BASE[kind], NEEDS.get(kind), long_enough), loose=False))
        if kind in LOOSE:
            lists.append(_voted(kind, matches(body, LOOSE[kind]), loose=True))
    return documents.withColumn(found, F.concat(*lists))


# --- estimation: plain arithmetic over the counted patterns ---

#: kind, votes, features (size, style, lead) and the number of candidates that have them.
Pattern = tuple[str, tuple[int, ...], tuple[object, ...], float]


def estimate(counts: list[Pattern], rounds: int = EM_ROUNDS) -> dict[tuple[str, tuple[int, ...]], float]:
    """Posterior of being personal data by kind and votes, by EM with a reliability for each labeler and kind."""
    out: dict[tuple[str, tuple[int, ...]], float] = {}
    for kind in sorted({k for k, _, _, _ in counts}):
        weight: dict[tuple[int, ...], float] = {}
        for k, votes, _, n in counts:
            if k == kind:
                weight[votes] = weight.get(votes, 0.0) + n
        # at the start, two more votes for than against are likely personal data
        post = {v: 1 / (1 + math.exp(-1.5 * (sum(x == YES for x in v) - sum(x == NO for x in v) - 1))) for v in weight}
        for _ in range(rounds):
            total = sum(weight.values())
            yes = sum(weight[v] * post[v] for v in weight)
            prior = (yes + 1) / (total + 2)
            rate = {}
            for labeler in range(len(LABELERS)):
                for vote in (ABSTAIN, YES, NO):
                    a = sum(weight[v] * post[v] for v in weight if v[labeler] == vote)
                    b = sum(weight[v] * (1 - post[v]) for v in weight if v[labeler] == vote)
                    # pseudo-counts: a labeler is taken to be right more often than not
                    p, q = {ABSTAIN: (2.0, 2.0), YES: (6.0, 2.0), NO: (2.0, 6.0)}[vote]
                    rate[labeler, vote] = ((a + p) / (yes + 10), (b + q) / (total - yes + 10))
            for v in weight:
                odds = math.log(prior / (1 - prior)) + sum(math.log(rate[k, x][0] / rate[k, x][1]) for k, x in enumerate(v))
                post[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        out.update({(kind, v): p for v, p in post.items()})
    return out


FEATURES = {"size": [0, 1, 2, 3], "style": ["none", "blanks", "points", "mixed"], "lead": ["start", "colon", "line", "word", "other"]}


def _features(kind: str, votes: tuple[int, ...], features: tuple[object, ...]) -> list[str]:
    own = [f"{kind}:{name}={v}" for name, v in zip(FEATURES, features, strict=True)]
    return [f"kind={kind}", *own, *(f"{name}={v}" for name, v in zip(LABELERS, votes, strict=True) if v != ABSTAIN)]


def train(counts: list[Pattern], rounds: int = FIT_ROUNDS, rate: float = 0.5, decay: float = 1e-3) -> dict[str, float]:
    """Weights of a logistic classifier fitted to the posteriors, each kind weighing as much as another."""
    posterior = estimate(counts)
    kinds: dict[str, float] = {}
    for k, _, _, n in counts:
        kinds[k] = kinds.get(k, 0.0) + n
    weights: dict[str, float] = {}
    for _ in range(rounds):
        slope: dict[str, float] = {}
        for kind, votes, features, n in counts:
            names = _features(kind, votes, features)
            z = sum(weights.get(f, 0.0) for f in names)
            error = posterior[kind, votes] - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            for f in names:
                slope[f] = slope.get(f, 0.0) + error * n / kinds[kind]
        for f, g in slope.items():
            weights[f] = weights.get(f, 0.0) * (1 - decay) + rate * g
    return weights


def _probability(weights: dict[str, float], c: Column) -> Column:
    """The classifier as a column expression over a candidate."""
    z = F.lit(0.0)
    for kind in KINDS:
        own = F.lit(weights.get(f"kind={kind}", 0.0))
        for name, values in FEATURES.items():
            part = F.lit(0.0)
            for v in values:
                part = F.when(c[name] == v, F.lit(weights.get(f"{kind}:{name}={v}", 0.0))).otherwise(part)
            own += part
        z += F.when(c["kind"] == kind, own).otherwise(0.0)
    for k, name in enumerate(LABELERS):
        vote = F.get(c["votes"], F.lit(k))
        z += F.when(vote == YES, F.lit(weights.get(f"{name}={YES}", 0.0))).when(vote == NO, F.lit(weights.get(f"{name}={NO}", 0.0))).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def counted_patterns(found: DataFrame, column: str = "_found") -> list[Pattern]:
    rows = found.select(F.explode(column).alias("c")).groupBy("c.kind", "c.votes", *(f"c.{f}" for f in FEATURES)).agg(F.count("*").alias("n")).collect()
    return sorted((r["kind"], tuple(r["votes"]), tuple(r[f] for f in FEATURES), float(r["n"])) for r in rows)


_SPAN = "struct<order:int,s:int,e:int,bs:int,be:int,kind:string>"


def _without_overlap(base: Column, added: Column) -> Column:
    """The spans of ``added`` that overlap none of ``base``; both sorted once, each span looks at its neighbours only."""
    end = 2**31 - 1
    tag = lambda spans, own: F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(own).alias("added"), x["e"].alias("e"), x.alias("x")))
    both = F.array_sort(F.concat(tag(base, False), tag(added, True)))

    def free(rows: Column) -> Column:
        reach = running(F.transform(rows, lambda x: F.when(x["added"], -1).otherwise(x["e"])), "int", F.lit(-1), F.greatest)
        ahead = running(F.transform(F.reverse(rows), lambda x: F.when(x["added"], end).otherwise(x["s"])), "int", F.lit(end), F.least)
        apart = bound_once(
            F.struct(reach.alias("reach"), ahead.alias("ahead")),
            lambda near: F.transform(rows, lambda x, i: F.when(x["added"] & (F.get(near["reach"], i) <= x["s"]) & (F.get(near["ahead"], F.size(rows) - 1 - i) >= x["e"]), x["x"])),
        )
        return F.filter(apart, lambda x: x.isNotNull())

    return F.when((F.size(base) == 0) | (F.size(added) == 0), added).otherwise(bound_once(both, free))


def find_personal_data(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default), base and spans: arrays of (order, s, e, bs, be, kind), sorted.

    Columns of ``documents`` with the names base and spans are replaced.
    """
    keep, hold = kept(documents, keep, ("base", "spans")), unused(documents, "_found")
    found = written(candidates(documents.select(*dict.fromkeys([*keep, text])), text, hold).select(*keep, hold), "pii")
    weights = train(counted_patterns(found, hold))

    def listed(c: Column) -> Column:
        order = F.lit(len(KINDS))
        for k, kind in enumerate(KINDS):
            order = F.when(c["kind"] == kind, F.lit(k)).otherwise(order)
        return F.struct(order.alias("order"), *(c[x].alias(x) for x in ("s", "e", "bs", "be", "kind"))).cast(_SPAN)

    def spans(every: Column) -> Column:
        base = F.array_sort(F.transform(F.filter(every, lambda c: c["base"]), listed))
        added = F.transform(F.filter(every, lambda c: ~c["base"] & (_probability(weights, c) >= ACCEPT)), listed)
        more = bound_once(F.struct(base.alias("base"), added.alias("added")), lambda x: F.struct(x["base"].alias("base"), F.array_sort(F.concat(x["base"], _without_overlap(x["base"], x["added"]))).alias("spans")))
        none = F.array().cast(f"array<{_SPAN}>")
        return F.when(F.size(every) > 0, more).otherwise(F.struct(none.alias("base"), none.alias("spans")))

    return found.select(*keep, spans(F.col(hold)).alias(hold)).select(*keep, f"{hold}.base", f"{hold}.spans")


def _digest(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def personal_data(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    found = find_personal_data(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), keep=["doc_id"])
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_digest("base"), 256).alias("base_sha256"), _digest("spans").alias("spans"))


def redact(documents: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``documents`` with every span replaced by its kind in brackets, and the character count adjusted.

    Spans that overlap are replaced as one, by the kind of the first.
    """
    plain = [f"_c{i}" for i in range(len(documents.columns))]
    body = plain[documents.columns.index(text)]
    found = find_personal_data(documents.toDF(*plain), body)
    by_place = F.array_sort(F.transform("spans", lambda x: F.struct(x["bs"].alias("s"), x["be"].alias("e"), x["kind"].alias("kind"))))

    def rebuilt(x: Column) -> Column:
        raw, spans, reach = x["raw"], x["spans"], x["reach"]
        piece = lambda a, b: F.substring(raw, a + 1, b - a).cast("string")

        def part(span: Column, i: Column) -> Column:
            at = F.get(reach, i)
            return F.when(span["s"] >= at, F.concat(piece(at, span["s"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise("")

        return F.concat(F.array_join(F.transform(spans, part), ""), piece(F.get(reach, F.size(spans)), F.octet_length(raw)))

    def with_reach(spans: Column) -> Column:
        return F.struct(F.col(body).cast("binary").alias("raw"), spans.alias("spans"), running(F.transform(spans, lambda x: x["e"]), "int", F.lit(0), F.greatest).alias("reach"))

    new = F.when(F.size("spans") > 0, bound_once(bound_once(by_place, with_reach), rebuilt)).otherwise(F.col(body))
    changed = found.withColumn("_new", new)
    out = [F.col("_new").alias(body) if c == body else F.col(c) for c in plain]
    if n_chars in documents.columns:
        at = documents.columns.index(n_chars)
        out[at] = F.when(F.size("spans") > 0, F.length("_new").cast(documents.schema[n_chars].dataType)).otherwise(F.col(plain[at])).alias(plain[at])
    return changed.select(*out).toDF(*documents.columns)
