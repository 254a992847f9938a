"""Rule-based inference over quads.

Rules come from the public W3C RDFS and OWL 2 RL rule tables:

    equivalentProperty, subPropertyOf, inverseOf   x p y  =>  x q y / y q x
    domain, range                                  x p y  =>  x type C / y type C
    equivalentClass, subClassOf                    x type C  =>  x type D
    hasValue                                       x type R <=> x p v
    allValuesFrom                                  x type R, x p y  =>  y type C

The declarations (few) are closed first: which property implies which, in which
direction, and which class implies which; equivalent names are one there.  They are
compiled into a table of one row per property or class with all that follows from it,
and the data (many) is read once and expanded by that table.  Only hasValue and allValuesFrom can feed each
other through the data; they repeat on newly found facts until nothing is new.
When the rules can give declarations themselves (a property below
``subClassOf``), closing and joining repeat until no declaration is new.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.model import OBJECT, TRIPLE_KEY, graph_list
from quadloom.operators.closure import transitive_closure
from quadloom.operators.groups import equivalence_groups
from quadloom.operators.scan import Quads, match
from quadloom.session import materialize, scratch_path

EQUIVALENT_PROPERTY = "EQUIVALENT_PROPERTY"
EQUIVALENT_CLASS = "EQUIVALENT_CLASS"
SUBPROPERTY_OF = "SUBPROPERTY_OF"
SUBCLASS_OF = "SUBCLASS_OF"
DOMAIN = "DOMAIN"
RANGE = "RANGE"
INVERSE_OF = "INVERSE_OF"
HAS_VALUE = "HAS_VALUE"
ALL_VALUES_FROM = "ALL_VALUES_FROM"

_RDFS = (SUBPROPERTY_OF, SUBCLASS_OF, DOMAIN, RANGE)
_PLUS = _RDFS + (EQUIVALENT_PROPERTY, EQUIVALENT_CLASS, INVERSE_OF)
# Named bundles of rules.
RULESETS = {
    **{r: (r,) for r in _PLUS + (HAS_VALUE, ALL_VALUES_FROM)},
    "RDFS": _RDFS,
    "RDFS_FULL": _RDFS,
    "RDFS_PLUS": _PLUS,
    "RDFS_PLUS_FULL": _PLUS + (HAS_VALUE, ALL_VALUES_FROM),
}

FACT = TRIPLE_KEY + ("o_num", "o_ts")

# Predicates are narrowed down by the share of their hash, so that what a filter
# lists is bounded, however many properties are declared.
SHARES = 4096
# What a rule is about, and what it gives (see ``Declarations``).
PROPERTY, CLASS = "p", "c"
FORWARD, BACKWARD = "f", "b"
SUBJECT, OBJECT_POS = "s", "o"


def rules_of(rulesets: Iterable[str | None], defaults: Iterable[str | None] = ()) -> frozenset[str]:
    """The rules of a query: its own rulesets and the defaults; nulls are ignored."""
    names = [r for r in (*rulesets, *defaults) if r is not None]
    unknown = [r for r in names if r not in RULESETS]
    if unknown:
        raise ValueError(f"unknown rulesets: {unknown}")
    return frozenset(rule for r in names for rule in RULESETS[r])


# Rules of at most this many outcomes are sent to all tasks; more are joined, with every
# predicate's facts dealt to SPLIT tasks.
SENT = 100_000
SPLIT = 32
# Rules that give more than this from one fact are applied, and their results merged, in a number
# of tasks that is counted beforehand, so that each has results of about MERGED bytes.
WIDE = 8
MERGED = 64 << 20
# Bytes of a fact in memory, besides those of its strings.
ROW = 128


@dataclass(frozen=True)
class Declarations:
    """Closed and compiled declarations; every table carries the scope columns ``by``.

    A rule has one row per property (kind 'p') or class (kind 'c') with all that follows
    as an array of (out, name): a fact x p y gives x q y ('f') or y q x ('b'), and x ('s')
    or y ('o') a class; a member of a class gets another one ('c').  A name stands for its
    group of equivalent names, which ``members`` expands in the output only.
    """

    by: tuple[str, ...]
    rules: DataFrame  # kind, name, outs
    members: DataFrame | None  # kind, rep, names
    has_value: DataFrame  # r, p, o, o_kind, o_dt, o_lang, o_num, o_ts
    all_values: DataFrame  # r, p, cls
    triples: DataFrame  # declarations implied by the declarations, as facts
    recursive: bool  # can new facts lead to more?
    again: bool  # can rules give declarations, or start from them?
    gives_type: bool  # can a property rule give a class to something?
    hot: bool  # can one fact follow from many others, as the class of an object does?
    wide: bool  # can one fact give many, so that tasks cut by the size of what was read would get too many?
    sent: bool  # are the rules small enough to be sent to all tasks?
    sources: list[int]  # shares of the predicates a rule starts from
    targets: list[int]  # shares of the predicates a rule can give


def _declared(schema: DataFrame, by: tuple[str, ...], predicate: str) -> DataFrame:
    rows = schema.where((F.col("p") == predicate) & (F.col("o_kind") == "iri"))
    return rows.select(*by, F.col("s").alias("a"), F.col("o").alias("b"))


def _kind(kind: str, pairs: DataFrame) -> DataFrame:
    return pairs.select(F.lit(kind).alias("kind"), *pairs.columns)


def _both_ways(pairs: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return pairs.union(pairs.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))


def _iri_fact(by, s: Column | str, p: str | Column, o: Column | str) -> list[Column]:
    none = F.lit(None)
    p = F.lit(p) if isinstance(p, str) else p
    s, o = (F.col(c) if isinstance(c, str) else c for c in (s, o))
    return [
        *[F.col(c) for c in by], s.alias("s"), p.alias("p"), o.alias("o"),
        F.lit("iri").alias("o_kind"), none.cast("string").alias("o_dt"),
        none.cast("string").alias("o_lang"), none.cast("double").alias("o_num"),
        none.cast("timestamp_ntz").alias("o_ts"),
    ]


# The predicates that declare something.
DECLARING = (
    V.SUB_PROPERTY_OF, V.SUB_CLASS_OF, V.DOMAIN, V.RANGE, V.EQUIVALENT_PROPERTY, V.EQUIVALENT_CLASS,
    V.INVERSE_OF, V.ON_PROPERTY, V.HAS_VALUE, V.ALL_VALUES_FROM,
)


def close_declarations(facts: DataFrame, rules: frozenset[str], by: tuple[str, ...] = ()) -> Declarations:
    """Close the declarations found among the facts under the chosen rules."""
    spark = facts.sparkSession
    schema = materialize(
        facts.where(F.col("p").isin(*DECLARING)).select(*by, *FACT).distinct(),
        scratch_path(spark, "declarations"),
    )
    none = schema.limit(0).select(*by, F.col("s").alias("a"), F.col("o").alias("b"))

    def declared(rule: str, predicate: str) -> DataFrame:
        return _declared(schema, by, predicate) if rule in rules else none

    eq = _kind(PROPERTY, declared(EQUIVALENT_PROPERTY, V.EQUIVALENT_PROPERTY)).union(
        _kind(CLASS, declared(EQUIVALENT_CLASS, V.EQUIVALENT_CLASS))
    )
    sub_prop = declared(SUBPROPERTY_OF, V.SUB_PROPERTY_OF)
    inverse = _both_ways(declared(INVERSE_OF, V.INVERSE_OF), by)
    sub_class = declared(SUBCLASS_OF, V.SUB_CLASS_OF)
    typed = reduce(
        DataFrame.union,
        [
            declared(rule, predicate).select(*by, F.col("a").alias("q"), F.lit(end).alias("end"), F.col("b").alias("cls"))
            for rule, predicate, end in ((DOMAIN, V.DOMAIN, SUBJECT), (RANGE, V.RANGE, OBJECT_POS))
        ],
    )

    # one representative stands for a group of equivalent names
    groups = None
    if rules & {EQUIVALENT_PROPERTY, EQUIVALENT_CLASS}:
        groups = equivalence_groups(eq, ("kind", *by))
        groups = None if groups.isEmpty() else groups

    def rep(df: DataFrame, kind: str, *columns: str) -> DataFrame:
        for c in columns if groups is not None else ():
            names = groups.where(F.col("kind") == kind).select(*[F.col(b).alias(f"_{b}") for b in by], F.col("name").alias("_name"), "rep")
            same_scope = reduce(lambda x, y: x & y, [F.col(b) == F.col(f"_{b}") for b in by], F.col(c) == F.col("_name"))
            df = df.join(names, same_scope, "left").withColumn(c, F.coalesce("rep", c)).drop("_name", "rep", *[f"_{b}" for b in by])
        return df

    # a node is a property read forwards or backwards; an inverse turns it round
    def node(direction: str, name: str) -> Column:
        return F.concat(F.lit(direction), F.col(name))

    def edges(kind: str, pairs: DataFrame, x: Column | str = "a", y: Column | str = "b") -> DataFrame:
        x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
        return pairs.select(F.lit(kind).alias("kind"), *by, x.alias("x"), y.alias("y"))

    steps = [edges("class", rep(sub_class, CLASS, "a", "b"))]
    sub_reps, inverse_reps = rep(sub_prop, PROPERTY, "a", "b"), rep(inverse, PROPERTY, "a", "b")
    for d, turned in ((FORWARD, BACKWARD), (BACKWARD, FORWARD)):
        for pairs, to in ((sub_reps, d), (inverse_reps, turned)):
            steps.append(edges("property", pairs, node(d, "a"), node(to, "b")))
    declaring = {V.SUB_PROPERTY_OF: sub_prop, V.SUB_CLASS_OF: sub_class}
    steps += [edges(p, pairs) for p, pairs in declaring.items()]
    # all declarations close in one loop, each kind by itself; domains and ranges alone need none
    linked = reduce(DataFrame.union, steps)
    chained = rules & {SUBPROPERTY_OF, SUBCLASS_OF, INVERSE_OF}
    closed = transitive_closure(linked, ("kind", *by)) if chained else linked.limit(0)
    pairs = closed.where((F.col("kind") == "property") & F.col("x").startswith(FORWARD)).select(
        *by,
        F.expr("substring(x, 2)").alias("p"),
        F.expr("substring(y, 2)").alias("q"),
        F.expr("substring(y, 1, 1)").alias("turn"),
    )
    properties = pairs.where(~((F.col("p") == F.col("q")) & (F.col("turn") == FORWARD)))
    classes = closed.where("kind = 'class' and x <> y").select(*by, F.col("x").alias("c"), F.col("y").alias("d"))

    # domains and ranges of every implied property apply to the property itself
    typed = rep(rep(typed, PROPERTY, "q"), CLASS, "cls")
    own = typed.select(*by, F.col("q").alias("p"), F.col("end").alias("at"), "cls")
    implied = properties.join(typed, [*by, "q"]).select(
        *by,
        "p",
        F.when(F.col("turn") == FORWARD, F.col("end"))
        .otherwise(F.when(F.col("end") == SUBJECT, OBJECT_POS).otherwise(SUBJECT))
        .alias("at"),
        "cls",
    )
    typing = own.union(implied).distinct()
    typing = typing.union(
        typing.join(classes, [F.col("cls") == F.col("c"), *[typing[b] == classes[b] for b in by]]).select(
            *[typing[b] for b in by], "p", "at", F.col("d").alias("cls")
        )
    ).distinct()

    # the rule table: what follows from each representative, on one row per name of its group
    def outcome(kind: str, df: DataFrame, name: str, out: Column, to: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), *by, F.col(name).alias("rep"), out.alias("out"), F.col(to).alias("to"))

    outcomes = [
        outcome(PROPERTY, properties, "p", F.col("turn"), "q"),
        outcome(PROPERTY, typing, "p", F.col("at"), "cls"),
        outcome(CLASS, classes, "c", F.lit(CLASS), "d"),
    ]
    if groups is not None:
        alone = groups.select("kind", *by, "rep").distinct()
        outcomes.append(alone.select("kind", *by, "rep", F.when(F.col("kind") == CLASS, CLASS).otherwise(FORWARD).alias("out"), F.col("rep").alias("to")))
    outs = F.collect_set(F.struct("out", F.col("to").alias("name"))).alias("outs")
    compiled = reduce(DataFrame.union, outcomes).groupBy("kind", *by, "rep").agg(outs)
    members = None
    if groups is not None:
        compiled = compiled.join(groups, ["kind", *by, "rep"], "left").withColumn("rep", F.coalesce("name", "rep")).drop("name")
        collected = groups.groupBy("kind", *by, "rep").agg(F.collect_list("name").alias("names"))
        members = materialize(collected, scratch_path(spark, "members"))
    compiled = materialize(compiled.select("kind", *by, F.col("rep").alias("name"), "outs"), scratch_path(spark, "rules"))

    on = _declared(schema, by, V.ON_PROPERTY).select(*by, F.col("a").alias("r"), F.col("b").alias("p"))
    value_rows = schema.where((F.col("p") == V.HAS_VALUE) & F.lit(HAS_VALUE in rules))
    values = value_rows.select(*by, F.col("s").alias("r"), *OBJECT, "o_num", "o_ts")
    has_value = on.join(values, [*by, "r"])
    only = declared(ALL_VALUES_FROM, V.ALL_VALUES_FROM).select(
        *by, F.col("a").alias("r"), F.col("b").alias("cls")
    )
    all_values = on.join(only, [*by, "r"])

    # the declarations that follow: closed ones, inverses read the other way, and all pairs of a group
    triples = closed.where(F.col("kind").isin(*declaring) & (F.col("x") != F.col("y"))).select(
        *_iri_fact(by, "x", F.col("kind"), "y")
    )
    triples = triples.union(inverse.select(*_iri_fact(by, "a", V.INVERSE_OF, "b")))
    if groups is not None:
        others = members.withColumnRenamed("rep", "_rep")
        paired = groups.join(others, [*(groups[c] == others[c] for c in ("kind", *by)), groups["rep"] == others["_rep"]])
        paired = paired.select(groups["kind"], *[groups[b] for b in by], "name", F.explode("names").alias("other")).where("name <> other")
        kind = F.when(F.col("kind") == CLASS, V.EQUIVALENT_CLASS).otherwise(V.EQUIVALENT_PROPERTY)
        triples = triples.union(paired.select(*_iri_fact(by, "name", kind, "other")))

    property_rules = compiled.where(F.col("kind") == PROPERTY)
    given = property_rules.select("kind", *by, F.inline("outs")).where(F.col("out").isin(FORWARD, BACKWARD))
    given = _expanded(given.withColumn("out", F.lit(FORWARD)), members, by, sent=False)
    roles = [
        property_rules.select(F.lit("source").alias("role"), F.col("name").alias("p"), F.size("outs").alias("n")),
        property_rules.where(F.exists("outs", lambda x: x["out"].isin(SUBJECT, OBJECT_POS))).select(F.lit("typing"), F.col("name"), F.lit(0)),
        compiled.where(F.col("kind") == CLASS).select(F.lit("class"), F.lit(V.RDF_TYPE), F.size("outs")),
        given.select(F.lit("target"), F.col("name"), F.lit(0)),
        has_value.select(F.lit("loop"), F.col("p"), F.lit(1)),
        all_values.select(F.lit("loop"), F.col("p"), F.lit(1)),
    ]
    if members is not None:
        roles.append(members.select(F.lit("group"), F.col("rep"), F.size("names")))
    named = reduce(DataFrame.union, roles).where("p is not null")
    is_declaring = F.col("p").isin(*DECLARING)
    hot = F.col("role").isin("typing", "loop")
    loop = (F.col("role") == "loop") | ((F.col("role") == "source") & (F.col("p") == V.RDF_TYPE))
    # one row of bounded size
    row = named.agg(
        F.collect_set(F.when(F.col("role").isin("source", "class", "loop"), share("p"))).alias("sources"),
        F.collect_set(F.when(F.col("role").isin("target", "loop"), share("p"))).alias("targets"),
        F.coalesce(F.bool_or(loop), F.lit(False)).alias("recursive"),
        F.coalesce(F.bool_or(F.col("role") == "loop"), F.lit(False)).alias("restrictions"),
        F.coalesce(F.bool_or(is_declaring), F.lit(False)).alias("again"),
        F.coalesce(F.bool_or((F.col("role") == "target") & (F.col("p") == V.RDF_TYPE)), F.lit(False)).alias("gives_type"),
        F.coalesce(F.bool_or(hot), F.lit(False)).alias("hot"),
        F.coalesce(F.sum(F.when(F.col("role") != "group", F.col("n"))), F.lit(0)).alias("n"),
        F.coalesce(F.max(F.when(F.col("role") != "group", F.col("n"))), F.lit(0)).alias("most"),
        F.coalesce(F.max(F.when(F.col("role") == "group", F.col("n"))), F.lit(1)).alias("names"),
        *[F.array_sort(F.array(*[share(F.lit(p)) for p in fixed])).alias(name)
          for name, fixed in (("type_", [V.RDF_TYPE]), ("fixed", [V.RDF_TYPE, *DECLARING]))],
    ).first()
    sources = sorted({*row["sources"], *(row["type_"] if row["restrictions"] else ())})
    targets = sorted({*row["targets"], *row["fixed"]})
    return Declarations(
        by, compiled, members, has_value, all_values, triples,
        row["recursive"], row["again"], row["gives_type"], row["hot"], row["most"] * row["names"] > WIDE, row["n"] <= SENT, sources, targets,
    )


def share(p: Column | str) -> Column:
    """The share a predicate falls into; for a constant predicate it is a constant, too."""
    return F.pmod(F.xxhash64(p), F.lit(SHARES)).cast("int")


def _expanded(rows: DataFrame, members: DataFrame | None, by: tuple[str, ...], sent: bool) -> DataFrame:
    """``name`` replaced by each name of its group; (out) says whether it is a property or a class."""
    if members is None:
        return rows
    names = members.select(F.col("kind").alias("m_kind"), *[F.col(b).alias(f"m_{b}") for b in by], F.col("rep").alias("m_rep"), "names")
    names = F.broadcast(names) if sent else names
    kind = F.when(F.col("out").isin(FORWARD, BACKWARD), PROPERTY).otherwise(CLASS)
    on = reduce(lambda x, y: x & y, [F.col(b) == F.col(f"m_{b}") for b in by], (F.col("name") == F.col("m_rep")) & (kind == F.col("m_kind")))
    out = rows.join(names, on, "left").drop("m_kind", "m_rep", *[f"m_{b}" for b in by])
    return out.withColumn("name", F.explode(F.coalesce("names", F.array("name")))).drop("names")


def _fired(facts: DataFrame, d: Declarations, kinds: str = PROPERTY + CLASS) -> DataFrame:
    """What the rule table gives for ``facts``, in one pass over them: facts with the column ``out``.

    Rules that are small are sent to all tasks, so the facts stay where they are.  Otherwise
    both are dealt by predicate (or class) and a share of the facts, the rules once for each.
    """
    by, is_type = list(d.by), (F.col("p") == V.RDF_TYPE) & (F.col("o_kind") == "iri")
    rows, found = facts.select(*by, *FACT), []
    if not d.sent:
        rows = rows.withColumn("f_share", F.pmod(F.xxhash64("s", "o"), F.lit(SPLIT)))
    for kind in kinds:
        rules = d.rules.where(F.col("kind") == kind).select(
            *[F.col(b).alias(f"{kind}_{b}") for b in by], F.col("name").alias(f"{kind}_name"), F.col("outs").alias(f"{kind}_outs")
        )
        on = F.col("p" if kind == PROPERTY else "o") == F.col(f"{kind}_name")
        on = reduce(lambda x, y: x & y, [F.col(b) == F.col(f"{kind}_{b}") for b in by], on)
        if kind == CLASS:
            on = on & is_type
        if d.sent:
            rules = F.broadcast(rules)
        else:
            rules = rules.withColumn(f"{kind}_share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPLIT - 1).cast("long"))))
            on = on & (F.col("f_share") == F.col(f"{kind}_share"))
        rows = rows.join(rules, on, "left")
        found.append(F.coalesce(f"{kind}_outs", F.array().cast("array<struct<out: string, name: string>>")))
    all_outs = F.concat(*found) if len(found) > 1 else found[0]
    rows = rows.select(*by, *FACT, all_outs.alias("outs")).where(F.size("outs") > 0).select(*by, *FACT, F.inline("outs"))
    rows = rows.where(F.col("out").isin(FORWARD, SUBJECT, CLASS) | (F.col("o_kind") == "iri"))
    rows = _expanded(rows, d.members, d.by, d.sent)
    out, forward = F.col("out"), F.col("out") == FORWARD
    subject = F.when(out.isin(BACKWARD, OBJECT_POS), F.col("o")).otherwise(F.col("s"))
    predicate = F.when(out.isin(FORWARD, BACKWARD), F.col("name")).otherwise(V.RDF_TYPE)
    obj = F.when(forward, F.col("o")).when(out == BACKWARD, F.col("s")).otherwise(F.col("name"))
    return rows.select(
        *by, subject.alias("s"), predicate.alias("p"), obj.alias("o"),
        F.when(forward, F.col("o_kind")).otherwise("iri").alias("o_kind"),
        *[F.when(forward, F.col(c)).alias(c) for c in ("o_dt", "o_lang", "o_num", "o_ts")],
        "out",
    )


def _implied(facts: DataFrame, known: DataFrame, d: Declarations) -> DataFrame:
    """Facts that follow from ``facts`` (new) together with ``known`` (all)."""
    by, cols = list(d.by), [*d.by, *FACT]
    is_type = (F.col("p") == V.RDF_TYPE) & (F.col("o_kind") == "iri")

    def on(*pairs: tuple[str, str]) -> Column:
        conds = [F.col(b) == F.col(f"decl_{b}") for b in by] + [F.col(x) == F.col(y) for x, y in pairs]
        return reduce(lambda x, y: x & y, conds)

    def decl(df: DataFrame, **names: str) -> DataFrame:
        rows = df.select(*[F.col(b).alias(f"decl_{b}") for b in by], *[F.col(a).alias(b) for a, b in names.items()])
        return F.broadcast(rows) if d.sent else rows

    fired = _fired(facts, d)
    out = [fired]
    moved = fired.where(F.col("out").isin(FORWARD, BACKWARD))
    edges = facts.select(*cols).union(moved.select(*cols))
    # classes that the class rules haven't seen yet
    later = [moved.where(is_type).select(*cols)] if d.gives_type else []
    if d.recursive:
        hv = decl(d.has_value, r="r", p="dp", **{c: f"v_{c}" for c in (*OBJECT, "o_num", "o_ts")})
        same_value = (
            (F.col("o") == F.col("v_o"))
            & (F.col("o_kind") == F.col("v_o_kind"))
            & F.col("o_dt").eqNullSafe(F.col("v_o_dt"))
            & F.col("o_lang").eqNullSafe(F.col("v_o_lang"))
        )
        found = edges.join(hv, on(("p", "dp")) & same_value).select(*_iri_fact(by, "s", V.RDF_TYPE, "r"))
        later.append(found.select(*cols))
        out.append(found)
    if later:
        supers = _fired(reduce(DataFrame.union, later), d, CLASS)
        out.append(supers)
    if d.recursive:
        classed = fired.where(F.col("out").isin(SUBJECT, OBJECT_POS, CLASS))
        all_types = reduce(
            DataFrame.union, [x.select(*cols) for x in (edges.where(is_type), classed, found, supers)]
        )
        filled = all_types.join(hv, on(("o", "r"))).select(
            *[F.col(b) for b in by], F.col("s"), F.col("dp").alias("p"),
            *[F.col(f"v_{c}").alias(c) for c in (*OBJECT, "o_num", "o_ts")],
        )
        av = decl(d.all_values, r="r", p="dp", cls="cls")
        restricted = all_types.join(av, on(("o", "r"))).select(*by, F.col("s").alias("x"), F.col("dp"), "cls")
        known_restricted = (
            known.where(is_type).join(av, on(("o", "r"))).select(*by, F.col("s").alias("x"), F.col("dp"), "cls")
        )
        out.append(filled)
        for some_types, some_edges in ((restricted, known.select(*cols).union(edges)), (known_restricted, edges)):
            step = some_edges.where(F.col("o_kind") == "iri").join(
                some_types.withColumnsRenamed({b: f"decl_{b}" for b in by}), on(("s", "x"), ("p", "dp"))
            )
            out.append(step.select(*_iri_fact(by, "o", V.RDF_TYPE, "cls")))
    return reduce(DataFrame.union, [x.select(*cols) for x in out])


def _new_facts(facts: DataFrame, known: DataFrame, held: DataFrame, d: Declarations, more: DataFrame | None = None) -> DataFrame:
    """What follows from ``facts`` together with ``known``, and ``more``, each once and without what is ``held``.

    The results are dealt out by their hash before repeats are merged: a task that reads and expands
    merges none of them, however many follow from its part of a file.  Where one fact can follow from
    many others, it is dealt to one task for each task that finds it first.  Where one fact gives
    many, which compress well, the number of tasks follows from the bytes of all results and is not
    cut down to their compressed size.  The facts are dealt to as many tasks, and their copies merged,
    before they are expanded: a task that writes to many partitions holds what it writes.
    """
    key, number = [*d.by, *TRIPLE_KEY], []

    def results(facts: DataFrame) -> DataFrame:
        derived = _implied(facts, known, d)
        derived = derived if more is None else derived.union(more)
        return derived.withColumn("old", F.lit(0)).union(held.withColumn("old", F.lit(1)))

    def dealt(number: int) -> DataFrame:
        rows = facts.repartition(number, *key).groupBy(*key).agg(*[F.max(c).alias(c) for c in ("o_num", "o_ts")])
        return rows.select(*d.by, *FACT)

    def merged(rows: DataFrame, *also: str) -> DataFrame:
        return rows.groupBy("hash__", *also, *key).agg(*[F.max(c).alias(c) for c in ("old", "o_num", "o_ts")])

    if d.wide:
        least = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        lengths = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in key]
        size = results(dealt(least)).agg(F.sum(reduce(lambda x, y: x + y, lengths) + ROW)).first()[0] or 0
        number = [max(least, -(-size // MERGED))]
        facts = dealt(*number)
    rows = results(facts).withColumn("hash__", F.xxhash64(*key))
    if d.hot:
        rows = rows.withColumn("task__", F.spark_partition_id()).repartition(*number, "hash__", "task__")
        rows = merged(rows, "task__")
    rows = rows.repartition(*number, "hash__")
    return merged(rows).where("old = 0").select(*d.by, *FACT)


def infer(
    q: Quads,
    rulesets: Iterable[str | None],
    defaults: Iterable[str | None] = (),
    contexts: Iterable = (),
    per_graph: bool = False,
) -> DataFrame:
    """The facts that follow from the rules and are not stated: s, p, o ... (and g).

    With ``contexts`` only these graphs are used.  The facts of several graphs are
    merged first; ``per_graph`` keeps every graph to itself instead and returns
    the graph as well.
    """
    rules = rules_of(rulesets, defaults)
    by = ("g",) if per_graph else ()
    df = match(q, graphs=graph_list(contexts) or None)[0]
    known = df.select(*by, *FACT)
    if not rules:
        return known.limit(0)
    d = close_declarations(known, rules, by)
    if not d.again:
        return infer_with(known, d)
    spark = known.sparkSession
    root = scratch_path(spark, "declared")
    found: list[str] = []
    while True:
        # what was found before counts as known, so that rounds have no facts in common
        state = known if not found else known.union(spark.read.schema(new.schema).parquet(*found))
        if found:
            d = close_declarations(state, rules, by)
        path = f"{root}/round-{len(found)}"
        new = materialize(infer_with(state, d), path)
        found.append(path)
        if new.where(F.col("p").isin(*DECLARING)).isEmpty():
            return spark.read.schema(new.schema).parquet(*found)


def infer_with(known: DataFrame, d: Declarations) -> DataFrame:
    """Apply closed declarations to facts."""
    spark, by = known.sparkSession, d.by
    triples = d.triples.select(*by, *FACT)
    # only these predicates are read and compared, not the whole data
    fire = _with_predicates(known, d.sources)
    held = _with_predicates(known, d.targets)
    if not d.recursive:
        return _new_facts(fire, fire, held, d, triples)
    root = scratch_path(spark, "infer")
    found = [f"{root}/round-0"]
    delta = materialize(_new_facts(fire, fire, held, d, triples), found[0])
    while not delta.isEmpty():
        inferred = spark.read.schema(delta.schema).parquet(*found)
        path = f"{root}/round-{len(found)}"
        delta = materialize(_new_facts(_with_predicates(delta, d.sources), fire.union(inferred), held.union(inferred), d), path)
        found.append(path)
    return spark.read.schema(delta.schema).parquet(*found)


def _with_predicates(facts: DataFrame, shares: list[int]) -> DataFrame:
    """Facts whose predicate falls into one of the shares: all that matter, few others."""
    return facts.where(share("p").isin(shares))


def with_inferred(
    q: Quads,
    rulesets: Iterable[str | None] = (),
    defaults: Iterable[str | None] = (),
    include_inferred: bool = True,
    contexts: Iterable = (),
) -> DataFrame:
    """The quads a query with rulesets sees: stated ones plus inferred ones.

    Inference stays inside each graph.  ``include_inferred=False`` ignores all rulesets.
    """
    df = match(q, graphs=graph_list(contexts) or None)[0]
    if not include_inferred or not rules_of(rulesets, defaults):
        return df
    new = infer(q, rulesets, defaults, contexts, per_graph=True)
    return df.unionByName(new.withColumn("doc_id", F.lit(None).cast("string")))
