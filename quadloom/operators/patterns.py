"""Triple patterns, basic graph patterns, datasets and inline data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.quad_columns import constant_object
from quadloom.functions.terms import exact_less, exact_parts, numeric_value, time_value
from quadloom.model import Term, as_term, graph_list, lit, with_base
from quadloom.operators import paths
from quadloom.operators.scan import Quads, match
from quadloom.operators.solutions import IDENTITY, VALUES, Solutions, aux
from quadloom.sources.tables import TableQuads, narrow_together



def is_var(x) -> bool:
    return isinstance(x, str) and x.startswith("?")


def pattern(
    q: Quads,
    s,
    p,
    o,
    graph=None,
    from_: Iterable | None = None,
    from_named: Iterable | None = None,
    merge: bool = True,
    base: str | None = None,
    seeds: DataFrame | None = None,
    ends: DataFrame | None = None,
) -> Solutions:
    """Solutions of one triple pattern.

    ``"?x"`` is a variable, a Term or other string is a constant, and ``p`` may be
    a property path.  ``graph`` scopes the pattern: an IRI is GRAPH <iri>, a
    variable is GRAPH ?g (limited by ``from_named``), and None is the default
    dataset: the set union of ``from_``, or of all graphs when that is None.

    The union over several graphs removes triples present in more than one of
    them.  ``merge=False`` skips that; it is right when the caller knows that
    no triple repeats, or drops duplicate solutions later anyway.

    Relative IRIs are resolved against ``base``; an IRI that was resolved against
    another base before stays as it is.  ``seeds`` and ``ends`` (a column ``x`` of term
    keys) limit where a repeated path starts from and where it ends.
    """
    if p == "a":
        p = V.RDF_TYPE
    s, p, o, graph = _based((s, p, o, graph), base)
    from_, from_named = (None if c is None else _based(_listed(c), base) for c in (from_, from_named))
    graphs = _dataset(graph, from_, from_named)
    if isinstance(p, paths.Path):
        if is_var(graph):
            raise ValueError("a property path needs a fixed graph or the default dataset")
        return _path_solutions(q, s, p, o, graphs, merge, seeds, ends)

    const = {k: (None if is_var(t) else as_term(t)) for k, t in (("s", s), ("p", p), ("o", o))}
    df, one_graph = match(q, const["s"], const["p"], const["o"], graphs)

    slots = [("s", s), ("p", p), ("o", o)]
    if is_var(graph):
        slots.append(("g", graph))
    columns: dict[str, Column] = {}
    terms: set[str] = set()
    first: dict[str, str] = {}
    for slot, t in slots:
        if not is_var(t):
            continue
        name = t[1:]
        if name in first:
            # a repeated variable is an equality; the object must then be an IRI
            df = df.where(F.col(first[name]) == F.col(slot))
            if "o" in (slot, first[name]):
                df = df.where(F.col("o_kind") == "iri")
                terms.discard(name)
            continue
        first[name] = slot
        columns[name] = F.col(slot)
        if slot == "o":
            terms.add(name)
    out = []
    for name, col in columns.items():
        out.append(col.alias(name))
        if name in terms:
            out += [F.col("o_" + part).alias(aux(name, part)) for part in IDENTITY + VALUES]
    sol = Solutions(df.select(*out), tuple(columns), frozenset(terms))
    if merge and not one_graph and not is_var(graph) and columns:
        sol = sol.distinct()
    return sol


def _listed(contexts) -> list:
    return [contexts] if isinstance(contexts, (str, Term)) else list(contexts)


def _based(terms: Iterable, base: str | None) -> list:
    """Terms of a pattern or template with relative IRIs resolved, those within paths as well."""
    return [paths.based(t, base) if isinstance(t, paths.Path) else with_base(t, base) for t in terms]


def _path_solutions(
    q: Quads, s, path, o, graphs, merge: bool, seeds: DataFrame | None = None, ends: DataFrame | None = None
) -> Solutions:
    start = None if is_var(s) else as_term(s)
    end = None if is_var(o) else as_term(o)
    pairs = paths.evaluate(q, path, graphs, start, end, merge, seeds, ends)
    if is_var(s) and s == o:
        same = F.lit(True)
        for part in ("", "_kind"):
            same = same & (F.col("x" + part) == F.col("y" + part))
        for part in ("_dt", "_lang"):
            same = same & F.col("x" + part).eqNullSafe(F.col("y" + part))
        pairs = pairs.where(same)
    out, names = [], []
    for slot, t in (("x", s), ("y", o)):
        if is_var(t) and t[1:] not in names:
            name = t[1:]
            names.append(name)
            out.append(F.col(slot).alias(name))
            out += [F.col(f"{slot}_{part}").alias(aux(name, part)) for part in IDENTITY + VALUES]
    return Solutions(pairs.select(*out), tuple(names), frozenset(names))


def bgp(
    q: Quads,
    patterns: Iterable[tuple],
    graph=None,
    from_: Iterable | None = None,
    from_named: Iterable | None = None,
    bindings: Mapping[str, Term | str] | None = None,
    merge: bool = True,
    base: str | None = None,
) -> Solutions:
    """A basic graph pattern: triple patterns joined on their shared variables.

    Patterns with the most constants come first and each next one shares a
    variable with those before it, so unrelated patterns are never multiplied
    while a connected one is left.  Which join algorithm runs is Catalyst's choice.

    ``bindings`` fixes variables before matching; a name no pattern uses has no
    effect.  A bound variable still appears in the result.  Relative IRIs are
    resolved against ``base``.

    A path that repeats (``+``, ``*``) is walked from the subjects that the patterns
    before it have found, if they bind its start, against its direction from what they
    have found for its end, or from both sides.
    """
    bound = {k.lstrip("?"): as_term(with_base(as_term(v), base)) for k, v in (bindings or {}).items()}
    patterns = [_based([V.RDF_TYPE if t == "a" and i == 1 else t for i, t in enumerate(pt)], base) for pt in patterns]
    graph, = _based([graph], base)
    from_, from_named = (None if c is None else _based(_listed(c), base) for c in (from_, from_named))

    def fix(t):
        return bound.get(t[1:], t) if is_var(t) else t

    patterns = [tuple(pt) for pt in patterns]
    used = {t[1:] for pt in patterns for t in pt if is_var(t)}
    if is_var(graph):
        used.add(graph[1:])
    todo = [tuple(fix(t) for t in pt) for pt in patterns]
    graph = fix(graph)

    def variables(pt):
        names = {t[1:] for t in pt if is_var(t)}
        return names | {graph[1:]} if is_var(graph) else names

    ground = [pt for pt in todo if not variables(pt)]
    todo = [pt for pt in todo if variables(pt)]
    graphs = _dataset(graph, from_, from_named)
    views = dict.fromkeys(todo, q)
    if isinstance(q, TableQuads):
        views = _narrowed(q, todo, graphs)

    def solve(pt, seeds: DataFrame | None = None, ends: DataFrame | None = None) -> Solutions:
        return pattern(
            views.get(pt, q), *pt, graph=graph, from_=from_, from_named=from_named, merge=merge, seeds=seeds, ends=ends
        )

    def keys_of(found: Solutions | None, pt, slot: int, walked) -> DataFrame | None:
        """What patterns have found for the start or the end of a path that repeats there."""
        t = pt[slot]
        if found is None or not (walked(pt[1]) and is_var(t) and t[1:] in found.vars):
            return None
        return paths.seed_keys(found.as_terms([t[1:]]).df, t[1:])

    def apart(t) -> Solutions | None:
        """The patterns left that bind a variable and have nothing to do with those before, solved by themselves."""
        if sol is None or not is_var(t) or t[1:] in known:
            return None
        names, found = {t[1:]}, None
        while True:
            fitting = [pt for pt in todo if not isinstance(pt[1], paths.Path) and variables(pt) & names and not variables(pt) & known]
            if not fitting:
                return found
            todo.remove(fitting[0])
            names |= variables(fitting[0])
            found = solve(fitting[0]) if found is None else found.join(solve(fitting[0]))

    sol = None
    known: set[str] = set()
    while todo:
        connected = [pt for pt in todo if variables(pt) & known] or todo
        # what walks comes last, unless its start or end is fixed
        pt = min(connected, key=lambda pt: (paths.walks(pt[1]) and is_var(pt[0]) and is_var(pt[2]), len(variables(pt) - known), todo.index(pt)))
        todo.remove(pt)
        # an end of a walk that other patterns bind is found first, so that the walk needn't go everywhere
        sides = [apart(pt[i]) for i, walked in ((0, paths.walks), (2, paths.walks_back)) if walked(pt[1])]
        sides = [side for side in (sol, *sides) if side is not None]
        starts, ends = (
            next((keys for side in sides if (keys := keys_of(side, pt, i, walked)) is not None), None)
            for i, walked in ((0, paths.walks), (2, paths.walks_back))
        )
        part = solve(pt, starts, ends)
        for side in sides:
            part = side.join(part)
        sol = part
        known |= set(part.vars)
    if sol is None:
        sol = unit(q)
    for pt in ground:
        found = solve(pt).df if isinstance(pt[1], paths.Path) else match(q, *pt, graphs=graphs)[0]
        sol = sol.filter(found.exists())
    for name, term in bound.items():
        if name in used and name not in sol.vars:
            sol = sol.bind(name, term)
    return sol


def _dataset(graph, from_, from_named) -> list[str] | None:
    """The graphs a pattern may come from; None is all of them."""
    if graph is not None and not is_var(graph):
        return graph_list([graph])
    listed = from_named if graph is not None else from_
    return None if listed is None else graph_list(listed)


def _narrowed(q: TableQuads, patterns: list[tuple], graphs) -> dict[tuple, TableQuads]:
    """For each pattern, the branches that can take part in the join."""
    plain = [pt for pt in patterns if not isinstance(pt[1], paths.Path)]
    views, slots = [], []
    for s, p, o in plain:
        p = V.RDF_TYPE if p == "a" else p
        views.append(q.limited(None if is_var(p) else as_term(p).value, graphs))
        slots.append(tuple(t if is_var(t) else None for t in (s, o)))
    return dict(zip(plain, narrow_together(views, slots)))


def unit(q: Quads) -> Solutions:
    """The solution sequence with one empty solution."""
    spark = match(q)[0].sparkSession
    return Solutions(spark.range(1).select(F.lit(True).alias("unit__")), ())


def values(spark: SparkSession, names: Iterable[str], rows: Iterable[Iterable], base: str | None = None) -> Solutions:
    """VALUES: inline solutions; None in a row is UNDEF (unbound).  Relative IRIs are resolved against ``base``."""
    names = [n.lstrip("?") for n in names]
    rows = [[None if v is None else as_term(with_base(as_term(v), base)) for v in row] for row in rows]
    if len(rows) == 0 or any(len(r) != len(names) for r in rows):
        raise ValueError("VALUES needs rows as long as the variable list")
    data = [
        [x for t in row for x in ((t.value, t.kind, t.dt, t.lang) if t else (None,) * 4)] for row in rows
    ]
    fields = ", ".join(f"`{n}` string, {', '.join(f'`{aux(n, p)}` string' for p in IDENTITY)}" for n in names)
    df = spark.createDataFrame([tuple(r) for r in data], fields)
    for n in names:
        df = df.withColumns(
            {
                aux(n, "num"): numeric_value(n, aux(n, "dt")),
                aux(n, "ts"): time_value(n, aux(n, "dt")),
            }
        )
    maybe = frozenset(n for i, n in enumerate(names) if any(r[i] is None for r in rows))
    return Solutions(df, tuple(names), frozenset(names), maybe)


# -- filter conditions ---------------------------------------------------------


def var(name: str) -> Column:
    """The IRI or lexical form of a variable."""
    return F.col(name.lstrip("?"))


def num(name: str) -> Column:
    """The numeric value of a variable; null when it has none."""
    return F.col(aux(name.lstrip("?"), "num"))


def ts(name: str) -> Column:
    """The date/time value of a variable; null when it has none."""
    return F.col(aux(name.lstrip("?"), "ts"))


def same_term(name: str, term: Term | str) -> Column:
    """sameTerm(?x, constant) for a variable that may hold literals."""
    name, term = name.lstrip("?"), as_term(term)
    cond = (F.col(name) == term.value) & (F.col(aux(name, "kind")) == term.kind)
    if term.kind == "lit":
        part, value = ("lang", term.lang) if term.lang else ("dt", term.dt)
        cond = cond & F.coalesce(F.col(aux(name, part)) == value, F.lit(False))
    return cond


def equals(name: str, value) -> Column:
    """FILTER ?x = constant: numbers and times by value, other terms by identity."""
    term = value if isinstance(value, Term) else (lit(value) if not isinstance(value, str) else as_term(value))
    if term.kind == "lit":
        c = constant_object(term)
        if term.dt in V.NUMERIC_TYPES:
            # integers and decimals by all their digits, unless a float takes part
            as_double = num(name) == c["o_num"]
            if term.dt not in V.EXACT_TYPES:
                return as_double
            dt = F.col(aux(name.lstrip("?"), "dt"))
            digits = dt.isin(*V.EXACT_TYPES) & ((dt == V.XSD_DECIMAL) | (F.abs(num(name)) >= float(2**53)))
            return as_double & F.when(digits, _exact(name) == exact_parts(c["o"], c["o_dt"])).otherwise(True)
        if term.dt in V.TIME_TYPES:
            return ts(name) == c["o_ts"]
    return same_term(name, term)


def _exact(name: str) -> Column:
    name = name.lstrip("?")
    return exact_parts(name, aux(name, "dt"))


def _number(value) -> tuple[Term, dict[str, Column]]:
    term = value if isinstance(value, Term) else lit(value)
    if term.dt not in V.NUMERIC_TYPES:
        raise ValueError(f"not a number: {value!r}")
    return term, constant_object(term)


def less_than(name: str, value) -> Column:
    """FILTER ?x < number: integers and decimals by all their digits, floats as doubles."""
    term, c = _number(value)
    as_double = num(name) < c["o_num"]
    if term.dt not in V.EXACT_TYPES:
        return as_double
    both = F.col(aux(name.lstrip("?"), "dt")).isin(*V.EXACT_TYPES)
    return F.when(both, exact_less(_exact(name), exact_parts(c["o"], c["o_dt"]))).otherwise(as_double)


def greater_than(name: str, value) -> Column:
    """FILTER ?x > number: integers and decimals by all their digits, floats as doubles."""
    term, c = _number(value)
    as_double = num(name) > c["o_num"]
    if term.dt not in V.EXACT_TYPES:
        return as_double
    both = F.col(aux(name.lstrip("?"), "dt")).isin(*V.EXACT_TYPES)
    return F.when(both, exact_less(exact_parts(c["o"], c["o_dt"]), _exact(name))).otherwise(as_double)


def not_equals(name: str, value) -> Column:
    """FILTER ?x != constant; an IRI and a literal differ, literals of other types can't be compared with a number."""
    term = value if isinstance(value, Term) else (lit(value) if not isinstance(value, str) else as_term(value))
    if term.kind == "lit":
        return F.when(F.col(aux(name.lstrip("?"), "kind")) != term.kind, True).otherwise(~equals(name, value))
    return ~equals(name, value)


def iri_in(name: str, iris: Iterable) -> Column:
    """FILTER ?x = (iri, iri, ...): membership in a list of IRIs."""
    return var(name).isin([as_term(i).value for i in iris])
