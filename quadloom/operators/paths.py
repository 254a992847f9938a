"""Property paths: ways to get from one term to another over several predicates.

A path evaluates to pairs of terms: columns ``x, x_kind, x_dt, x_lang, x_num,
x_ts`` and the same for ``y``.  Sequences, inverses, alternatives and negated sets
keep duplicates; ``?``, ``+`` and ``*`` give distinct pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.terms import numeric_value, time_value
from quadloom.model import Term, as_term, with_base
from quadloom.operators.closure import between, reachable, transitive_closure, with_identity
from quadloom.operators.scan import Quads, match

PARTS = ("", "_kind", "_dt", "_lang", "_num", "_ts")


class Path:
    """Base of all property paths."""


@dataclass(frozen=True)
class Link(Path):
    predicate: str


@dataclass(frozen=True)
class Inverse(Path):
    path: Path


@dataclass(frozen=True)
class Sequence(Path):
    first: Path
    second: Path


@dataclass(frozen=True)
class Alternative(Path):
    first: Path
    second: Path


@dataclass(frozen=True)
class NotIn(Path):
    predicates: tuple[str, ...]


@dataclass(frozen=True)
class Repeat(Path):
    """``?`` (zero, once), ``+`` (many) and ``*`` (zero, many)."""

    path: Path
    zero: bool
    many: bool


def _path(p) -> Path:
    return p if isinstance(p, Path) else Link(V.RDF_TYPE if p == "a" else as_term(p).value)


def seq(*paths) -> Path:
    """p1/p2/..."""
    return reduce(Sequence, map(_path, paths))


def inverse(path) -> Path:
    """^p"""
    return Inverse(_path(path))


def alt(*paths) -> Path:
    """p1|p2|..."""
    return reduce(Alternative, map(_path, paths))


def optional_step(path) -> Path:
    """p?"""
    return Repeat(_path(path), zero=True, many=False)


def plus(path) -> Path:
    """p+"""
    return Repeat(_path(path), zero=False, many=True)


def star(path) -> Path:
    """p*"""
    return Repeat(_path(path), zero=True, many=True)


def not_in(*forward, backward: tuple = ()) -> Path:
    """!(p1|p2|^p3|...)"""
    ahead = NotIn(tuple(as_term(p).value for p in forward))
    if not backward:
        return ahead
    back = Inverse(NotIn(tuple(as_term(p).value for p in backward)))
    return Alternative(ahead, back) if forward else back


def based(path: Path, base: str | None) -> Path:
    """The path with relative IRIs resolved."""
    if base is None:
        return path
    if isinstance(path, Link):
        return Link(as_term(with_base(path.predicate, base)).value)
    if isinstance(path, NotIn):
        return NotIn(tuple(as_term(with_base(p, base)).value for p in path.predicates))
    if isinstance(path, Inverse):
        return Inverse(based(path.path, base))
    if isinstance(path, Repeat):
        return Repeat(based(path.path, base), path.zero, path.many)
    return type(path)(based(path.first, base), based(path.second, base))


def walks(path) -> bool:
    """Does the path begin by repeating a step any number of times?"""
    if isinstance(path, Sequence):
        return walks(path.first)
    return isinstance(path, Repeat) and path.many


def walks_back(path) -> bool:
    """Does the path end by repeating a step any number of times?"""
    if isinstance(path, Sequence):
        return walks_back(path.second)
    return isinstance(path, Repeat) and path.many


def _plain(path: Path) -> bool:
    """Is a step of the path read from the quads without a join?"""
    if isinstance(path, Alternative):
        return _plain(path.first) and _plain(path.second)
    return isinstance(path, (Link, NotIn)) or (isinstance(path, Inverse) and _plain(path.path))


# -- evaluation ------------------------------------------------------------------


def _subject(prefix: str) -> list[Column]:
    none = F.lit(None)
    return [
        F.col("s").alias(prefix),
        F.lit("iri").alias(prefix + "_kind"),
        none.cast("string").alias(prefix + "_dt"),
        none.cast("string").alias(prefix + "_lang"),
        none.cast("double").alias(prefix + "_num"),
        none.cast("timestamp_ntz").alias(prefix + "_ts"),
    ]


def _object(prefix: str) -> list[Column]:
    return [F.col("o" + part).alias(prefix + part) for part in PARTS]


def _swapped(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        *[F.col("y" + part).alias("x" + part) for part in PARTS],
        *[F.col("x" + part).alias("y" + part) for part in PARTS],
    )


def _literal_ends(path: Path) -> tuple[bool, bool]:
    """Can the path's start / end be a literal?"""
    if isinstance(path, Inverse):
        a, b = _literal_ends(path.path)
        return b, a
    if isinstance(path, Sequence):
        return _literal_ends(path.first)[0], _literal_ends(path.second)[1]
    if isinstance(path, Alternative):
        (a, b), (c, d) = _literal_ends(path.first), _literal_ends(path.second)
        return a or c, b or d
    if isinstance(path, Repeat):
        a, b = _literal_ends(path.path)
        return (a or b, a or b) if path.zero else (a, b)
    return False, True


def evaluate(
    q: Quads,
    path: Path,
    graphs: list[str] | None = None,
    start: Term | None = None,
    end: Term | None = None,
    merge: bool = True,
    seeds: DataFrame | None = None,
    ends: DataFrame | None = None,
) -> DataFrame:
    """All pairs of the path, or those with a fixed start and/or end.

    ``seeds`` are keys ``x`` of the starts that matter, if the path walks from its
    start, and ``ends`` those of the ends, if it walks to its end; other pairs may be
    left out then.
    """
    if isinstance(path, (Link, NotIn)):
        p = path.predicate if isinstance(path, Link) else None
        df, one_graph = match(q, start, p, end, graphs)
        if isinstance(path, NotIn):
            df = df.where(~F.col("p").isin(list(path.predicates)))
        if merge and not one_graph:
            df = df.dropDuplicates(["s", "p", "o", "o_kind", "o_dt", "o_lang"])
        return df.select(*_subject("x"), *_object("y"))
    if isinstance(path, Inverse):
        return _swapped(evaluate(q, path.path, graphs, end, start, merge))
    if isinstance(path, Sequence):
        first = evaluate(q, path.first, graphs, start, None, merge, seeds)
        second = evaluate(q, path.second, graphs, None, end, merge, ends=ends)
        literal = _literal_ends(path.first)[1] and _literal_ends(path.second)[0]
        return _chained(first, second, literal)
    if isinstance(path, Alternative):
        return evaluate(q, path.first, graphs, start, end, merge).union(
            evaluate(q, path.second, graphs, start, end, merge)
        )
    return _repeated(q, path, graphs, start, end, seeds, ends)


def _chained(first: DataFrame, second: DataFrame, literal: bool) -> DataFrame:
    left = first.select(
        *["x" + part for part in PARTS],
        *[F.col("y" + part).alias("m" + part) for part in PARTS[:4]],
    )
    right = second.select(
        *[F.col("x" + part).alias("n" + part) for part in PARTS[:4]],
        *["y" + part for part in PARTS],
    )
    cond = F.col("m") == F.col("n")
    if literal:
        cond = cond & (F.col("m_kind") == F.col("n_kind"))
        for part in ("_dt", "_lang"):
            cond = cond & F.col("m" + part).eqNullSafe(F.col("n" + part))
    else:
        left, right = left.where("m_kind = 'iri'"), right.where("n_kind = 'iri'")
    return left.join(right, cond).select(*["x" + p for p in PARTS], *["y" + p for p in PARTS])


def _repeated(
    q: Quads, path: Repeat, graphs, start, end, seeds: DataFrame | None = None, ends: DataFrame | None = None
) -> DataFrame:
    spark = match(q)[0].sparkSession
    copied = not _plain(path.path)
    if not path.many:
        pairs = _keys(evaluate(q, path.path, graphs, start, end, merge=False)).distinct()
    elif start is not None or end is not None:
        # walk from the fixed end only; backwards when only the end is fixed
        step = _keys(evaluate(q, path.path, graphs, merge=False))
        seed = start if start is not None else end
        if start is None:
            step = step.select(F.col("y").alias("x"), F.col("x").alias("y"))
        pairs = reachable(step, spark.range(1).select(_constant_key(seed).alias("x")), copied)
        if start is None:
            pairs = pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))
        elif end is not None:
            pairs = pairs.where(F.col("y") == _constant_key(end))
    elif seeds is not None and ends is not None:
        pairs = between(_keys(evaluate(q, path.path, graphs, merge=False)), seeds, ends, copied)
    elif seeds is not None:
        pairs = reachable(_keys(evaluate(q, path.path, graphs, merge=False)), seeds, copied)
    elif ends is not None:
        step = _keys(evaluate(q, path.path, graphs, merge=False)).select(F.col("y").alias("x"), F.col("x").alias("y"))
        pairs = reachable(step, ends, copied).select(F.col("y").alias("x"), F.col("x").alias("y"))
    else:
        pairs = transitive_closure(_keys(evaluate(q, path.path, graphs, merge=False)))
    if path.zero:
        fixed = [t for t in (start, end) if t is not None]
        if not fixed:
            nodes = _nodes(q, graphs)
        elif len(fixed) == 2 and start != end:
            nodes = None
        else:
            nodes = spark.range(1).select(_constant_key(fixed[0]).alias("x"))
        if nodes is not None:
            pairs = with_identity(pairs, nodes)
    return pairs.select(*_from_key("x"), *_from_key("y"))


def _nodes(q: Quads, graphs) -> DataFrame:
    """Every term used as a subject or object in the dataset, as a key."""
    df = match(q, graphs=graphs)[0]
    subjects = df.select(F.concat(F.lit("I"), "s").alias("x"))
    objects = df.select(_key("o").alias("x"))
    return subjects.union(objects).distinct()


# A term as one string: 'I' + IRI, or 'L' + datatype, language and form.
_SEP = "\u0001"


def _key(prefix: str) -> Column:
    literal = F.concat(
        F.lit("L"),
        F.coalesce(F.col(prefix + "_dt"), F.lit("")),
        F.lit(_SEP),
        F.coalesce(F.col(prefix + "_lang"), F.lit("")),
        F.lit(_SEP),
        F.col(prefix),
    )
    return F.when(F.col(prefix + "_kind") == "iri", F.concat(F.lit("I"), F.col(prefix))).otherwise(literal)


def seed_keys(df: DataFrame, name: str) -> DataFrame:
    """The values of a variable with all its term columns, as keys."""
    parts = df.select(*[F.col(name if not part else f"{name}_{part}").alias("x" + part) for part in PARTS[:4]])
    return parts.select(_key("x").alias("x")).distinct()


def _constant_key(term: Term) -> Column:
    if term.is_iri:
        return F.lit("I" + term.value)
    return F.lit("L" + (term.dt or "") + _SEP + (term.lang or "") + _SEP + term.value)


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(_key("x").alias("x"), _key("y").alias("y"))


def _from_key(name: str) -> list[Column]:
    key = F.col(name)
    is_iri = key.startswith("I")
    body = key.substr(F.lit(2), F.length(key))
    parts = F.split(body, _SEP, 3)
    dt = F.when(~is_iri, F.nullif(F.get(parts, F.lit(0)), F.lit("")))
    value = F.when(is_iri, body).otherwise(F.element_at(parts, -1))
    return [
        value.alias(name),
        F.when(is_iri, F.lit("iri")).otherwise(F.lit("lit")).alias(name + "_kind"),
        dt.alias(name + "_dt"),
        F.when(~is_iri, F.nullif(F.get(parts, F.lit(1)), F.lit(""))).alias(name + "_lang"),
        numeric_value(value, dt).alias(name + "_num"),
        time_value(value, dt).alias(name + "_ts"),
    ]
