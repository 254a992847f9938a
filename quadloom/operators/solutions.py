"""Solution sequences: the result of matching patterns, and how they combine.

A variable ``x`` is a column ``x`` with the IRI or lexical form.  A variable that
can be a literal also has ``x__kind``, ``x__dt``, ``x__lang`` (term identity) and
``x__num``, ``x__ts`` (typed value, for filters, ordering and aggregates).  Unused
columns cost nothing: Catalyst prunes them.

Joins compare terms by identity.  A variable that may be unbound (it came from an
optional part) matches anything when unbound; such a join is either an equi-join
on the other shared variables with a residual test, or, when there is none, one
equi-join on the sets of variables that rows bind and their values there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadloom.functions.quad_columns import constant_object
from quadloom.functions.terms import numeric_value, time_value
from quadloom.model import Term
from quadloom.session import materialize, scratch_path

IDENTITY = ("kind", "dt", "lang")
VALUES = ("num", "ts")

# Fixed value: alike rows that are numbered at once, so that no array grows with their count.
CHUNK = 1 << 16
# Where few keys have many pairs: left rows of a part (whole bytes of bit-packed indices), and rows of both sides that one task gets.
SHARED, DEALT = 1024, 20_000


# Columns that a join by signature adds to either side.
HELPERS = [f"{side}__{part}" for side in "lr" for part in ("mask", "set", "key", "own", "other")]


def aux(var: str, part: str) -> str:
    return f"{var}__{part}"


@dataclass(frozen=True)
class Solutions:
    df: DataFrame
    vars: tuple[str, ...]
    terms: frozenset[str] = frozenset()  # variables that may hold literals
    maybe: frozenset[str] = frozenset()  # variables that may be unbound

    # -- columns -------------------------------------------------------------

    def columns_of(self, var: str) -> list[str]:
        if var in self.terms:
            return [var] + [aux(var, p) for p in IDENTITY + VALUES]
        return [var]

    def identity_of(self, var: str) -> list[str]:
        return self.columns_of(var)[:4]

    def _all_columns(self) -> list[str]:
        return [c for v in self.vars for c in self.columns_of(v)]

    def _with(self, df: DataFrame, **changes) -> Solutions:
        return replace(self, df=df, **changes)

    def as_terms(self, names) -> Solutions:
        """Give IRI-only variables the full set of term columns."""
        new = {}
        for v in names:
            if v not in self.terms:
                bound = F.col(v).isNotNull()
                new[aux(v, "kind")] = F.when(bound, F.lit("iri"))
                for part, typ in (("dt", "string"), ("lang", "string"), ("num", "double"), ("ts", "timestamp_ntz")):
                    new[aux(v, part)] = F.lit(None).cast(typ)
        if not new:
            return self
        return self._with(self.df.withColumns(new), terms=self.terms | frozenset(names))

    # -- simple operators ----------------------------------------------------

    def filter(self, condition: Column | str) -> Solutions:
        """Keep solutions whose condition holds; an error (null) does not hold."""
        return self._with(self.df.where(condition))

    def project(self, *names: str) -> Solutions:
        """Keep the named variables, or all of them."""
        return self._only(names or self.vars)

    def _only(self, names) -> Solutions:
        keep = [c for v in names for c in self.columns_of(v)]
        return Solutions(
            self.df.select(*keep), tuple(names), self.terms & frozenset(names), self.maybe & frozenset(names)
        )

    def distinct(self) -> Solutions:
        """Distinct by term identity of all variables."""
        return self._with(self.df.dropDuplicates([c for v in self.vars for c in self.identity_of(v)]))

    def select(self, *names: str, **computed: Column) -> DataFrame:
        """SELECT: a plain DataFrame with the named columns and computed ones."""
        return self.df.select(*names, *[c.alias(n) for n, c in computed.items()])

    def bind(
        self, name: str, value: Column | Term, dt: str | None = None, like: str | None = None
    ) -> Solutions:
        """BIND / SELECT expression: a new variable; an error leaves it unbound.

        A constant term binds as itself.  A column binds as a literal of datatype
        ``dt``, as a literal with the datatype and language of the variable
        ``like`` (string functions keep their argument's tag), or else as an IRI.
        """
        if name in self.vars:
            raise ValueError(f"variable {name} is already bound")
        if isinstance(value, Term):
            obj = constant_object(value)
            if value.is_iri:
                return self._with(self.df.withColumn(name, obj["o"]), vars=self.vars + (name,))
            cols = {name: obj["o"]}
            for p in IDENTITY + VALUES:
                cols[aux(name, p)] = obj["o_" + p]
            return self._with(
                self.df.withColumns(cols), vars=self.vars + (name,), terms=self.terms | {name}
            )
        if dt is None and like is None:
            return self._with(
                self.df.withColumn(name, value), vars=self.vars + (name,), maybe=self.maybe | {name}
            )
        text = value.cast("string")
        dt_col = F.when(text.isNotNull(), F.lit(dt) if like is None else F.col(aux(like, "dt")))
        no_lang = F.lit(None).cast("string")
        cols = {
            name: text,
            aux(name, "kind"): F.when(text.isNotNull(), F.lit("lit")),
            aux(name, "dt"): dt_col,
            aux(name, "lang"): no_lang if like is None else F.when(text.isNotNull(), F.col(aux(like, "lang"))),
            aux(name, "num"): numeric_value(text, dt_col),
            aux(name, "ts"): time_value(text, dt_col),
        }
        return self._with(
            self.df.withColumns(cols),
            vars=self.vars + (name,),
            terms=self.terms | {name},
            maybe=self.maybe | {name},
        )

    # -- combining -----------------------------------------------------------

    def join(self, other: Solutions, spread: int = 1, shares: int | None = None) -> Solutions:
        """Inner join on the shared variables.

        ``spread`` splits hot keys of both sides over that many tasks; see ``_spread``.
        Without it a skewed join is left to adaptive execution.  ``shares`` is the number
        of tasks for combinations of rows without a bound variable in common; see ``_product``.
        With a bound one the left rows of each key are dealt to that many shares and the right ones
        copied to each: for few keys with many rows on both sides, whose pairs are far more than the rows.
        """
        left, right, shared = _align(self, other)
        sure = [v for v in shared if v not in left.maybe | right.maybe]
        if sure or not shared:
            out = (
                _join(left, right, shared, "inner", spread=spread, shares=shares)
                if sure
                else _product(left, right, outer=False, shares=shares)
            )
        else:
            out = _join_by_signature(left, right, shared, shares)
        maybe = (
            (left.maybe - frozenset(right.vars))
            | (right.maybe - frozenset(left.vars))
            | (left.maybe & right.maybe)
        )
        return replace(out, maybe=maybe)

    def optional(
        self, other: Solutions, condition: Column | None = None, spread: int = 1, shares: int | None = None
    ) -> Solutions:
        """Left join; ``condition`` is a FILTER inside the optional part."""
        left, right, shared = _align(self, other)
        sure = [v for v in shared if v not in left.maybe | right.maybe]
        maybe = left.maybe | (frozenset(right.vars) - frozenset(left.vars))
        if sure:
            if spread > 1:
                return replace(_optional_spread(left, right, shared, sure[0], condition, spread), maybe=maybe)
            return replace(_join(left, right, shared, "left", condition), maybe=maybe)
        if condition is not None:
            raise ValueError("an optional part with a filter needs a shared variable that is always bound")
        if not shared:
            return replace(_product(left, right, outer=True, shares=shares), maybe=maybe)
        if len(shared) > 1 or shared[0] in right.maybe:
            raise ValueError("an optional part must bind the variables it shares, or share a bound one")
        v = shared[0]
        bound = _join(left.filter(F.col(v).isNotNull()), right, shared, "left")
        unbound = _product(_drop_vars(left.filter(F.col(v).isNull()), [v]), right, outer=True, shares=shares)
        return replace(bound.union(unbound).project(*_merged_vars(left, right)), maybe=maybe)

    def exists(self, other: Solutions) -> Solutions:
        """FILTER EXISTS: left semi join on the shared variables."""
        return self._semi(other, "left_semi")

    def not_exists(self, other: Solutions) -> Solutions:
        """FILTER NOT EXISTS: left anti join on the shared variables."""
        return self._semi(other, "left_anti")

    def _semi(self, other: Solutions, how: str) -> Solutions:
        left, right, shared = _align(self, other)
        if not shared:
            found = right.df.exists()
            return self.filter(found if how == "left_semi" else ~found)
        # Distinct keys first: a hot key shrinks to one row per map task.
        right = right.project(*shared).distinct()
        if any(v not in left.maybe | right.maybe for v in shared):
            return self._with(_join(left, right, shared, how).df.select(*self._all_columns()))
        if right.maybe & frozenset(shared):
            raise ValueError("the tested part must bind one of the shared variables")
        kept = []
        for bound, part in _by_bound(left, shared):
            if bound:
                df = _join(part, _drop_vars(right, [v for v in shared if v not in bound]), bound, how).df
            else:
                found = right.df.exists()
                df = part.df.where(found if how == "left_semi" else ~found)
            kept.append(df.select(*self._all_columns()))
        return self._with(reduce(DataFrame.union, kept))

    def minus(self, other: Solutions) -> Solutions:
        """MINUS: drop solutions compatible with one of ``other`` that shares a bound variable."""
        left, right, shared = _align(self, other)
        if not shared:
            return self
        right = right.project(*shared).distinct()
        if any(v not in left.maybe | right.maybe for v in shared):
            df = _join(left, right, shared, "left_anti").df
            return self._with(df.select(*self._all_columns()))
        rights = list(_by_bound(right, shared))
        kept = []
        for l_bound, lp in _by_bound(left, shared):
            for r_bound, rp in rights:
                both = [v for v in shared if v in l_bound and v in r_bound]
                if both:
                    lp = replace(lp, df=_join(lp, rp, both, "left_anti").df)
            kept.append(lp.df.select(*self._all_columns()))
        return self._with(reduce(DataFrame.union, kept))

    def union(self, other: Solutions) -> Solutions:
        """UNION: bag union; a variable missing on one side is unbound there."""
        both = frozenset(self.vars) & frozenset(other.vars)
        terms = self.terms | other.terms
        left = self.as_terms([v for v in self.vars if v in terms])
        right = other.as_terms([v for v in other.vars if v in terms])
        out_vars = self.vars + tuple(v for v in other.vars if v not in self.vars)
        maybe = self.maybe | other.maybe | (frozenset(out_vars) - both)
        df = left.df.select(*left._all_columns()).unionByName(
            right.df.select(*right._all_columns()), allowMissingColumns=True
        )
        return Solutions(df, out_vars, terms, maybe)

    def transform(self, f: Callable[[DataFrame], DataFrame]) -> Solutions:
        """Apply a DataFrame function that keeps the columns (a result transform)."""
        return self._with(self.df.transform(f))


# -- helpers -----------------------------------------------------------------


def _merged_vars(left: Solutions, right: Solutions) -> list[str]:
    return list(left.vars) + [v for v in right.vars if v not in left.vars]


def _align(left: Solutions, right: Solutions) -> tuple[Solutions, Solutions, list[str]]:
    """Shared variables, with equal column sets on both sides.

    Where one side can only hold IRIs the other is restricted to IRIs as part of
    the join condition (see ``_join``), so no columns are added there unless the
    variable may be unbound.
    """
    shared = [v for v in left.vars if v in right.vars]
    widen = [
        v for v in shared if (v in left.terms) != (v in right.terms) and v in left.maybe | right.maybe
    ]
    return left.as_terms(widen), right.as_terms(widen), shared


def _drop_vars(sol: Solutions, names) -> Solutions:
    return sol._only([v for v in sol.vars if v not in names])


def _renamed(sol: Solutions, names, helpers: str = "") -> tuple[DataFrame, Callable[[str], Column]]:
    """The frame with the columns of shared variables moved out of the way; ``helpers`` begins further ones to keep."""
    moved = {c: f"r__{c}" for v in names for c in sol.columns_of(v)}
    more = [c for c in sol.df.columns if c in HELPERS] if helpers else []
    df = sol.df.select(*[F.col(c).alias(moved.get(c, c)) for c in sol._all_columns()], *more)
    return df, lambda c: F.col(moved.get(c, c))


def _hot(df: DataFrame, key: str, spread: int, flag: str) -> DataFrame:
    """``df`` with a flag for rows whose key holds more than 1/spread of them: fewer than ``spread`` keys, which are broadcast."""
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    found = df.groupBy(F.col(key).alias("hot__")).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(found.where(F.col("n") * spread > rows).select("hot__", F.lit(True).alias(flag)))


def _spread(ldf: DataFrame, rdf: DataFrame, key: str, rkey: str, spread: int, how: str):
    """Split the rows of hot keys over ``spread`` shares; copy the other side's rows of the key to each.

    Keys that are hot on the left are split there, in inner joins also those that are hot on
    the right (a left join sees none of those, see ``_optional_spread``).  Shares come from a
    hash of the row and its number among alike ones, so a task that runs again makes the same ones.
    """
    hots = [(_hot(ldf, key, spread, "hot_left__"), "hot_left__", "l__share", "r__share")]
    if how == "inner":
        hots.append((_hot(rdf, rkey, spread, "hot_right__"), "hot_right__", "r__other", "l__other"))
    for hot, flag, dealt, copied in hots:
        own = dealt[0] == "l"
        split, other = (ldf, rdf) if own else (rdf, ldf)
        k, o = (key, rkey) if own else (rkey, key)
        # one pass over the rows: a plan that reads a LIMIT twice may see other ones
        split = _numbered(split).join(hot, F.col(k) == F.col("hot__"), "left").drop("hot__")
        is_hot = F.col(flag).isNotNull()
        share = F.pmod(F.xxhash64(*[c for c in split.columns if c != flag]), F.lit(spread)).cast("int")
        split = split.withColumn(dealt, F.when(is_hot, share).otherwise(F.lit(0))).drop("copy__", flag)
        other = other.join(hot, F.col(o) == F.col("hot__"), "left").drop("hot__")
        shares = F.sequence(F.lit(0), F.when(is_hot, F.lit(spread - 1)).otherwise(F.lit(0)))
        other = other.withColumn(copied, F.explode(shares)).drop(flag)
        ldf, rdf = (split, other) if own else (other, split)
    return ldf, rdf


def _optional_spread(left: Solutions, right: Solutions, shared, key: str, condition: Column | None, spread: int) -> Solutions:
    """Left join whose hot keys are split on both sides.

    Rows whose key is hot on the right are joined apart, as an inner join with shares of both
    sides; those of them that found nothing are told by a row number, which is written once,
    and come back without the optional part.
    """
    hot = _hot(right.df.select(F.col(key).alias("k__")), "k__", spread, "hot__flag")
    ldf = left.df.select(*left._all_columns()).join(hot, F.col(key) == F.col("hot__"), "left").drop("hot__")
    numbered = ldf.withColumn("row__", F.monotonically_increasing_id())
    held = materialize(numbered, scratch_path(ldf.sparkSession, "optional"))
    flag = F.col("hot__flag").isNotNull()
    cold = replace(left, df=held.where(~flag))
    rest = _join(cold, right, shared, "left", condition, spread)
    hot_rows = held.where(flag)
    numbered_left = replace(left, df=hot_rows, vars=(*left.vars, "row__"))
    found = _join(numbered_left, right, shared, "inner", condition, spread)
    none = hot_rows.join(found.df.select(F.col("row__").alias("found__")).distinct(), F.col("row__") == F.col("found__"), "left_anti")
    alone = Solutions(none.select(*left._all_columns()), left.vars, left.terms, left.maybe)
    merged = _merged_vars(left, right)
    return rest.union(found.project(*merged)).union(alone).project(*merged)


def _few_keys(ldf: DataFrame, rdf: DataFrame, key: str, shares: int) -> tuple[DataFrame, DataFrame]:
    """Deal left rows of each key to ``shares`` and those to parts of SHARED rows; copy right ones to each part.

    Tasks get about DEALT rows of both sides: their own sizes say nothing about their pairs.
    """
    dealt = ldf.withColumn("l__deal", F.pmod(F.xxhash64(*ldf.columns), F.lit(shares)).cast("int"))
    nth = F.row_number().over(Window.partitionBy(key, "l__deal").orderBy(*ldf.columns))
    # written once, so that the copies belong to the same parts
    ldf = materialize(dealt.withColumn("l__part", F.floor((nth - 1) / SHARED)), scratch_path(ldf.sparkSession, "parts"))
    parts = ldf.groupBy(F.col(key).alias("p__key"), F.col("l__deal").alias("r__deal")).agg(F.max("l__part").alias("p__last"))
    copied = rdf.join(parts, F.col(f"r__{key}") == F.col("p__key")).drop("p__key")
    n = ldf.count() + (copied.agg(F.sum(F.col("p__last") + 1)).first()[0] or 0)
    tasks = max(shares, int(ldf.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // DEALT))
    rdf = copied.withColumn("r__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("p__last")))).drop("p__last")
    return ldf.repartition(tasks, key, "l__deal", "l__part"), rdf.repartition(tasks, f"r__{key}", "r__deal", "r__part")


def _join(
    left: Solutions,
    right: Solutions,
    shared,
    how: str,
    condition: Column | None = None,
    spread: int = 1,
    keep: tuple[str, str] | None = None,
    shares: int | None = None,
) -> Solutions:
    """``keep`` names the prefixes of further columns of each side that the condition needs."""
    rdf, rcol = _renamed(right, shared, "" if keep is None else f"{keep[1]}__")
    ldf = left.df if keep is not None else left.df.select(*left._all_columns())
    cond = None
    if spread > 1:
        # the share belongs to a key that is always bound
        key = next(v for v in shared if v not in left.maybe | right.maybe)
        ldf, rdf = _spread(ldf, rdf, key, f"r__{key}", spread, how)
        cond = F.col("l__share") == F.col("r__share")
        if how == "inner":
            cond = cond & (F.col("l__other") == F.col("r__other"))
    if shares is not None:
        key = next(v for v in shared if v not in left.maybe | right.maybe)
        ldf, rdf = _few_keys(ldf, rdf, key, shares)
        dealt = (F.col("l__deal") == F.col("r__deal")) & (F.col("l__part") == F.col("r__part"))
        cond = dealt if cond is None else cond & dealt
    for v in shared:
        eq = F.col(v) == rcol(v)
        if v in left.terms and v in right.terms:
            eq = eq & (F.col(aux(v, "kind")) == rcol(aux(v, "kind")))
            for p in ("dt", "lang"):
                eq = eq & F.col(aux(v, p)).eqNullSafe(rcol(aux(v, p)))
        elif v in left.terms:
            eq = eq & (F.col(aux(v, "kind")) == "iri")
        elif v in right.terms:
            rdf = rdf.where(rcol(aux(v, "kind")) == "iri")
        if v in left.maybe | right.maybe:
            eq = F.col(v).isNull() | rcol(v).isNull() | eq
        cond = eq if cond is None else cond & eq
    if condition is not None:
        cond = cond & condition
    # the right rows lead, each with all left ones of its part: what is written repeats, so it compresses
    joined = ldf.join(rdf, cond, how) if shares is None else rdf.join(ldf.hint("merge"), cond, how)
    if how in ("left_semi", "left_anti"):
        return replace(left, df=joined)
    out, terms = [], frozenset()
    for v in _merged_vars(left, right):
        if v in shared and v in left.maybe | right.maybe:
            cols = left.columns_of(v)
            out += [F.when(F.col(v).isNotNull(), F.col(c)).otherwise(rcol(c)).alias(c) for c in cols]
            if v in left.terms:
                terms |= {v}
        elif v in shared and how == "inner" and not (v in left.terms and v in right.terms):
            out.append(F.col(v))
        else:
            src = left if v in left.vars else right
            out += [F.col(c) for c in src.columns_of(v)]
            if v in src.terms:
                terms |= {v}
    return Solutions(joined.select(*out), tuple(_merged_vars(left, right)), terms, left.maybe | right.maybe)


def _by_bound(sol: Solutions, shared):
    """Split by which of the possibly-unbound shared variables are bound."""
    open_vars = [v for v in shared if v in sol.maybe]
    closed = [v for v in shared if v not in sol.maybe]
    for k in range(len(open_vars), -1, -1):
        for bound in combinations(open_vars, k):
            part = sol
            for v in open_vars:
                part = part.filter(F.col(v).isNotNull() if v in bound else F.col(v).isNull())
            yield closed + list(bound), replace(part, maybe=sol.maybe - frozenset(bound))


def _mask(prefix: Callable[[str], Column], shared) -> Column:
    """Which of the shared variables are bound, as bits."""
    bits = [F.when(prefix(v).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, v in enumerate(shared)]
    return reduce(lambda a, b: a + b, bits)


def _join_by_signature(left: Solutions, right: Solutions, shared, shares: int | None) -> Solutions:
    """Inner join where every shared variable may be unbound: one equi-join, however many there are.

    A row is copied to the sets of variables that it can be compared on, the subsets of those
    it binds, and joins on the set and a hash of its values there.  Of all sets that two rows
    have in common only the largest, what both bind, gives their solution.  Rows that bind
    nothing in common are combined by shares, those of one set of bound variables with those
    of a disjoint one.
    """
    masks = range(1 << len(shared))
    sides = []
    for sol, name in ((left, "l"), (right, "r")):
        bound = _mask(F.col, shared)
        df = sol.df.select(*sol._all_columns(), bound.alias(f"{name}__mask"))
        held = []
        for i, v in enumerate(shared):
            # alike columns on both sides: a variable of terms on one side is widened on the other
            values = [F.coalesce(F.col(c), F.lit("")) for c in sol.identity_of(v)]
            held.append(F.when(F.col(f"{name}__set").bitwiseAND(1 << i) != 0, F.xxhash64(F.lit(i), *values)))
        sets = F.expr(f"filter(array({', '.join(str(m) for m in masks if m)}), m -> m & {name}__mask = m)")
        keyed = df.withColumn(f"{name}__set", F.explode(sets))
        sides.append((df, keyed.withColumn(f"{name}__key", F.xxhash64(F.col(f"{name}__set"), *held))))
    (ldf, lkeyed), (rdf, rkeyed) = sides
    largest = F.col("l__set") == F.col("l__mask").bitwiseAND(F.col("r__mask"))
    extra = (F.col("l__key") == F.col("r__key")) & (F.col("l__set") == F.col("r__set")) & largest
    joined = _join(replace(left, df=lkeyed), replace(right, df=rkeyed), shared, "inner", extra, keep=("l", "r"))

    # nothing in common: a row meets the sets of bound variables that are disjoint with its own
    def apart(df: DataFrame, own: str, other: str) -> DataFrame:
        bound = F.col(f"{own}__mask")
        disjoint = F.filter(F.array(*[F.lit(m) for m in masks]), lambda m: m.bitwiseAND(bound) == 0)
        return df.withColumn(f"{own}__other", F.explode(disjoint)).withColumnRenamed(f"{own}__mask", f"{own}__own")

    same = (F.col("l__own") == F.col("r__other")) & (F.col("l__other") == F.col("r__own"))
    loose = _product(
        replace(left, df=apart(ldf, "l", "r")), replace(right, df=apart(rdf, "r", "l")), outer=False, shares=shares,
        same=same, keep=True, shared=shared,
    )
    return joined.union(loose).project(*_merged_vars(left, right))


def _numbered(df: DataFrame) -> DataFrame:
    """The same rows with a running number ``copy__`` among those that are alike.

    It comes from their count, not from an order, so a task that runs again gives the same ones.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n__")).where("n__ > 0")
    chunks = counted.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(n__ - 1) div {CHUNK}"))).alias("chunk__"))
    last = F.least(F.lit(CHUNK - 1), F.col("n__") - 1 - F.col("chunk__") * CHUNK)
    within = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("copy__")
    return chunks.select(*df.columns, "chunk__", within).withColumn("copy__", F.col("chunk__") * CHUNK + F.col("copy__")).drop("chunk__")


def _dealt(df: DataFrame, share: str, shares: int) -> DataFrame:
    """The rows with a share each, alike rows evenly, by a hash of the row and its number."""
    if shares == 1:
        return df.withColumn(share, F.lit(0))
    rows = _numbered(df)
    return rows.withColumn(share, F.pmod(F.xxhash64(*rows.columns), F.lit(shares)).cast("int")).drop("copy__")


def _size(df: DataFrame) -> float:
    return float(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _product(
    left: Solutions,
    right: Solutions,
    outer: bool,
    shares: int | None = None,
    same: Column | None = None,
    keep: bool = False,
    shared: Iterable[str] = (),
) -> Solutions:
    """All combinations of unrelated solutions, whatever their number.

    ``same`` is a condition on helper columns, which ``keep`` keeps until then; of ``shared``
    variables at most one side binds each.

    Both sides are dealt out to shares, and copied to every share of the other side, so this
    is an equi-join on pairs of shares: ``shares`` of them (the shuffle partitions by default).
    How many belong to which side follows Catalyst's sizes, so that few rows are copied.
    """
    ldf = left.df if keep else left.df.select(*left._all_columns())
    rdf, rcol = _renamed(right, shared, "r__" if keep else "")
    if outer:
        # one row of nulls stands for a right side without rows
        none = rdf.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rdf.schema])
        rdf = rdf.union(none.where(~rdf.exists()))
    shares = max(2, shares or int(rdf.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    of_left = round((shares * _size(ldf) / max(1.0, _size(rdf))) ** 0.5)
    of_left = max(1, min(shares, of_left))
    of_right = -(-shares // of_left)
    ldf = _dealt(ldf, "l__left", of_left).withColumn("l__right", F.explode(F.sequence(F.lit(0), F.lit(of_right - 1))))
    rdf = _dealt(rdf, "r__right", of_right).withColumn("r__left", F.explode(F.sequence(F.lit(0), F.lit(of_left - 1))))
    cell = (F.col("l__left") == F.col("r__left")) & (F.col("l__right") == F.col("r__right"))
    joined = ldf.join(rdf, cell if same is None else cell & same)
    out = []
    for v in _merged_vars(left, right):
        cols = left.columns_of(v) if v in left.vars else right.columns_of(v)
        out += [F.when(F.col(v).isNotNull(), F.col(c)).otherwise(rcol(c)).alias(c) if v in shared else F.col(c) for c in cols]
    return Solutions(
        joined.select(*out),
        tuple(_merged_vars(left, right)),
        left.terms | right.terms,
        left.maybe | right.maybe,
    ).project(*_merged_vars(left, right))
