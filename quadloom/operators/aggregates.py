"""Grouping and set functions over solutions.

All aggregates here are partial-then-final, so a hot group shrinks to one row per
map task before it is shuffled.  An error in a group (a non-number in a SUM)
leaves that group's value unbound.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.terms import exact_order, exact_parts
from quadloom.operators.solutions import IDENTITY, Solutions, aux


def group(sol: Solutions, by: Iterable[str] = (), **aggregates: Column) -> DataFrame:
    """GROUP BY: one row per group, or a single row without ``by``."""
    aggs = [c.alias(n) for n, c in aggregates.items()]
    by = list(by)
    return sol.df.groupBy(*by).agg(*aggs) if by else sol.df.agg(*aggs)


def count(name: str | None = None) -> Column:
    """COUNT(?x) counts bound values; COUNT(*) counts solutions."""
    return F.count(F.lit(1) if name is None else F.col(name))


def count_distinct(sol: Solutions, name: str) -> Column:
    """COUNT(DISTINCT ?x) by term identity."""
    if name not in sol.terms:
        return F.count_distinct(F.col(name))
    term = F.struct(F.col(name), *[F.col(aux(name, p)) for p in IDENTITY])
    return F.count_distinct(F.when(F.col(name).isNotNull(), term))


def approx_count_distinct(name: str, rsd: float = 0.05) -> Column:
    """A size estimate by lexical form."""
    return F.approx_count_distinct(F.col(name), rsd)


def _all_numeric(name: str) -> Column:
    return F.count(F.col(name)) == F.count(F.col(aux(name, "num")))


def sum_(name: str) -> Column:
    """SUM(?x): 0 for no values, unbound when a value is not a number."""
    return F.when(_all_numeric(name), F.coalesce(F.sum(F.col(aux(name, "num"))), F.lit(0.0)))


def avg(name: str) -> Column:
    """AVG(?x): 0 for no values, unbound when a value is not a number."""
    return F.when(_all_numeric(name), F.coalesce(F.avg(F.col(aux(name, "num"))), F.lit(0.0)))


def sum_term(name: str) -> Column:
    """SUM(?x) as a term (o, o_dt) of the promoted type: integer, decimal, or double.

    Integers and decimals add up exactly, in any order; the result is unbound when
    a value is not a number, or when an exact one needs more digits than a Spark
    decimal holds (38, or 20 before and 18 after the point beside decimals).
    """
    text, dt, number = F.col(name), F.col(aux(name, "dt")), F.col(aux(name, "num"))
    whole, exact = dt.isin(*V.INTEGER_TYPES), dt.isin(*V.EXACT_TYPES)
    n = F.count(number)

    def total(kind: Column, decimal: str) -> Column:
        value = F.when(kind, text.try_cast(decimal))
        zero = F.lit(0).cast(decimal)
        return F.when(F.count(value) == n, F.when(n == 0, zero).otherwise(F.try_sum(value)))

    # a cast to text may give an exponent
    point = F.translate(F.format_number(total(exact & text.rlike(_FEW_DIGITS), "decimal(38,18)"), 18), ",", "")
    trimmed = F.regexp_replace(point, r"\.?0+$", "")
    all_whole = F.count(F.when(whole, number)) == n
    all_exact = F.count(F.when(exact, number)) == n
    value = (
        F.when(all_whole, total(whole, "decimal(38,0)").cast("string"))
        .when(all_exact, trimmed)
        .otherwise(F.sum(number).cast("string"))
    )
    kind = F.when(all_whole, V.XSD_INTEGER).when(all_exact, V.XSD_DECIMAL).otherwise(V.XSD_DOUBLE)
    return F.when(
        _all_numeric(name) & value.isNotNull(), F.struct(value.alias("o"), kind.alias("o_dt"))
    )


# Texts of decimals that lose nothing in 18 places.
_FEW_DIGITS = r"^[+-]?[0-9]*(?:\.[0-9]{0,18}0*)?$"


def _term(name: str) -> Column:
    return F.struct(F.col(name).alias("o"), *[F.col(aux(name, p)).alias("o_" + p) for p in IDENTITY])


def _by_value(name: str) -> Column:
    """Numbers by value, then exactly; null for other terms, which aggregates pass over."""
    text, dt, number = F.col(name), F.col(aux(name, "dt")), F.col(aux(name, "num"))
    exact = dt.isin(*V.EXACT_TYPES)
    # an infinite double is beyond the integers that are too long for a double
    beyond = F.when(exact | (F.abs(number) != float("inf")), 0).otherwise(F.signum(number).cast("int"))
    # doubles of up to 20 digits as decimals; a cast to text may give an exponent
    double = F.translate(F.format_number(text.try_cast("decimal(38,18)"), 18), ",", "")
    parts = exact_parts(F.when(exact, text).otherwise(double), F.when(exact, dt).otherwise(F.lit(V.XSD_DECIMAL)))
    return F.when(number.isNotNull(), F.struct(number, beyond, exact_order(parts), text))


def min_term(name: str) -> Column:
    """MIN(?x) over numbers as a whole term: form, kind, datatype, language."""
    return F.min_by(_term(name), _by_value(name))


def max_term(name: str) -> Column:
    """MAX(?x) over numbers as a whole term: form, kind, datatype, language."""
    return F.max_by(_term(name), _by_value(name))


def sample_term(sol: Solutions, name: str) -> Column:
    """SAMPLE(?x) as a whole term; the least, so that reruns agree."""
    if name not in sol.terms:
        raise ValueError(f"variable {name} holds IRIs only: use sample")
    return F.min(F.when(F.col(name).isNotNull(), _term(name)))


def min_num(name: str) -> Column:
    return F.min(F.col(aux(name, "num")))


def max_num(name: str) -> Column:
    return F.max(F.col(aux(name, "num")))


def min_time(name: str) -> Column:
    return F.min(F.col(aux(name, "ts")))


def max_time(name: str) -> Column:
    return F.max(F.col(aux(name, "ts")))


def min_str(name: str) -> Column:
    return F.min(F.col(name))


def max_str(name: str) -> Column:
    return F.max(F.col(name))


def sample(name: str) -> Column:
    """SAMPLE(?x): any value; the least, so that reruns agree."""
    return F.min(F.col(name))


def group_concat(
    sol: Solutions, by: Iterable[str], name: str, alias: str, separator: str = " ", distinct: bool = False
) -> DataFrame:
    """GROUP_CONCAT in sorted order: the result holds a whole group in one string."""
    by = list(by)
    rows = sol.project(*by, name)
    if distinct:
        rows = rows.distinct()
    df = rows.df.select(*by, F.col(name))
    return df.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(name)), separator).alias(alias))
