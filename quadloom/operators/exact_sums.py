"""Sums and averages of integers and decimals of any length.

A number is cut into limbs of nine digits.  Limbs of one place add up as ordinary partial
aggregates: those of usual numbers (``WHOLE`` and ``FRACTION`` limbs) as columns of one row, those of longer
ones as a row per place.  The carries run through the sums of a group in one expression.
Nothing is bounded but the places of the longest number.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.terms import exact_parts
from quadloom.operators.solutions import Solutions, aux

DIGITS = 9
BASE = 10**DIGITS
# Limbs behind the point of an average.
AVERAGE_LIMBS = 2
_WIDE = "decimal(38,0)"
# Limbs before and behind the point of numbers that need no row per limb.
WHOLE, FRACTION = 5, 2
# Limbs are added in two halves, so that no sum of 64 bits can pass them.
HALF = 10**5


def limbs(parts: Column) -> Column:
    """Of ``exact_parts``: an array of (place, limb), signed; place 0 holds the last nine digits before the point."""
    whole, fraction = parts["size"]["whole"], parts["size"]["fraction"]
    before, behind = (F.ceil(F.length(c) / DIGITS).cast("int") for c in (whole, fraction))
    digits = F.concat(F.lpad(whole, before * DIGITS, "0"), F.rpad(fraction, behind * DIGITS, "0"))
    sign = F.when(parts["negative"], F.lit(-1)).otherwise(F.lit(1))
    places = F.when(before + behind > 0, F.sequence(F.lit(0), before + behind - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        places,
        lambda k: F.struct(
            (before - 1 - k).alias("place"), (sign * F.substring(digits, k * DIGITS + 1, F.lit(DIGITS)).cast("long")).alias("limb")
        ),
    )


def exact_sums(sol: Solutions, by: Iterable[str], name: str) -> DataFrame:
    """Per group: ``n``, ``sum`` and ``sum_dt`` (the promoted type), ``avg`` and ``avg_dt``.

    Integers and decimals are added exactly, whatever their length; an average has 18
    places more than the values, cut off.  With a float among them it is a sum of doubles.  A group without
    values has the sum 0; one with a value that isn\'t a number has none of them.
    """
    by = list(by)
    text, dt, number = F.col(name), F.col(aux(name, "dt")), F.col(aux(name, "num"))
    exact = number.isNotNull() & dt.isin(*V.EXACT_TYPES)
    given = sol.df.select(
        *by,
        F.when(exact, exact_parts(text, dt)).alias("parts__"),
        number.alias("number__"),
        text.isNotNull().alias("bound__"),
        exact.alias("exact__"),
        (number.isNotNull() & dt.isin(*V.INTEGER_TYPES)).alias("whole__"),
    )
    size = F.col("parts__.size")
    before, behind = (F.length(size[c]) for c in ("whole", "fraction"))
    short = (before <= WHOLE * DIGITS) & (behind <= FRACTION * DIGITS)
    given = given.select(
        *by, "number__", "bound__", "exact__", "whole__",
        F.when(~short, limbs(F.col("parts__"))).alias("limbs__"),
        F.when(short, F.concat(F.lpad(size["whole"], WHOLE * DIGITS, "0"), F.rpad(size["fraction"], FRACTION * DIGITS, "0"))).alias("digits__"),
        F.when(F.col("parts__.negative"), F.lit(-1).cast("long")).otherwise(F.lit(1).cast("long")).alias("sign__"),
        F.when(short, F.ceil(before / DIGITS).cast("int")).alias("before__"),
        F.when(short, F.ceil(behind / DIGITS).cast("int")).alias("behind__"),
    )
    places = range(-FRACTION, WHOLE)
    fixed = {k: f"place{k + FRACTION}__" for k in places}
    given = given.withColumns(
        {c: F.col("sign__") * F.substring("digits__", (WHOLE - 1 - k) * DIGITS + 1, DIGITS).cast("long") for k, c in fixed.items()}
    )
    own = ["before__", "behind__", *fixed.values()]
    rows = given.select(*by, "number__", "bound__", "exact__", "whole__", *own, F.posexplode_outer("limbs__").alias("at__", "limb__"))
    first = F.coalesce(F.col("at__"), F.lit(0)) == 0
    counts = {
        "n": F.count_if(first & F.col("bound__")),
        "numbers__": F.count_if(first & F.col("number__").isNotNull()),
        "exacts__": F.count_if(first & F.col("exact__")),
        "wholes__": F.count_if(first & F.col("whole__")),
        "double__": F.sum(F.when(first, F.col("number__"))),
    }
    placed = rows.groupBy(*by, F.col("limb__.place").alias("place__")).agg(
        _added(F.col("limb__.limb")).alias("total__"),
        *[c.alias(k) for k, c in counts.items()],
        *[F.max(c).alias(c) for c in ("before__", "behind__")],
        *[_added(F.col(c)).alias(c) for c in fixed.values()],
    )
    held = F.collect_list(F.when(F.col("place__").isNotNull(), F.struct("place__", "total__"))).alias("held__")
    sums = [F.sum(k).alias(k) for k in (*counts, *fixed.values())]
    found = placed.groupBy(*by).agg(held, *sums, *[F.max(c).alias(c) for c in ("before__", "behind__")])
    found = found.withColumns({k: F.coalesce(k, F.lit(0)) for k in counts if k != "double__"})
    found = found.withColumn("low__", F.least(F.lit(0), -F.col("behind__"), F.array_min(F.transform("held__", lambda x: x["place__"]))))
    found = found.withColumn("high__", F.greatest(F.lit(0), F.col("before__") - 1, F.array_max(F.transform("held__", lambda x: x["place__"]))))
    found = found.withColumn("fixed__", F.array(*[F.coalesce(F.col(c).cast(_WIDE), F.lit(0).cast(_WIDE)) for c in fixed.values()]))
    of_rows = f"coalesce(try_element_at(map_from_entries(held__), p), cast(0 as {_WIDE}))"
    of_columns = f"coalesce(get(fixed__, p + {FRACTION}), cast(0 as {_WIDE}))"
    found = found.withColumn("dense__", F.expr(f"transform(sequence(low__, high__), p -> cast({of_rows} + {of_columns} as {_WIDE}))"))
    found = found.withColumn("negative__", F.expr(f"({_carried('dense__')}).carry < 0"))
    found = found.withColumn("dense__", F.expr("if(negative__, transform(dense__, x -> -x), dense__)"))
    found = found.withColumn("up__", F.expr(_carried("dense__")))
    # digits from the top: what was carried out, then limb by limb
    found = found.withColumn("top__", F.expr("concat(array(up__.carry), reverse(up__.out))"))
    total = _number("top__", F.col("low__"))
    found = found.withColumn("quotient__", F.expr(_divided("top__", "n")))
    average = _number("quotient__", F.col("low__") - AVERAGE_LIMBS)
    all_exact, all_whole = F.col("exacts__") == F.col("numbers__"), F.col("wholes__") == F.col("numbers__")
    fine = F.col("numbers__") == F.col("n")
    kind = F.when(all_whole, V.XSD_INTEGER).when(all_exact, V.XSD_DECIMAL).otherwise(V.XSD_DOUBLE)
    zero = F.col("n") == 0
    return found.select(
        *by, "n",
        F.when(fine, F.when(all_exact, total).otherwise(F.col("double__").cast("string"))).alias("sum"),
        F.when(fine, kind).alias("sum_dt"),
        F.when(fine, F.when(zero, F.lit("0")).when(all_exact, average).otherwise((F.col("double__") / F.col("n")).cast("string"))).alias("avg"),
        F.when(fine, F.when(zero, V.XSD_INTEGER).when(all_exact, V.XSD_DECIMAL).otherwise(V.XSD_DOUBLE)).alias("avg_dt"),
    )


def _added(limb: Column) -> Column:
    """The sum of limbs, in halves of 64 bits."""
    rest = limb % HALF
    high, low = F.sum(F.call_function("div", limb - rest, F.lit(HALF))), F.sum(rest)
    return (high.cast("decimal(28,0)") * HALF + low).cast(_WIDE)


def _carried(column: str) -> str:
    """Limbs from the lowest place on with the carries done: (carry, out); the carry is negative as the number is."""
    x = f"cast(acc.carry + x as {_WIDE})"
    rest = f"cast(pmod({x}, cast({BASE} as {_WIDE})) as {_WIDE})"
    return (
        f"aggregate({column}, named_struct(\'carry\', cast(0 as {_WIDE}), \'out\', cast(array() as array<{_WIDE}>)), "
        f"(acc, x) -> named_struct(\'carry\', cast(({x} - {rest}) div cast({BASE} as {_WIDE}) as {_WIDE}), \'out\', concat(acc.out, array({rest}))))"
    )


def _divided(column: str, by: str) -> str:
    """Limbs from the top divided by a count, with further limbs behind; the remainder is left out."""
    n = f"cast(greatest({by}, 1) as {_WIDE})"
    x = f"cast(acc.rest * {BASE} + x as {_WIDE})"
    more = ", ".join([f"cast(0 as {_WIDE})"] * AVERAGE_LIMBS)
    return (
        f"aggregate(concat({column}, array({more})), named_struct(\'rest\', cast(0 as {_WIDE}), \'out\', cast(array() as array<{_WIDE}>)), "
        f"(acc, x) -> named_struct(\'rest\', cast({x} % {n} as {_WIDE}), \'out\', concat(acc.out, array(cast({x} div {n} as {_WIDE})))), acc -> acc.out)"
    )


def _number(column: str, low: Column) -> Column:
    """Limbs from the top, the last one of place ``low`` (0 or less), as a text with the sign of the group."""
    behind = -low
    count = F.size(column)
    text = lambda c: F.array_join(F.transform(c, lambda x: F.lpad(x.cast("string"), DIGITS, "0")), "")
    head = F.concat(F.get(column, F.lit(0)).cast("string"), text(F.slice(column, F.lit(2), count - 1 - behind)))
    whole = F.regexp_replace(head, "^0+(?=[0-9])", "")
    fraction = F.regexp_replace(F.when(behind > 0, text(F.slice(column, count - behind + 1, F.greatest(behind, F.lit(1))))).otherwise(""), "0+$", "")
    digits = F.when(fraction == "", whole).otherwise(F.concat(whole, F.lit("."), fraction))
    return F.when(F.col("negative__") & (digits != "0"), F.concat(F.lit("-"), digits)).otherwise(digits)
