"""Groups of names that are equivalent, one representative for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.session import materialize, scratch_path


def equivalence_groups(pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(name, rep) for every name that is linked to another one; ``rep`` is the smallest name of its group.

    ``pairs`` are links (a, b), within each ``by``.  In a round every name points to its
    smallest neighbour, if that is smaller; the pointers are doubled until they reach names
    that have no smaller neighbour, and the links move to these.  At most half of the names
    stay in a round, so a chain of any length takes a logarithmic number of jobs.
    """
    spark = pairs.sparkSession
    root = scratch_path(spark, "groups")
    written = 0

    def keep(df: DataFrame) -> DataFrame:
        nonlocal written
        written += 1
        return materialize(df, f"{root}/{written}")

    def led(rows: DataFrame, column: str, pointers: DataFrame) -> DataFrame:
        """``column`` replaced by what it points to, if it points anywhere."""
        to = pointers.select(*[F.col(b).alias(f"_{b}") for b in by], F.col("name").alias("_name"), F.col("rep").alias("_rep"))
        on = F.col(column) == F.col("_name")
        for b in by:
            on = on & (F.col(b) == F.col(f"_{b}"))
        out = rows.join(to, on, "left").withColumn(column, F.coalesce("_rep", column))
        return out.drop("_name", "_rep", *[f"_{b}" for b in by])

    left = keep(pairs.where("a <> b").select(*by, "a", "b").distinct())
    found: DataFrame | None = None
    while not left.isEmpty():
        both = left.union(left.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(*by, "a").agg(F.min("b").alias("b"))
        pointers = keep(near.select(*by, F.col("a").alias("name"), F.least("a", "b").alias("rep")))
        while True:
            twice = keep(led(pointers.withColumn("before", F.col("rep")), "rep", pointers))
            moved = not twice.where("rep <> before").isEmpty()
            pointers = twice.drop("before")
            if not moved:
                break
        left = keep(led(led(left, "a", pointers), "b", pointers).where("a <> b").select(*by, "a", "b").distinct())
        found = pointers if found is None else keep(led(found, "rep", pointers))
    if found is None:
        return left.select(*by, F.col("a").alias("name"), F.col("b").alias("rep"))
    return found.select(*by, "name", "rep")
