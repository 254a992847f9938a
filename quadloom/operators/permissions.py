"""Graph permissions as a table ``(g, role, capability)``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.model import graph_iri
from quadloom.operators.scan import Quads, frame

READ, UPDATE, EXECUTE = "READ", "UPDATE", "EXECUTE"
PERMISSION_SCHEMA = "g string, role string, capability string"


def permissions(spark: SparkSession, rows: Iterable[tuple] | None = None) -> DataFrame:
    """A permission table from ``(graph, role, capability)`` rows; none is the empty set."""
    data = [(graph_iri(g), role, capability.upper()) for g, role, capability in rows or ()]
    bad = {c for _, _, c in data} - {READ, UPDATE, EXECUTE}
    if bad:
        raise ValueError(f"unknown capabilities: {sorted(bad)}")
    return spark.createDataFrame(data, PERMISSION_SCHEMA)


def granted(perms: DataFrame, roles: Iterable[str], capability: str) -> DataFrame:
    """Distinct graphs ``(granted_g)`` one of the roles may use."""
    ok = (F.col("capability") == capability) & F.col("role").isin(list(roles))
    return perms.where(ok).select(F.col("g").alias("granted_g")).distinct()


def visible(q: Quads, perms: DataFrame, roles: Iterable[str]) -> DataFrame:
    """Quads in graphs one of the roles may read."""
    return frame(q).join(granted(perms, roles, READ), F.col("g") == F.col("granted_g"), "left_semi")


def grant(perms: DataFrame, change: DataFrame, grants: Iterable[tuple]) -> DataFrame:
    """Permission table after writing ``change`` with ``(role, capability)`` grants on its graphs."""
    rows = [(role, capability.upper()) for role, capability in grants]
    if not rows:
        return perms
    pairs = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(c).alias("capability")) for r, c in rows])
    new = change.select("g").distinct().select("g", F.inline(pairs))
    return perms.unionByName(new).distinct()


def denied_graphs(change: DataFrame, perms: DataFrame, roles: Iterable[str]) -> DataFrame:
    """Graphs of a change the roles may not update."""
    graphs = change.select("g").distinct()
    return graphs.join(granted(perms, roles, UPDATE), F.col("g") == F.col("granted_g"), "left_anti")


def check_write(change: DataFrame, perms: DataFrame, roles: Iterable[str]) -> None:
    """Raise unless every graph of the change may be updated."""
    first = denied_graphs(change, perms, roles).first()
    if first is not None:
        raise PermissionError(f"no update permission on graph {first['g']}")
