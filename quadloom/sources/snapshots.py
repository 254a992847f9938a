"""Stored quads: one folder of plain Parquet per write.

    <path>/batch=B/op=O/ph=H/    O: add, doc, del (keys), clear, drop or graph (names of graphs)
                                 H: two hex digits of the md5 of the predicate

Every write has its own folder and overwrites nothing else, so any number of
writers may add at the same time, and a stream batch that is delivered again
replaces its own folder.  Each row carries ``seq``, by default the time of its
write in microseconds.  A quad is live when no removal of its key and no clearing
of its graph has a higher ``seq``; at equal ``seq`` additions win.  The order of
folders therefore doesn't matter.  There are no older versions to read: who needs a
state again writes ``read()`` to a place of its own.

Each write is a set.  What several writes repeat is merged when it is read; a
store of one write without removals is read without any shuffle.  Rows lie sorted
by predicate and subject, so that row groups are skipped by their minima and
maxima; ``read(predicates=...)`` opens the folders of these predicates only.

A write is one Spark job; a reader that lists the files while that job publishes
them may see part of it.  Removals by writers on several machines are ordered as
their clocks are.

Which documents give a quad is kept as rows of their own (``op=doc``: key and
doc_id), so no write and no merge forgets one; ``members`` reads them.

Further copies of the rows may lie beside the store, in ``<path>-by-s`` and
``<path>-by-o``, where H comes from the subject or the object and rows lie sorted by
it: ``quads`` then opens one folder for a constant subject or object, and for a
constant predicate one folder of the store itself.  Copies are written before the
store's own rows.  Rows that go to several orders are held in a table first, which is
removed at the end; each order is written in parts that bound what lies in shuffle
files, into a folder that readers don't see until it is renamed.

Which graphs have which predicates may be kept in ``<path>-predicates``, written before
the quads, so a pattern knows where merging graphs can't remove anything.

Permissions lie beside the quads, in ``<path>-permissions``, one folder per write
as well.  A store that is opened with ``roles`` refuses every write that touches a
graph with permissions of which none lets these roles update; a graph without any
is free.  Graphs that a write adds to get its grants, or those of the store, before
its quads are written; grants of a write that fails guard graphs without quads.
"""

from __future__ import annotations

import hashlib
import re
import threading
import time
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.model import QUAD_COLUMNS, QUAD_KEY, QUAD_SCHEMA, empty_quads, graph_iri, graph_list, same
from quadloom.operators import permissions as access
from quadloom.operators.forms import instantiate
from quadloom.operators.membership import MEMBER, members_of
from quadloom.operators.solutions import Solutions
from quadloom.operators.updates import Store, distinct_quads, hash_repeats, in_contexts, matches, merged_sets
from quadloom.session import materialize, released, removed, renamed, scratch_path
from quadloom.sources.stored import StoredQuads

ADD, DOC, DEL, CLEAR, DROP, GRAPH = "add", "doc", "del", "clear", "drop", "graph"
COPIES = ("s", "o")
# The rows of a folder are dealt to this many shares at first; small ones share a task and a file.
SHARES = 32
# Rows for several orders that are shuffled at once, and hashes of repeated ones that are sent to all tasks.
SHUFFLED, REPEATS = 16_000_000, 1_000_000
_ROW_SCHEMA = f"{QUAD_SCHEMA}, seq long, batch string, op string, ph string"
_FOLDER = re.compile(r"/batch=([^/]+)/op=([^/]+)/")

_clock = threading.Lock()
_last = 0


def next_seq() -> int:
    """The time in microseconds, higher than any value given before in this process."""
    global _last
    with _clock:
        _last = max(_last + 1, time.time_ns() // 1000)
        return _last


def stream_batch(stream: str, batch: int) -> str:
    """The folder name of a batch of a stream, the same whenever it is delivered."""
    return f"{hashlib.md5(stream.encode()).hexdigest()}-{batch}"


def _ops(rows: DataFrame) -> list[str]:
    """The kind of each folder, from the names of the files, which the scan lists anyway."""
    folders = {m.groups() for f in rows.inputFiles() if (m := _FOLDER.search(f))}
    return [op for _, op in folders]


class SnapshotStore:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        roles: Iterable[str] | None = None,
        grants: Iterable[tuple] = (),
        copies: Iterable[str] = (),
        catalogue: bool = False,
    ):
        """``roles`` limit what may be written; ``grants`` are (role, capability) for graphs that are written.

        ``copies`` are the further orders, "s" and "o", and ``catalogue`` says whether it is
        kept which graphs have which predicates; both the same for all writes of a store.
        """
        self.spark, self.path = spark, path.rstrip("/")
        self.copies, self.catalogued = tuple(copies), catalogue
        if not set(self.copies) <= set(COPIES):
            raise ValueError(f"copies are {COPIES}: {self.copies}")
        self.roles = None if roles is None else list(roles)
        self.grants = list(grants)

    # -- reading -----------------------------------------------------------------

    def _rows(self, copy: str | None = None) -> DataFrame | None:
        try:
            return self.spark.read.schema(_ROW_SCHEMA).parquet(self._place(copy))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _place(self, copy: str | None = None) -> str:
        return self.path if copy is None else f"{self.path}-by-{copy}"

    def read(
        self, predicates: Iterable[str] | None = None, copy: str | None = None, keys: Iterable[str] | None = None
    ) -> DataFrame:
        """The live quads.

        ``predicates`` opens the folders of these only; with ``copy`` ("s" or "o") the
        ``keys`` are subjects or objects (IRIs or lexical forms) instead.
        """
        rows = self._rows(copy)
        if rows is None:
            return empty_quads(self.spark)
        slot, names = ("p", predicates) if copy is None else (copy, keys)
        ops = _ops(rows)
        live = self._live(rows, ADD, set(ops), slot, names)
        if ops.count(ADD) > 1:
            return merged_sets(live)
        return live.select(*QUAD_COLUMNS)

    def _live(self, rows: DataFrame, op: str, ops: set[str], slot: str = "p", names: Iterable[str] | None = None) -> DataFrame:
        """Rows of one kind that nothing later removes; of some keys only, if they are named."""
        live, dels = (rows.where(F.col("op") == o) for o in (op, DEL))
        if names is not None:
            names = list(names)
            digits = sorted({hashlib.md5(n.encode()).hexdigest()[:2] for n in names})
            chosen = F.col("ph").isin(digits) & F.col(slot).isin(names)
            live, dels = live.where(chosen), dels.where(chosen)
        if ops & {CLEAR, DROP}:
            gone = rows.where(F.col("op").isin(CLEAR, DROP))
            gone = gone.groupBy(F.col("g").alias("cg")).agg(F.max("seq").alias("cseq"))
            live = live.join(gone, (F.col("g") == F.col("cg")) & (F.col("seq") < F.col("cseq")), "left_anti")
        if DEL in ops:
            gone = dels.groupBy(*[F.col(c).alias(c) for c in QUAD_KEY]).agg(F.max("seq").alias("dseq"))
            live = live.join(gone, same(live, gone, QUAD_KEY) & (live["seq"] < gone["dseq"]), "left_anti")
        return live

    def members(self) -> DataFrame:
        """Which documents give the live quads: (quad key, doc_id)."""
        rows = self._rows()
        if rows is None:
            return members_of(empty_quads(self.spark))
        return members_of(self._live(rows, DOC, set(_ops(rows))))

    def quads(self) -> StoredQuads:
        """The live quads for patterns and scans, which open only the folders of their constants."""
        return StoredQuads(self.read, self.copies, self.catalogue if self.catalogued else None)

    def catalogue(self) -> DataFrame:
        """(p, g): the graphs that have had quads of a predicate."""
        try:
            return self.spark.read.schema("p string, g string").parquet(f"{self.path}-predicates").distinct()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], "p string, g string")
            raise

    def registered(self) -> DataFrame:
        """Graphs that were created and not dropped since (column ``g``)."""
        rows = self._rows()
        if rows is None:
            return self.spark.createDataFrame([], "g string")
        last = rows.where(F.col("op").isin(GRAPH, DROP)).groupBy("g").agg(F.max_by("op", "seq").alias("op"))
        return last.where(F.col("op") == GRAPH).select("g")

    def store(self) -> Store:
        """The stored quads as an in-plan state for ``operators.updates``."""
        return Store(self.read(), registered=self.registered())

    # -- permissions -------------------------------------------------------------

    def permissions(self) -> DataFrame:
        """All grants: (g, role, capability), each once."""
        try:
            rows = self.spark.read.schema(access.PERMISSION_SCHEMA).parquet(f"{self.path}-permissions")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return access.permissions(self.spark)
            raise
        return rows.select("g", "role", "capability").distinct()

    def visible(self) -> DataFrame:
        """The live quads in graphs that the store's roles may read."""
        return access.visible(self.read(), self.permissions(), self.roles or ())

    def grant(self, perms: DataFrame, batch: str | None = None) -> None:
        """Keep further permissions (g, role, capability)."""
        target = f"{self.path}-permissions/batch={batch or uuid.uuid4().hex}"
        perms.select("g", "role", "capability").distinct().write.mode("overwrite").parquet(target)

    def _check(self, *changes: DataFrame | None) -> None:
        """Raise unless the roles may update all graphs of a change that have permissions."""
        if self.roles is None:
            return
        perms = self.permissions()
        for change in changes:
            if change is not None:
                guarded = change.select("g").join(perms.select("g").distinct(), "g", "left_semi")
                access.check_write(guarded, perms, self.roles)

    # -- writing -----------------------------------------------------------------

    def write(
        self,
        adds: DataFrame | None = None,
        dels: DataFrame | None = None,
        clear: DataFrame | None = None,
        batch: str | None = None,
        op: str = CLEAR,
        grants: Iterable[tuple] | None = None,
        docs: DataFrame | None = None,
        parts: int | None = None,
        steps: int = 1,
    ) -> int:
        """Clear graphs, remove keys, then add, as one folder.  Returns its ``seq``.

        ``adds`` must be a set; ``docs`` says which documents give its quads (quad key,
        doc_id).  A column ``seq`` of ``adds``, ``dels`` or ``docs`` counts instead of the time.  ``clear`` holds names of graphs (column ``g``);
        ``op`` says what happens to them.  ``batch`` names the folder, a new one by
        default; with ``parts`` there are that many, each with a share of the quads'
        hash, written by one job and replacing what they held.  ``steps`` is in how many jobs each order is written.  ``grants`` are (role, capability) for the graphs of ``adds``, by
        default those of the store.
        """
        self._check(adds, dels, clear)
        seq = next_seq()
        found = []
        kinds = ((ADD, adds, QUAD_COLUMNS), (DOC, docs, MEMBER), (DEL, dels, QUAD_KEY), (op, clear, ("g",)))
        for name, df, columns in kinds:
            if df is None:
                continue
            own = F.col("seq").cast("long") if "seq" in df.columns else F.lit(seq)
            rows = df.select(*columns, own.alias("seq"))
            if name != ADD:
                rows = rows.groupBy(*columns).agg(F.max("seq").alias("seq"))
            found.append(rows.withColumn("op", F.lit(name)))
        if not found:
            return seq
        batch = batch or uuid.uuid4().hex
        given = self.grants if grants is None else list(grants)
        if adds is not None and given:
            self.grant(access.grant(access.permissions(self.spark), adds, given), batch)
        if adds is not None and self.catalogued:
            adds.select("p", "g").distinct().write.mode("overwrite").parquet(f"{self.path}-predicates/batch={batch}")
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
        for copy in (*self.copies, None):
            some = rows if copy is None else rows.where(F.col("op") != DOC)
            self._write_rows(some, copy or "p", self._place(copy), batch, parts, steps)
        return seq

    @staticmethod
    def _write_rows(rows: DataFrame, slot: str, place: str, batch: str, parts: int | None, steps: int) -> None:
        digits = F.coalesce(F.substring(F.md5(F.col(slot)), 1, 2), F.lit("-")) if slot in rows.columns else F.lit("-")
        # rebalance: few files per folder, and a hot key is split over tasks; shares, because what one task has read can't be split
        key = [c for c in QUAD_KEY if c in rows.columns]
        rows = rows.withColumns({"ph": digits, "share__": F.pmod(F.xxhash64(*key, F.lit(SHARES)), F.lit(SHARES))})
        folders = ["op", "ph"]
        if parts is not None:
            rows = rows.withColumn("batch", F.concat(F.lit(f"{batch}-"), F.pmod(F.xxhash64(*key), F.lit(parts)).cast("string")))
            # a part is small and stays in one task
            folders = ["batch", *folders]

        def write(some: DataFrame, mode: str, target: str) -> None:
            dealt = some.drop("share__").hint("rebalance", "batch") if parts is not None else some.hint("rebalance", "op", "ph", "share__").drop("share__")
            order = [c for c in (*folders, slot, "s", "p") if c in dealt.columns]
            writer = dealt.sortWithinPartitions(*dict.fromkeys(order)).write.mode(mode).partitionBy(*folders)
            writer = writer.option("compression", "zstd")
            (writer if parts is None else writer.option("partitionOverwriteMode", "dynamic")).parquet(target)

        if parts is not None:
            write(rows, "overwrite", place)
        elif steps == 1:
            write(rows, "overwrite", f"{place}/batch={batch}")
        else:
            # some shares after the others, in a folder that readers pass over
            hidden, step = f"{place}/_{uuid.uuid4().hex}", F.floor(F.col("share__") * F.lit(steps) / F.lit(SHARES))
            for k in range(steps):
                write(rows.where(step == k), "append", hidden)
            renamed(rows.sparkSession, hidden, f"{place}/batch={batch}")

    def _graphs(self, names: Iterable[str]) -> DataFrame:
        return self.spark.createDataFrame([(g,) for g in sorted(set(names))], "g string")

    def add(
        self,
        new: DataFrame,
        contexts: Iterable = (),
        batch: str | None = None,
        grants: Iterable[tuple] | None = None,
        parts: int | None = None,
    ) -> int:
        """Set union; writes nothing but the new rows and reads no stored ones."""
        new = in_contexts(new, contexts)
        if not self.copies or parts is not None:
            return self.write(adds=distinct_quads(new), docs=members_of(new), batch=batch, grants=grants, parts=parts)
        # rows for several orders are made and merged once
        held = [scratch_path(self.spark, label) for label in ("rows", "hashes", "repeats")]
        try:
            with released(self.spark):
                rows = materialize(new, held[0])
                n = rows.count()
                adds = self._merged(rows, n, *held[1:])
                steps = max(1, min(SHARES, -(-n // SHUFFLED)))
                return self.write(adds=adds, docs=members_of(rows), batch=batch, grants=grants, steps=steps)
        finally:
            for path in held:
                removed(self.spark, path)

    @staticmethod
    def _merged(rows: DataFrame, n: int, hashes: str, repeats: str) -> DataFrame:
        """The set of these ``n`` rows: only those whose hash another one has, too, are compared, where they are few."""
        found = materialize(hash_repeats(rows, -(-n // SHUFFLED)), hashes)
        some = found.count()
        if not some:
            return rows
        if some > REPEATS:
            return materialize(distinct_quads(rows), repeats)
        hashed = rows.withColumn("own__", F.xxhash64(*QUAD_KEY))
        found = F.broadcast(found)
        again = hashed.join(found, F.col("own__") == F.col("hash__"), "left_semi").select(*QUAD_COLUMNS)
        alone = hashed.join(found, F.col("own__") == F.col("hash__"), "left_anti").select(*QUAD_COLUMNS)
        return alone.union(materialize(distinct_quads(again), repeats))

    def remove_statements(self, gone: DataFrame, contexts: Iterable = ()) -> int:
        """Remove given quads from their own graph or from ``contexts``."""
        return self.write(dels=in_contexts(gone, contexts))

    def remove(self, s=None, p=None, o=None, contexts: Iterable = ()) -> int:
        """Remove by pattern; no contexts removes from every graph."""
        return self.write(dels=self.read().where(matches(s, p, o, contexts)))

    def modify(self, where: Solutions, delete=(), insert=(), graph=None, base: str | None = None) -> int:
        """DELETE/INSERT WHERE: writes the removed keys and the added quads only."""
        return self.write(
            adds=distinct_quads(instantiate(where, insert, graph, base)) if insert else None,
            dels=instantiate(where, delete, graph, base) if delete else None,
        )

    def replace(self, quads: DataFrame) -> int:
        """A whole new content."""
        return self.write(adds=distinct_quads(quads), docs=members_of(quads), clear=self.read().select("g"))

    # -- graphs ------------------------------------------------------------------

    def clear(self, contexts: Iterable | None = None) -> int:
        """Clear everything, or the listed graphs; one row per graph is written."""
        if contexts is None:
            return self.write(clear=self.read().select("g"))
        graphs = graph_list(contexts) or [V.DEFAULT_GRAPH]
        self.store().clear(graphs)  # raises for a graph that doesn't exist
        return self.write(clear=self._graphs(graphs))

    def create_graph(self, graph) -> int:
        self.store().create_graph(graph)  # raises if it exists
        return self.write(clear=self._graphs([graph_iri(graph)]), op=GRAPH)

    def drop_graph(self, graph) -> int:
        self.store().drop_graph(graph)  # raises if it doesn't exist
        return self.write(clear=self._graphs([graph_iri(graph)]), op=DROP)

    def _content(self, source, target) -> DataFrame:
        state = self.store()
        if not state.graph_exists(source):
            state.drop_graph(source)  # raises
        return state.quads.where(F.col("g") == graph_iri(source)).withColumn("g", F.lit(graph_iri(target)))

    def add_graph(self, source, target) -> int:
        """ADD source TO target: writes the copied quads."""
        return self.write(adds=self._content(source, target))

    def copy_graph(self, source, target) -> int:
        """COPY source TO target: the target becomes the source's content."""
        content = self._content(source, target)
        if graph_iri(source) == graph_iri(target):
            return self.write()
        return self.write(adds=content, clear=self._graphs([graph_iri(target)]))

    def move_graph(self, source, target) -> int:
        """MOVE source TO target."""
        content = self._content(source, target)
        a, b = graph_iri(source), graph_iri(target)
        if a == b:
            return self.write()
        return self.write(adds=content, clear=self._graphs([a, b]), op=DROP)
