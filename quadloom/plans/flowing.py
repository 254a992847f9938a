"""Registered queries: buffered writes as streams over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.quad_columns import with_values
from quadloom.plans.mapping import G, P, SCHEMAS
from quadloom.plans.registry import query
from quadloom.session import scratch_path
from quadloom.sources.snapshots import SnapshotStore
from quadloom.streaming.buffered import DELETE, INSERT, BufferOptions, change_stream, insert_stream


def _events(spark, sf_dir, options: BufferOptions = BufferOptions()) -> DataFrame:
    reader = spark.readStream.schema(SCHEMAS["events"]).options(**options.source_options())
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _quad(df: DataFrame, s, p, o, kind, dt=None, *more) -> DataFrame:
    rows = df.select(
        F.lit(G + "events").alias("g"),
        s.alias("s"),
        p.alias("p"),
        o.alias("o"),
        F.lit(kind).alias("o_kind"),
        F.lit(dt).cast("string").alias("o_dt"),
        F.lit(None).cast("string").alias("o_lang"),
        F.lit(None).cast("string").alias("doc_id"),
        *more,
    )
    return rows


def _user(df):
    return F.concat(F.lit("urn:user:"), F.col("user_id").cast("string"))


@query("""
select distinct 'urn:user:' || user_id as s, 'urn:p:did' as p, event_type as o from events
""")
def stream_insert_dedup(spark, sf_dir):
    """What every user did: many events give the same quad, which is stored once."""
    events = _events(spark, sf_dir)
    stream = with_values(_quad(events, _user(events), F.lit(P + "did"), F.col("event_type"), "lit", V.XSD_STRING))
    store = SnapshotStore(spark, scratch_path(spark, "events"))
    run = insert_stream(stream, store, scratch_path(spark, "offsets"))
    run.awaitTermination()
    return store.read().select("s", "p", "o")


@query("""
select 'urn:user:' || user_id as s, event_type as o from (
  select user_id, event_type, arg_max(value, event_id) as last_value from events group by user_id, event_type)
where last_value >= 10
""")
def stream_insert_delete(spark, sf_dir):
    """Each event sets or clears a quad; the last one counts."""
    events = _events(spark, sf_dir)
    op = F.when(F.col("value") >= 10, F.lit(INSERT)).otherwise(F.lit(DELETE)).alias("op")
    stream = _quad(
        events, _user(events), F.lit(P + "does"), F.col("event_type"), "lit", V.XSD_STRING,
        op, F.col("event_id").alias("seq"),
    )
    store = SnapshotStore(spark, scratch_path(spark, "events"))
    run = change_stream(stream, store, scratch_path(spark, "offsets"))
    run.awaitTermination()
    return store.read().select("s", "o")


@query("""
select 'urn:event:' || event_id as s, 'urn:p:value' as p, value as num from events
union all select 'urn:event:' || event_id, 'urn:p:kept', 1.0 from events
""")
def stream_into_existing(spark, sf_dir):
    """A store that holds some of the stream's quads, and others, already; a second run over the same events adds nothing."""
    events = _events(spark, sf_dir)
    subject = F.concat(F.lit("urn:event:"), F.col("event_id").cast("string"))
    stream = with_values(
        _quad(events, subject, F.lit(P + "value"), F.col("value").cast("string"), "lit", V.XSD_DOUBLE)
    )
    store = SnapshotStore(spark, scratch_path(spark, "events"))
    batch = spark.read.schema(SCHEMAS["events"]).parquet(f"{sf_dir}/events.parquet")
    held = _quad(batch.where("value >= 10"), subject, F.lit(P + "value"), F.col("value").cast("string"), "lit", V.XSD_DOUBLE)
    kept = _quad(batch, subject, F.lit(P + "kept"), F.lit("1"), "lit", V.XSD_INTEGER)
    store.add(with_values(held.union(kept)))
    for _ in range(2):
        insert_stream(stream, store, scratch_path(spark, "offsets")).awaitTermination()
    return store.read().select("s", "p", F.col("o_num").alias("num"))
