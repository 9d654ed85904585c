"""STR2, STR3: bounded intake and timed, idempotent batch sink.

``call_stream`` reads new call files with ``maxFilesPerTrigger`` so one
micro-batch takes a bounded slice (the reference caps its queue and drains at
most 100 per request). ``batch_sink`` is a ``foreachBatch`` function that
builds the request bodies of a micro-batch and writes them under a folder named
by the batch id, in overwrite mode: a replayed micro-batch rewrites the same
folder, so the output stays exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.batching import FLUSH_INTERVAL, MAX_BATCH, batch_assign, batch_bodies, batch_keys
from eventloom.operators.context import attach_context, device_contexts
from eventloom.operators.envelope import build_events, envelope
from eventloom.schemas import ATTEMPTS_SCHEMA, CALLS_SCHEMA
from eventloom.streaming.identity_state import identity_stream


def call_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """STR3: a stream of call-log parquet files with bounded intake."""
    return spark.readStream.schema(CALLS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def answer_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of attempt-log parquet files. All new ones are read at once, so
    that no call overtakes the answer that disables it."""
    return spark.readStream.schema(ATTEMPTS_SCHEMA).parquet(path)


def batch_sink(out_dir: str, late_dir: str | None = None, contexts: DataFrame | None = None, key: str = "device_id", interval: str = FLUSH_INTERVAL, max_batch: int = MAX_BATCH) -> Callable[[DataFrame, int], None]:
    """STR2: ``foreachBatch`` writer of request bodies, one folder per batch id.

    With ``late_dir`` the micro-batch is identity rows (:func:`identity_stream`):
    rows that came after a later one of their device are written there as JSON,
    the others become events. ``contexts`` (``device_id, context``, one row per
    device) is attached to every event. The micro-batch is kept while it is used, so the
    stateful step runs once."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            if late_dir:
                late = rows.filter(F.col("late")).select(*CALLS_SCHEMA.fieldNames())
                late.write.mode("overwrite").json(f"{late_dir}/batch_id={batch_id}")
                _write_bodies(build_events(rows.filter(~F.col("late"))), batch_id)
            else:
                _write_bodies(rows, batch_id)
        finally:
            rows.unpersist()

    def _write_bodies(events: DataFrame, batch_id: int) -> None:
        if contexts is not None:
            events = attach_context(events, contexts)
        batched = batch_assign(events, key=key, interval=interval, max_batch=max_batch)
        bodies = batch_bodies(batched, envelope(batched), batch_keys(key))
        bodies.select("body").write.mode("overwrite").text(f"{out_dir}/batch_id={batch_id}")

    return write


def enriched_stream(calls: DataFrame) -> DataFrame:
    """STR1 + envelopes: enriched events from a call stream."""
    return build_events(identity_stream(calls).filter(~F.col("late")))


def snapshot_sink(path: str) -> Callable[[DataFrame, int], None]:
    """IDN4 on a stream: ``foreachBatch`` writer of the latest identity per
    device. Each micro-batch merges its rows with the previous snapshot version
    (``max_by`` on ``seq``, a partial aggregate) and writes version
    ``batch_id`` in overwrite mode, so a replayed batch rewrites the same
    version; readers take the highest complete version."""
    from eventloom.operators.identity import identity_snapshot

    def write(ident: DataFrame, batch_id: int) -> None:
        spark = ident.sparkSession
        latest = identity_snapshot(ident.filter(~F.col("late")) if "late" in ident.columns else ident)
        versions = [v for v in written_versions(spark, path) if v < batch_id]
        if versions:
            prev = spark.read.parquet(f"{path}/version={max(versions)}")
            latest = _newest(prev.unionByName(latest))
        latest.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return write


def written_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete snapshot versions under ``path``, on any Hadoop file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath() for s in fs.listStatus(folder)]
    done = [p for p in names if p.getName().startswith("version=") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done)


def _newest(snapshots: DataFrame) -> DataFrame:
    cols = [c for c in snapshots.columns if c not in ("write_key", "device_id")]
    g = snapshots.groupBy("write_key", "device_id").agg(F.max_by(F.struct(*cols), F.col("last_seq")).alias("s"))
    return g.select("write_key", "device_id", *[F.col(f"s.{c}").alias(c) for c in cols])


def start_enrichment_stream(
    spark: SparkSession,
    calls_path: str,
    out_dir: str,
    checkpoint_dir: str,
    *,
    flush_interval: str = FLUSH_INTERVAL,
    max_files_per_trigger: int = 1,
    available_now: bool = False,
    late_dir: str | None = None,
    snapshots: DataFrame | None = None,
    attempts_path: str | None = None,
    resume_from: DataFrame | None = None,
):
    """STR1-STR3 wired together: bounded intake of call files → keyed identity
    state → envelopes → request bodies written per micro-batch, every
    ``flush_interval`` (or once over all available input). Late calls, and calls
    delivered again, go to ``late_dir`` (``<out_dir>-late``), so that each message
    is in one body (STR4); device ``snapshots`` give the context of every event.

    With ``attempts_path`` (attempt-log files) calls made while a fatal answer
    keeps their client disabled are dropped (FLT1); with ``resume_from``
    (:func:`identity_snapshot`) devices start from their row of it. Both keep
    typed state (:func:`resumed_identity`)."""
    from eventloom.streaming.resumed_identity import resumed_identity, state_store

    calls = call_stream(spark, calls_path, max_files_per_trigger)
    typed = attempts_path is not None or resume_from is not None
    rows = resumed_identity(calls, resume_from, answers=answer_stream(spark, attempts_path) if attempts_path else None) if typed else identity_stream(calls)
    sink = batch_sink(out_dir, late_dir or f"{out_dir}-late", device_contexts(snapshots) if snapshots is not None else None)
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=flush_interval)
    if not typed:
        return writer.start()
    with state_store(spark):
        return writer.start()
