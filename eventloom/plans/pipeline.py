"""The enrichment pipeline assembled from the operators.

calls → [disabled filter] → identity as of each call → envelopes → context →
envelope struct. Everything is lazy: each query builds its own plan and
Catalyst prunes what it does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.operators.context import attach_context, device_contexts
from eventloom.operators.envelope import build_events
from eventloom.operators.identity import disabled_drop, identity_asof
from eventloom.plans.memo import plan
from eventloom.plans.scan import DEFAULT_WIDTH
from eventloom.sources import adapters


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.calls(spark, sf_dir)


@plan
def identity(spark: SparkSession, sf_dir: str, *, drop_disabled: bool = False, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    c = adapters.calls(spark, sf_dir)
    if drop_disabled:
        c = disabled_drop(c, adapters.attempts(spark, sf_dir), width=width)
    return identity_asof(c, width=width)


@plan
def events(spark: SparkSession, sf_dir: str, *, with_context: bool = False, **kw) -> DataFrame:
    ev = build_events(identity(spark, sf_dir, **kw))
    if with_context:
        ev = attach_context(ev, device_contexts(adapters.reported_snapshots(spark, sf_dir)))
    return ev


@plan
def light_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows with their message id but without identity state, for jobs
    that only need queue order (batching, windows)."""
    from pyspark.sql import functions as F

    from eventloom.functions.ids import message_id
    from eventloom.operators.envelope import emits_event

    c = adapters.calls(spark, sf_dir).filter(emits_event(F.col("call")))
    return c.select(
        "write_key", "device_id", "seq", "ts", F.col("call").alias("type"),
        message_id(F.col("ts"), F.col("device_id"), F.col("seq")).alias("messageId"),
    )


@plan
def breaker_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DLV5 replay over the attempts log (lazy)."""
    from eventloom.operators.delivery import breaker

    return breaker(adapters.attempts(spark, sf_dir))


@plan
def batched(spark: SparkSession, sf_dir: str, key: str, interval: str, with_context: bool = False) -> DataFrame:
    """BUF4 batches of the events (light rows, or full envelopes with context)."""
    from eventloom.operators.batching import batch_assign

    ev = events(spark, sf_dir, with_context=True) if with_context else light_events(spark, sf_dir)
    return batch_assign(ev, key=key, interval=interval)


#: Settings of the queue queries: the data has some events a day and device, so
#: capacities are a 50th of the configured ones and timer seconds are days.
QUEUE_DEFAULTS = {"max_queue_events": 40, "flush_interval_seconds": 10}


@plan
def client_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from eventloom.sources.settings import settings_check

    s = settings_check(adapters.settings(spark, sf_dir))
    return s.select("write_key", F.floor(F.col("max_queue_events") / 50).alias("max_queue_events"), "flush_interval_seconds")


@plan
def queue_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.operators.queue import queue_log as log

    return log(adapters.calls(spark, sf_dir), adapters.attempts(spark, sf_dir), client_settings(spark, sf_dir), QUEUE_DEFAULTS["max_queue_events"])


@plan
def flush_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from eventloom.operators.queue import flush_groups as groups, per_client

    rows = per_client(queue_log(spark, sf_dir), client_settings(spark, sf_dir), "flush_interval_seconds", QUEUE_DEFAULTS["flush_interval_seconds"])
    return groups(rows, F.col("flush_interval_seconds") * 86400)
