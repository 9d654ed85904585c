"""The event queue of a client over time (BUF1, BUF4, BUF6, BUF8, BUF9, DLV3, DLV6).

A client's queue is a function of two logs: the calls made on the device and the
delivery attempts with their answers. ``queue_log`` merges them per device in
time order (attempts first on a tie) and follows the queue's length: an event
adds one and drops the oldest at capacity; a delivered or refused body takes its
events from the front; a retryable answer puts them back, which changes nothing;
a fatal answer and ``reset`` clear all. Every one of these is a function
``x -> min(max(x + add, low), high)``, so the length is one ``clamped`` scan.

Everything leaves the queue at its front. So the p-th event of a device leaves at
the first row at which p events have left: the logs are reconciled by these
cumulative counts, with no batch membership needed. A body longer than the queue
takes what is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.ids import message_id
from eventloom.operators.batching import AUTO_FLUSH_AT, QUEUE_CAPACITY
from eventloom.operators.delivery import FATAL, action, size_from
from eventloom.operators.envelope import emits_event
from eventloom.plans.scan import DEFAULT_WIDTH, clamped, running

_ORDER = ["t", "src", "seq"]


def per_client(rows: DataFrame, settings: DataFrame, column: str, default: int) -> DataFrame:
    """``rows`` with ``column`` of its write key in ``settings`` (one row a
    key), or ``default``."""
    s = settings.groupBy("write_key").agg(F.max(column).cast("bigint").alias(column))
    return rows.join(s, "write_key", "left").withColumn(column, F.coalesce(F.col(column), F.lit(default).cast("bigint")))


def queue_log(calls: DataFrame, attempts: DataFrame, settings: DataFrame | None = None, capacity: int = QUEUE_CAPACITY, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """One row per event call, ``flush``, ``reset`` and attempt of a device.

    ``kind`` is ``event``, ``ignored`` (an event call while the client is
    disabled), ``flush``, ``reset``, ``delivered``, ``dropped``, ``retry`` or
    ``fatal``; ``pushed``, ``flushes`` and ``clears`` count events, flush calls
    and clearing rows up to the row, it included; ``queue_length`` is the length
    after it and ``gone`` the events that have left by then. ``settings`` gives
    ``max_queue_events`` per write key; keys without it have ``capacity``.
    A NULL device is one client; an attempt without a size takes nothing."""
    call = F.col("call")
    made = calls.where(emits_event(call) | call.isin("flush", "reset")).select(
        "write_key", "device_id", "seq", F.col("ts").alias("t"), F.lit(1).alias("src"), "call", F.lit(None).cast("int").alias("status"), F.lit(0).cast("bigint").alias("size"))
    tried = attempts.select(
        "write_key", "device_id", F.col("seq").cast("bigint").alias("seq"), F.col("attempt_ts").alias("t"), F.lit(0).alias("src"),
        F.lit(None).cast("string").alias("call"), F.col("status").cast("int").alias("status"), F.greatest(F.coalesce(F.col("batch_size"), F.lit(0)), F.lit(0)).cast("bigint").alias("size"))
    log = made.unionByName(tried)
    log = per_client(log, settings, "max_queue_events", capacity) if settings is not None else log.withColumn("max_queue_events", F.lit(capacity).cast("bigint"))
    fatal = (F.col("src") == 0) & F.coalesce(F.col("status").isin(*FATAL), F.lit(False))
    reset = F.coalesce(call == "reset", F.lit(False))
    flush = F.coalesce(call == "flush", F.lit(False))
    one = lambda c: c.cast("bigint")
    log = running(
        log, "device_id", _ORDER, width=width,
        last={"off": F.when(fatal, 1).when(reset, 0)},
        total={"n413": one(F.coalesce(F.col("status") == 413, F.lit(False))), "flushes": one(flush), "clears": one(fatal | reset)})
    did = action(F.col("status"), size_from(F.col("n413"), F.col("status")))
    kind = (F.when(reset, "reset").when(flush, "flush")
            .when(F.col("src") == 1, F.when(F.coalesce(F.col("off"), F.lit(0)) == 1, "ignored").otherwise("event"))
            .when(fatal, "fatal").when(did == "delivered", "delivered").when(did == "drop", "dropped").otherwise("retry"))
    log = log.withColumn("kind", kind).drop("off", "n413", "call", "status")
    is_event, clears = F.col("kind") == "event", F.col("kind").isin("reset", "fatal")
    log = running(log, "device_id", _ORDER, total={"pushed": one(is_event)}, width=width)
    log = clamped(
        log, "device_id", _ORDER, "queue_length", width=width,
        add=F.when(is_event, 1).when(F.col("kind").isin("delivered", "dropped"), -F.col("size")).otherwise(0),
        low=F.lit(0), high=F.when(clears, 0).otherwise(F.greatest(F.col("max_queue_events"), F.lit(1))))
    return log.withColumn("gone", F.col("pushed") - F.col("queue_length"))


def event_fates(log: DataFrame, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """DLV6 by position: each queued event of a :func:`queue_log` with its
    ``fate`` — ``delivered``, ``dropped`` (refused), ``overflow``, ``reset``,
    ``fatal`` or ``pending`` — and ``attempt_seq``, the attempt that ended it."""
    micros = F.unix_micros("t")
    left = log.where("gone > 0").select(
        "device_id", (-2 * F.col("gone") - 1).alias("place"), (-micros).alias("back"), (-F.col("src")).cast("int").alias("back_src"), (-F.col("seq")).alias("back_seq"),
        F.struct(F.when(F.col("kind") == "event", "overflow").otherwise(F.col("kind")).alias("fate"),
                 F.when(F.col("src") == 0, F.col("seq")).alias("attempt_seq")).alias("end"))
    events = log.where(F.col("kind") == "event").select(
        "write_key", "device_id", "seq", "t", (-2 * F.col("pushed")).alias("place"), F.lit(0).cast("bigint").alias("back"), F.lit(0).alias("back_src"), F.lit(0).cast("bigint").alias("back_seq"))
    # From the last place to the first, and back in time: what is met last before
    # an event is the first row at which it has left.
    both = running(events.unionByName(left, allowMissingColumns=True), "device_id", ["place", "back", "back_src", "back_seq"], last={"met": F.col("end")}, width=width)
    return both.where(F.col("end").isNull()).select(
        "write_key", "device_id", "seq", message_id(F.col("t"), F.col("device_id"), F.col("seq")).alias("messageId"), F.col("t").alias("ts"),
        F.coalesce("met.fate", F.lit("pending")).alias("fate"), F.col("met.attempt_seq").alias("attempt_seq"))


def pending(fates: DataFrame, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """DLV6: events that still wait, with ``queue_pos`` (from 1) per device."""
    return running(fates.where(F.col("fate") == "pending"), "device_id", "seq", total={"queue_pos": F.lit(1)}, width=width)


def flush_groups(log: DataFrame, interval_s: Column, threshold: int = AUTO_FLUSH_AT, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """BUF4, BUF8, BUF9: which events wait together. A group ends at the tick of
    the client's timer (every ``interval_s`` seconds), at ``flush``, once
    ``threshold`` events wait, or when a ``reset`` or fatal answer clears it,
    whichever is first. All ends but the threshold are fixed times, so they cut
    the log, and the threshold counts inside the pieces.

    One row per event and per row that ends groups (``kind``), with the piece
    (``flush_start``, ``flushes``, ``clears`` before the row), ``group_no`` and
    ``group_pos`` in it (from 0)."""
    kind = F.col("kind")
    ends = kind.isin("flush", "reset", "fatal")
    rows = log.where(ends | (kind == "event"))
    rows = rows.withColumn("flush_start", F.floor(F.unix_seconds("t") / interval_s) * interval_s)
    rows = rows.withColumn("flushes", F.col("flushes") - (kind == "flush").cast("bigint")).withColumn("clears", F.col("clears") - kind.isin("reset", "fatal").cast("bigint"))
    rows = running(rows, ["device_id", "flush_start", "flushes", "clears"], _ORDER, total={"n": (kind == "event").cast("bigint")}, width=width)
    place = F.greatest(F.col("n") - 1, F.lit(0))
    return rows.withColumn("group_no", F.floor(place / threshold).cast("bigint")).withColumn("group_pos", (place % threshold).cast("bigint")).drop("n")


def group_summary(groups: DataFrame, threshold: int = AUTO_FLUSH_AT) -> DataFrame:
    """BUF9 report: first and last event, size and ``ended_by`` of each group of
    :func:`flush_groups`; groups ended by ``reset`` or ``fatal`` were not sent."""
    is_event = F.col("kind") == "event"
    g = groups.groupBy("device_id", "flush_start", "flushes", "clears", "group_no").agg(
        F.min(F.when(is_event, F.col("seq"))).alias("first_seq"), F.max(F.when(is_event, F.col("seq"))).alias("last_seq"),
        F.count(F.when(is_event, 1)).alias("size"), F.max(F.when(~is_event, F.col("kind"))).alias("end"))
    ended = F.when(F.col("size") == threshold, "threshold").otherwise(F.coalesce("end", F.lit("timer")))
    return g.where("size > 0").select("device_id", "first_seq", "last_seq", "size", ended.alias("ended_by"))
