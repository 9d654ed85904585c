"""CTX1 on a stream: events meet the device snapshots that arrive beside them.

Both logs are streams. An outer stream-stream join pairs an event with the
snapshots its device sent at most ``max_age`` before it, and an aggregate per
event keeps the latest, so a context that changes while the stream runs counts
from its own time on. Watermarks bound the state: a snapshot is dropped once no
event can be within ``max_age`` of it, an event once no snapshot can precede it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_context_stream(
    events: DataFrame, contexts: DataFrame, max_age: str = "30 days", delay: str = "1 hour", adid_col: str = "advertising_id_state",
    kept: Column | None = None,
) -> DataFrame:
    """Each event with the latest ``context`` of its device whose
    ``snapshot_ts`` is not after the event's ``ts`` and less than ``max_age``
    before it, else NULL.

    ``events`` has ``device_id, seq, ts``; repeats of an event that arrive before
    it is emitted become one row. Rows without a device or a time are dropped (the
    watermark cannot place them). Rows more than ``delay`` behind the newest
    of their stream may be dropped as late, and an event is emitted once both streams
    are past its time by ``delay``. Of two snapshots with one time, the one with
    the greater hash counts. ``kept`` (a struct of fields of ``context``, with
    ``device.advertisingId``) is what the state holds of a context and the result has
    as ``context``; without it, all. To end a stream, add a last row with a later time to
    both logs and filter it from the result once that is written (a filter in the
    same query moves before the watermark). On tables the result is the same and whole.
    """
    keys = ["ts", "device_id", "seq"]
    others = [c for c in events.columns if c not in keys]
    left = events.where("device_id IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", delay)
    left = left.select(*keys, F.struct(*others, F.lit(True).alias("__row")).alias("__event"))
    right = contexts.where("device_id IS NOT NULL AND snapshot_ts IS NOT NULL").withWatermark("snapshot_ts", delay)
    # The hash is taken once a snapshot, not once a pair.
    held = F.col("context") if kept is None else F.when(F.col("context").isNotNull(), kept)
    right = right.select(
        F.col("device_id").alias("__device"), F.col("snapshot_ts").alias("__at"), F.xxhash64(F.to_json("context")).alias("__hash"), held.alias("__context"))
    within = (
        (F.col("device_id") == F.col("__device"))
        & (F.col("__at") <= F.col("ts"))
        & (F.col("__at") > F.col("ts") - F.expr(f"INTERVAL {max_age}"))
    )
    latest = F.max_by("__context", F.when(F.col("__at").isNotNull(), F.struct("__at", "__hash")))
    one = left.join(right, within, "left_outer").groupBy(*keys).agg(F.first("__event").alias("__event"), latest.alias("context"))
    filled = F.when(F.col("context").isNotNull(), F.col("context").withField("device.advertisingId", F.col(f"__event.{adid_col}")))
    return one.select(*keys, *[F.col(f"__event.{c}").alias(c) for c in others], filled.alias("context"))
