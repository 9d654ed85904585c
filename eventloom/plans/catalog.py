"""Registered queries: one per operator of SURVEY §2.

Each takes ``(spark, sf_dir)`` and returns a DataFrame whose column names match
the oracle SQL in :mod:`eventloom.plans.oracle`. Times are returned as epoch
microseconds or ISO text so both engines print them the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.envelope import emits_event
from eventloom.plans import pipeline
from eventloom.sources import adapters

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---- sources ---------------------------------------------------------------


@query
def call_log(spark, d):
    """SRC1: the call log derived from ``events``."""
    c = adapters.calls(spark, d)
    return c.select(
        "write_key", "device_id", "seq", F.unix_micros("ts").alias("ts_us"), "call", "name", "user_id",
        "group_id", "advertising_id", "previous_id", "payload_json", "timestamp",
    )


@query
def call_kinds(spark, d):
    """SRC2: calls per kind and whether the kind emits an event."""
    c = adapters.calls(spark, d)
    return c.groupBy("call").agg(F.count(F.lit(1)).alias("n")).withColumn("emits_event", emits_event(F.col("call")))


# ---- envelope / identity ----------------------------------------------------


@query
def enriched_events(spark, d):
    """ENV7 (flagship): one enriched event per event call."""
    ev = pipeline.events(spark, d)
    return ev.select(
        F.col("messageId").alias("message_id"), "device_id", "seq", "write_key", "type", "event",
        F.col("userId").alias("user_id"), F.col("anonymousId").alias("anonymous_id"),
        F.col("groupId").alias("group_id"), F.col("timestamp").alias("event_time"),
    )


@query
def active_events(spark, d):
    """SRC1 → FLT1 → IDN → ENV: enriched events of calls made while the client
    was not disabled by a fatal answer (a dropped identify sets nothing)."""
    ev = pipeline.events(spark, d, drop_disabled=True)
    return ev.select(
        F.col("messageId").alias("message_id"), "device_id", "seq", "type",
        F.col("userId").alias("user_id"), F.col("anonymousId").alias("anonymous_id"),
        F.col("groupId").alias("group_id"), F.col("advertising_id_state").alias("advertising_id"),
    )


@query
def identity_asof(spark, d):
    """IDN1: user and group id as of every call."""
    i = pipeline.identity(spark, d)
    return i.select("device_id", "seq", "call", "epoch", F.col("user_state").alias("user_id"), F.col("group_state").alias("group_id"))


@query
def identity_resumed(spark, d):
    """IDN1, IDN2, IDN4, IDN5: the first six calls of each device, their snapshot,
    and the rest resumed from it, together."""
    from eventloom.operators.identity import identity_asof as asof, identity_snapshot as snap

    c = adapters.calls(spark, d)
    begun = asof(c.where("seq <= 6"))
    rest = asof(c.where("seq > 6"), start=snap(begun))
    return begun.unionByName(rest).select(
        "device_id", "seq", "epoch", F.col("user_state").alias("user_id"), F.col("group_state").alias("group_id"), "anonymous_id",
        F.col("advertising_id_state").alias("advertising_id"), "consent_state", "initialized")


RESUME_AT = "2024-01-15 00:00:00"


def _run_folder(spark) -> str:
    """A new folder for a stream's rows and checkpoint, in the shared one."""
    import uuid

    from eventloom.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"


@query
def stream_identity(spark, d):
    """STR1: calls before a day as a table, their snapshot as the initial state,
    and the later ones as a stream."""
    from eventloom.operators.identity import identity_asof as asof, identity_snapshot as snap
    from eventloom.streaming.resumed_identity import resumed_identity, run_to_table

    later = F.col("ts") >= F.lit(RESUME_AT).cast("timestamp")
    begun = asof(adapters.calls(spark, d).where(~later))
    rest = resumed_identity(adapters.streamed_calls(spark, d).where(later), snap(begun))
    return run_to_table(rest, _run_folder(spark)).select(
        "device_id", "seq", "epoch", F.col("user_state").alias("user_id"), F.col("group_state").alias("group_id"), "anonymous_id",
        F.col("advertising_id_state").alias("advertising_id"), "consent_state", "initialized", "late")


FEED_FILES = 4
REPEATED_FROM = "2024-01-20 00:00:00"


@query
def stream_bodies(spark, d):
    """STR1-4, FLT1: events in the bodies that the enrichment stream writes from
    call files of whole devices, two a micro-batch, beside the attempt log. Calls
    of the last days are delivered twice."""
    from eventloom.operators.envelope import EVENT_TYPES
    from eventloom.streaming.sinks import start_enrichment_stream

    folder = _run_folder(spark)
    feed = adapters.calls(spark, d).repartition(FEED_FILES, "device_id")
    feed.write.parquet(f"{folder}/calls")
    again = spark.read.parquet(f"{folder}/calls").where(F.col("ts") >= F.lit(REPEATED_FROM).cast("timestamp"))
    again.write.parquet(f"{folder}/again")
    spark.read.parquet(f"{folder}/again").write.mode("append").parquet(f"{folder}/calls")
    adapters.attempts(spark, d).write.parquet(f"{folder}/attempts")
    start_enrichment_stream(
        spark, f"{folder}/calls", f"{folder}/bodies", f"{folder}/checkpoint", max_files_per_trigger=2, available_now=True,
        late_dir=f"{folder}/late", attempts_path=f"{folder}/attempts").awaitTermination()
    kind = "batch array<struct<messageId: string, type: string, userId: string, anonymousId: string, groupId: string, writeKey: string>>"
    e = spark.read.text(f"{folder}/bodies/*").select(F.explode(F.from_json("value", kind)["batch"]).alias("e"))
    return e.where(F.col("e.type").isin(*EVENT_TYPES)).select(
        F.col("e.messageId").alias("message_id"), F.col("e.type").alias("type"), F.col("e.userId").alias("user_id"),
        F.col("e.anonymousId").alias("anonymous_id"), F.col("e.groupId").alias("group_id"))


@query
def anonymous_id(spark, d):
    """IDN2: anonymous id per device epoch, ``unknown`` until initialized."""
    i = pipeline.identity(spark, d)
    return i.select("device_id", "seq", "epoch", "initialized", "anonymous_id")


@query
def adid_asof(spark, d):
    """IDN5: advertising id and consent state as of every call."""
    i = pipeline.identity(spark, d)
    return i.select("device_id", "seq", "call", F.col("advertising_id_state").alias("advertising_id"), "consent_state")


def _keys(m):
    return F.array_join(F.array_sort(F.map_keys(m)), ",")


def _env(kind: str) -> Query:
    def run(spark, d):
        ev = pipeline.events(spark, d).filter(F.col("type") == kind)
        props = F.col("properties")
        return ev.select(
            F.col("messageId").alias("message_id"), "type", "event", F.col("userId").alias("user_id"),
            _keys(props).alias("prop_keys"), _keys(F.col("traits")).alias("trait_keys"),
            F.try_variant_get(F.element_at(props, "name"), "$", "string").alias("name_prop"),
            F.try_variant_get(F.element_at(props, "groupId"), "$", "string").alias("group_prop"),
            F.try_variant_get(F.element_at(props, "previousId"), "$", "string").alias("previous_prop"),
            "props_ok",
        )

    run.__name__ = f"env_{kind}"
    run.__doc__ = f"ENV: envelope fields of {kind} events."
    return run


for _kind in ("track", "identify", "group", "screen", "page", "alias"):
    query(_env(_kind))


@query
def identity_fill(spark, d):
    """IDN3: the value on the event wins over the state."""
    ev = pipeline.events(spark, d)
    return ev.select(
        F.col("messageId").alias("message_id"), F.col("userId").alias("user_id"),
        F.col("anonymousId").alias("anonymous_id"), F.col("groupId").alias("group_id"),
        F.col("type").isin("identify", "alias").alias("user_from_event"),
    )


@query
def identity_snapshot(spark, d):
    """IDN4: latest stored identity per device."""
    from eventloom.operators.identity import identity_snapshot as snap

    return snap(pipeline.identity(spark, d))


@query
def alias_edges(spark, d):
    """IDN6: anonymous id → user id links from alias events."""
    from eventloom.operators.identity import alias_edges as edges

    return edges(pipeline.events(spark, d))


@query
def consent_audit(spark, d):
    """IDN7: events per consent state and how many still carry an advertising id."""
    from eventloom.operators.identity import consent_audit as audit

    return audit(pipeline.events(spark, d))


@query
def disabled_drop(spark, d):
    """FLT1: calls kept after dropping those made while disabled."""
    from eventloom.operators.identity import disabled_drop as drop

    return drop(adapters.calls(spark, d), adapters.attempts(spark, d)).select("device_id", "seq", "call")


# ---- context ----------------------------------------------------------------


@query
def context_attach(spark, d):
    """CTX1, CTX7, CTX8: context attached to every event (flattened)."""
    from eventloom.operators.context import flatten_context

    ev = pipeline.events(spark, d, with_context=True)
    return ev.select(F.col("messageId").alias("message_id"), "device_id", *flatten_context(F.col("context")))


@query
def context_asof(spark, d):
    """CTX1 (as-of form): context from the latest snapshot at or before each event."""
    from eventloom.operators.context import attach_context_asof, device_contexts

    ev = attach_context_asof(pipeline.events(spark, d), device_contexts(adapters.device_snapshot_versions(spark, d)))
    return ev.select(
        F.col("messageId").alias("message_id"), "device_id",
        F.col("context.app.version").alias("app_version"), F.col("context.app.build").alias("app_build"),
        F.col("context.device.model").alias("device_model"),
        F.col("context.device.advertisingId").alias("device_advertising_id"),
    )


STREAM_AGE_DAYS = 20
STREAM_END = "2100-01-01 00:00:00"


@query
def stream_context(spark, d):
    """CTX1 on a stream: events and device snapshots as two streams; context from
    the latest snapshot within 20 days before each event. A last row of device -1
    ends both logs, so that the watermarks pass every event."""
    from eventloom.operators.context import device_contexts
    from eventloom.streaming.context_join import attach_context_stream
    from eventloom.streaming.resumed_identity import run_to_table

    folder = _run_folder(spark)

    def log(rows, name, time_col):
        end = spark.range(1).select(F.lit(-1).cast("bigint").alias("device_id"), F.lit(STREAM_END).cast("timestamp").alias(time_col))
        rows.unionByName(end, allowMissingColumns=True).write.parquet(f"{folder}/{name}")
        return spark.readStream.schema(rows.schema).parquet(f"{folder}/{name}")

    ev = pipeline.events(spark, d).select("device_id", "seq", "ts", F.col("messageId").alias("message_id"), "advertising_id_state")
    contexts = device_contexts(log(adapters.device_snapshot_versions(spark, d), "snapshots", "snapshot_ts"))
    part = lambda name, *fields: F.struct(*[F.col(f"context.{name}.{f}").alias(f) for f in fields]).alias(name)
    kept = F.struct(part("app", "version", "build"), part("device", "model", "advertisingId"))
    joined = attach_context_stream(log(ev, "events", "ts"), contexts, f"{STREAM_AGE_DAYS} days", kept=kept).select(
        "message_id", "device_id",
        F.col("context.app.version").alias("app_version"), F.col("context.app.build").alias("app_build"),
        F.col("context.device.model").alias("device_model"),
        F.col("context.device.advertisingId").alias("device_advertising_id"),
    )
    return run_to_table(joined, f"{folder}/joined").where("device_id >= 0")


def _snap_ctx(spark, d):
    from eventloom.operators.context import with_context

    return with_context(adapters.device_snapshots(spark, d))


@query
def device_model(spark, d):
    """CTX2: model code → product name, unknown codes pass through."""
    from eventloom.operators.context import device_model as dm

    s = adapters.device_snapshots(spark, d)
    return s.select("device_id", "model_code", dm(F.col("model_code")).alias("model"))


@query
def device_type(spark, d):
    """CTX3: idiom → device type."""
    s = _snap_ctx(spark, d)
    return s.select("device_id", "idiom", "on_mac", F.col("context.device.type").alias("device_type"))


@query
def app_context(spark, d):
    """CTX4: app name, version, build, namespace with defaults."""
    s = _snap_ctx(spark, d)
    return s.select(
        "device_id", F.col("context.app.name").alias("app_name"), F.col("context.app.version").alias("app_version"),
        F.col("context.app.build").alias("app_build"), F.col("context.app.namespace").alias("app_namespace"),
    )


@query
def os_context(spark, d):
    """CTX5: OS name and version."""
    s = _snap_ctx(spark, d)
    return s.select("device_id", F.col("context.os.name").alias("os_name"), F.col("context.os.version").alias("os_version"))


@query
def screen_context(spark, d):
    """CTX6: screen pixels and density."""
    s = _snap_ctx(spark, d)
    return s.select(
        "device_id", F.col("context.screen.width").alias("screen_width"),
        F.col("context.screen.height").alias("screen_height"), F.col("context.screen.density").alias("screen_density"),
    )


# ---- ids, times, masking ----------------------------------------------------


@query
def message_id(spark, d):
    """MID1: deterministic message id per event."""
    ev = pipeline.events(spark, d)
    return ev.select("device_id", "seq", F.col("messageId").alias("message_id"))


@query
def event_time(spark, d):
    """TIM1: the caller's timestamp, else the call time as ISO-8601."""
    c = adapters.calls(spark, d).filter(emits_event(F.col("call")))
    from eventloom.functions.times import event_time as et

    return c.select("device_id", "seq", et(F.col("timestamp"), F.col("ts")).alias("event_time"),
                    F.col("timestamp").isNotNull().alias("given"))


@query
def masked_events(spark, d):
    """GOV1, GOV2: masked write key and redacted advertising id per event."""
    from eventloom.operators.governance import masked_events as masked

    return masked(pipeline.events(spark, d)).select(
        F.col("messageId").alias("message_id"), "masked_write_key", "redacted_adid"
    )


# ---- settings, JSON values, message ids, Retry-After ---------------------------


@query
def settings_check(spark, d):
    """SRC3: settings cleaned and checked."""
    from eventloom.sources.settings import settings_check as check

    return check(adapters.settings(spark, d))


@query
def props_convert(spark, d):
    """VAL1: payload conversion outcome per call kind and name."""
    from eventloom.operators.values import props_convert as conv

    return conv(adapters.calls(spark, d))


@query
def props_profile(spark, d):
    """VAL2: value kinds per call kind and key."""
    from eventloom.operators.values import props_profile as prof

    return prof(adapters.calls(spark, d))


PROPS_SPEC = {
    "k_int": ("$.k", "int"),
    "value_double": ("$.value", "double"),
    "value_int": ("$.value", "int"),
    "flag_bool": ("$.flag", "bool"),
    "flag_str": ("$.flag", "string"),
    "meta_s": ("$.meta.s", "string"),
    "tags_n": ("$.tags", "array_size"),
    "none_is_null": ("$.none", "is_null"),
}


@query
def props_columns(spark, d):
    """VAL3: strict typed extraction of chosen keys."""
    from eventloom.operators.values import props_columns as cols

    return cols(adapters.calls(spark, d), PROPS_SPEC)


@query
def props_explode(spark, d):
    """VAL5: one row per call, key and array element."""
    from eventloom.operators.values import props_explode as ex

    return ex(adapters.calls(spark, d))


def _received(spark, d):
    return adapters.received_messages(pipeline.events(spark, d))


@query
def message_id_valid(spark, d):
    """MID2: valid and invalid received ids per write key."""
    from eventloom.operators.messages import validity_counts

    return validity_counts(_received(spark, d))


@query
def message_id_gap(spark, d):
    """MID3: gap between id time and event time per device."""
    from eventloom.operators.messages import id_time_gap

    return id_time_gap(_received(spark, d))


@query
def retry_after_ms(spark, d):
    """TIM3: Retry-After in ms for every attempt."""
    from eventloom.functions.times import retry_after_ms as ra

    a = adapters.attempts(spark, d)
    return a.select("device_id", "seq", ra(F.col("headers"), F.col("attempt_ts")).alias("retry_after_ms"))


# ---- JSON sinks ----------------------------------------------------------------


def _event_json(spark, d):
    from eventloom.operators.envelope import envelope, to_event_json

    ev = pipeline.events(spark, d, with_context=True)
    return ev.select("*", to_event_json(envelope(ev)).alias("json"))


@query
def event_json(spark, d):
    """SNK2: event JSON; fields read back from the text."""
    j = _event_json(spark, d)
    fields = (
        "type string, event string, userId string, anonymousId string, groupId string, timestamp string, "
        "writeKey string, context struct<device: struct<model: string, advertisingId: string>>, "
        "properties struct<name: string>"
    )
    p = j.select("messageId", "json", F.from_json("json", fields).alias("p"))  # one parse per event
    return p.select(
        F.col("messageId").alias("message_id"),
        F.col("p.type").alias("j_type"), F.col("p.event").alias("j_event"), F.col("p.userId").alias("j_user_id"),
        F.col("p.anonymousId").alias("j_anonymous_id"), F.col("p.groupId").alias("j_group_id"),
        F.col("p.timestamp").alias("j_timestamp"), F.col("p.writeKey").alias("j_write_key"),
        F.col("p.context.device.model").alias("j_model"), F.col("p.context.device.advertisingId").alias("j_adid"),
        F.col("p.properties.name").alias("j_props_name"),
        F.col("json").contains('"event":').alias("has_event_key"),
        F.col("json").contains('"sentAt":').alias("has_sent_at_key"),
    )


@query
def event_json_roundtrip(spark, d):
    """SNK3: JSON parses back to the envelope and prints the same text."""
    from eventloom.operators.messages import roundtrip_ok

    from eventloom.operators.envelope import envelope

    j = _event_json(spark, d)
    env_schema = j.select(envelope(j).alias("e")).schema["e"].dataType
    return j.select(F.col("messageId").alias("message_id"), roundtrip_ok("json", env_schema).alias("roundtrip_ok"))


@query
def event_json_parsed(spark, d):
    """SNK3: event JSON read back into typed envelopes; every fifth text is cut
    off and goes to the quarantine (null columns)."""
    from eventloom.operators.envelope import envelope
    from eventloom.operators.messages import parse_events

    j = _event_json(spark, d)
    schema = j.select(envelope(j).alias("e")).schema["e"].dataType
    lines = j.select(F.col("messageId").alias("message_id"), F.when(F.col("seq") % 5 == 0, F.expr("left(json, 25)")).otherwise(F.col("json")).alias("json"))
    good, bad = parse_events(lines, "json", schema)
    cols = {"p_type": "type", "p_event": "event", "p_user_id": "userId", "p_anonymous_id": "anonymousId", "p_group_id": "groupId",
            "p_timestamp": "timestamp", "p_write_key": "writeKey"}
    good = good.select("message_id", F.lit(True).alias("parsed"), *[F.col(f"event.{v}").alias(k) for k, v in cols.items()])
    return good.unionByName(bad.select("message_id", F.lit(False).alias("parsed")), allowMissingColumns=True)


# ---- buffering and batching -------------------------------------------------------

#: Registered batch reports use a shared job keyed by write key with weekly
#: flush windows (the per-device 10 s default gives one-event batches on the
#: sparse test data).
BATCH_KEY = "write_key"
BATCH_INTERVAL = "7 days"
QUEUE_N = 25
FRONT_N = 10
REQUEUE_CAPACITY = 40


def _batched(spark, d, with_context=False):
    return pipeline.batched(spark, d, BATCH_KEY, BATCH_INTERVAL, with_context=with_context)


@query
def keep_newest(spark, d):
    """BUF1: newest 25 events per device (drop oldest)."""
    from eventloom.operators.batching import keep_newest as kn

    return kn(pipeline.light_events(spark, d), QUEUE_N).select("device_id", "seq")


@query
def keep_first(spark, d):
    """BUF2: first 25 events per device (drop newest)."""
    from eventloom.operators.batching import keep_first as kf

    return kf(pipeline.light_events(spark, d), QUEUE_N).select("device_id", "seq")


@query
def prebind_replay(spark, d):
    """BUF3: last 20 calls before the first initialize, replayed in order."""
    from eventloom.operators.batching import prebind_replay as pr

    return pr(adapters.calls(spark, d)).select("device_id", "seq", "call", "replay_pos")


@query
def batch_assign(spark, d):
    """BUF4: FIFO batches of at most 100 per write key and flush window."""
    b = _batched(spark, d)
    return b.select(
        F.col("messageId").alias("message_id"), "write_key", "device_id", "seq",
        F.unix_seconds("flush_start").alias("flush_start_s"), "batch_no", "batch_pos", "batch_id",
    )


@query
def device_batches(spark, d):
    """BUF4 as in the client: per device, never across a timer tick, ``flush``,
    ``reset`` or fatal answer, sent once 20 wait (settings per write key)."""
    from pyspark.sql import Window

    from eventloom.functions.ids import message_id as mid

    g = pipeline.flush_groups(spark, d).where(F.col("kind") == "event")
    together = Window.partitionBy("device_id", "flush_start", "flushes", "clears", "group_no")  # at most 20 rows
    return g.select(
        mid(F.col("t"), F.col("device_id"), F.col("seq")).alias("message_id"), "device_id", "seq", F.col("flush_start").alias("flush_start_s"),
        F.min("seq").over(together).alias("batch_first_seq"), F.col("group_pos").alias("batch_pos"),
    )


@query
def queue_depth(spark, d):
    """BUF1, BUF6, DLV3: length of each client's queue after every call and
    attempt, and how many events have left it."""
    return pipeline.queue_log(spark, d).select("device_id", "src", "seq", "kind", "queue_length", "gone")


@query
def event_fates(spark, d):
    """DLV6, BUF1: what became of every queued event, by position."""
    from eventloom.operators.queue import event_fates as fates

    return fates(pipeline.queue_log(spark, d)).select("device_id", "seq", F.col("messageId").alias("message_id"), "fate", "attempt_seq")


@query
def drain_front(spark, d):
    """BUF5: first 10 queued events per device."""
    from eventloom.operators.batching import keep_first as kf

    return kf(pipeline.light_events(spark, d), FRONT_N).select("device_id", "seq")


@query
def drop_front(spark, d):
    """BUF5: all but the first 10 queued events per device."""
    from eventloom.operators.batching import drop_front as df_

    return df_(pipeline.light_events(spark, d), FRONT_N).select("device_id", "seq")


def _acked(b):
    return F.col("batch_no") % 3 != 0


@query
def requeue_merge(spark, d):
    """BUF6: failed (unacknowledged) events ahead of new ones, capacity 40."""
    from eventloom.operators.batching import requeue_merge as rm

    b = _batched(spark, d)
    failed = b.filter(~_acked(b)).select("device_id", "seq")
    new = b.filter(_acked(b)).select("device_id", "seq")
    return rm(failed, new, REQUEUE_CAPACITY).select("device_id", "seq", "is_new", "queue_pos")


@query
def size_batches(spark, d):
    """BUF7: batches per device and week under a body limit, sized by a text that
    both engines build alike (quarantined events have no batch)."""
    from eventloom.operators.batching import size_batches as sb

    ev = pipeline.events(spark, d)
    text = F.concat_ws("|", "messageId", "type", "anonymousId", "userId", F.repeat(F.lit("x"), F.when(F.col("seq") % 50 == 7, 900).otherwise(F.col("seq") % 90)))
    sized = ev.select("device_id", "seq", "ts", F.octet_length(text).cast("bigint").alias("bytes"))
    ok, quarantined = sb(sized, 1000, interval=BATCH_INTERVAL)
    cols = ["device_id", "seq", "bytes", "batch_no", "batch_size", "piece"]
    return ok.select(*cols).unionByName(quarantined.select("device_id", "seq", "bytes"), allowMissingColumns=True)


@query
def flush_windows(spark, d):
    """BUF8: events per device and 10-second flush window, requests needed."""
    from eventloom.operators.batching import flush_windows as fw

    return fw(pipeline.light_events(spark, d))


@query
def count_windows(spark, d):
    """BUF9: events that wait together, and what ended the wait (20 waiting, the
    timer, ``flush``, ``reset`` or a fatal answer)."""
    from eventloom.operators.queue import group_summary

    return group_summary(pipeline.flush_groups(spark, d))


@query
def sent_at(spark, d):
    """TIM2: one sentAt per batch."""
    from eventloom.operators.batching import batch_keys, batch_summary

    return batch_summary(_batched(spark, d), batch_keys(BATCH_KEY))


@query
def batch_bodies(spark, d):
    """SNK1: request bodies; count, all ids in order and sentAt read back from the JSON."""
    from eventloom.operators.batching import batch_bodies as bb, batch_keys
    from eventloom.operators.envelope import envelope

    b = _batched(spark, d, with_context=True)
    bodies = bb(b, envelope(b), batch_keys(BATCH_KEY))
    items = F.from_json("body", "batch array<struct<messageId: string, sentAt: string>>")["batch"]  # one parse per body
    p = bodies.select("batch_id", "n_events", items.alias("items"))
    return p.select(
        "batch_id", "n_events",
        F.size("items").cast("bigint").alias("body_n"),
        F.array_join(F.col("items")["messageId"], ",").alias("ids"),
        F.col("items")[0]["sentAt"].alias("body_sent_at"),
    )


# ---- delivery log -------------------------------------------------------------------


@query
def delivery_actions(spark, d):
    """DLV1: attempts and events per client and action."""
    from eventloom.operators.delivery import delivery_actions as da

    return da(adapters.attempts(spark, d))


@query
def retry_delay(spark, d):
    """DLV2: retry delay scheduled after each attempt."""
    from eventloom.operators.delivery import retry_delay as rd

    return rd(adapters.attempts(spark, d), replayed=pipeline.breaker_log(spark, d)).select("device_id", "seq", "status", "retry_delay_ms")


@query
def fatal_clients(spark, d):
    """DLV3: clients disabled by a fatal answer."""
    from eventloom.operators.delivery import fatal_clients as fc

    return fc(adapters.attempts(spark, d))


@query
def batch_size_asof(spark, d):
    """DLV4: batch size in force at every attempt and the resulting action."""
    from eventloom.operators.delivery import with_actions

    return with_actions(adapters.attempts(spark, d)).select("device_id", "seq", "status", "size_in_force", "action")


@query
def breaker_trips(spark, d):
    """DLV5: circuit-breaker trips replayed from the log."""
    return pipeline.breaker_log(spark, d).select(
        "device_id", "seq", "status", "outcome", "streak", "trip", "trip_no", "cooldown_min_ms", "cooldown_max_ms", "breaker_state"
    )


def _pending(spark, d):
    from eventloom.operators.queue import event_fates as fates, pending

    return pending(fates(pipeline.queue_log(spark, d)))


@query
def undelivered(spark, d):
    """DLV6: events that still wait, by the attempts log, in queue order per device."""
    return _pending(spark, d).select("device_id", "seq", F.col("messageId").alias("message_id"), "queue_pos")


@query
def pipeline_status(spark, d):
    """DLV7: status report per write key."""
    from eventloom.operators.delivery import pipeline_status as ps
    from eventloom.operators.identity import identity_snapshot as snap
    from eventloom.sources.settings import settings_check as check

    calls = adapters.calls(spark, d)
    return ps(
        calls,
        _pending(spark, d),
        snap(pipeline.identity(spark, d)),
        pipeline.breaker_log(spark, d),
        check(adapters.settings(spark, d)),
    )


@query
def device_status(spark, d):
    """DLV7 per client: lifecycle, queue length, circuit state, identity, settings."""
    from eventloom.operators.delivery import device_status as ds
    from eventloom.sources.settings import settings_check as check

    return ds(
        pipeline.identity(spark, d),
        adapters.attempts(spark, d),
        _pending(spark, d),
        pipeline.breaker_log(spark, d),
        check(adapters.settings(spark, d)),
    )


# ---- repeated deliveries and journeys --------------------------------------------------


def _received_copies(spark, d):
    """Every batch member as received, plus a second copy 30 s later for the
    batches whose answer was lost (``batch_no % 3 = 0``)."""
    from pyspark.sql import Window

    b = _batched(spark, d)
    b = b.withColumn("sent_ts", F.max("ts").over(Window.partitionBy("batch_id")))
    first = b.select(F.col("messageId").alias("message_id"), "device_id", "seq", "sent_ts", F.lit(1).alias("copy"))
    again = b.filter(~_acked(b)).select(
        F.col("messageId").alias("message_id"), "device_id", "seq", (F.col("sent_ts") + F.expr("INTERVAL 30 SECONDS")).alias("sent_ts"), F.lit(2).alias("copy")
    )
    return first.unionByName(again)


@query
def dedup_messages(spark, d):
    """STR4: earliest copy per message id and number of copies."""
    from eventloom.streaming.dedup import dedup_messages as dd

    r = dd(_received_copies(spark, d))
    return r.select("message_id", "device_id", "seq", F.unix_micros("sent_ts").alias("first_sent_us"), "n_copies")


SECOND_RUN = "2024-01-15 00:00:00"


@query
def dedup_across_runs(spark, d):
    """STR4: copies sent before a day are one run, whose ids go to the history; the
    rest and all second copies are the next run, of which new messages stay."""
    from eventloom.streaming.history import add_to_history, new_messages, read_history

    copies = _received_copies(spark, d)
    begun = (F.col("sent_ts") < F.lit(SECOND_RUN).cast("timestamp")) & (F.col("copy") == 1)
    path = f"{_run_folder(spark)}/history"
    add_to_history(copies.where(begun), path, 1)
    r = new_messages(copies.where(~begun), read_history(spark, path))
    return r.select("message_id", "device_id", "seq", F.unix_micros("sent_ts").alias("first_sent_us"), "n_copies")


@query
def journeys(spark, d):
    """XT1: person id and phase around the alias link for every event."""
    from eventloom.operators.journeys import journeys as jn

    j = jn(pipeline.events(spark, d))
    return j.select(F.col("messageId").alias("message_id"), "person_id", "phase")


@query
def funnel(spark, d):
    """XT2: anonymous → identified → converted funnel over people."""
    from eventloom.operators.journeys import funnel as fn, journeys as jn

    return fn(jn(pipeline.events(spark, d)))


def _graph(spark, d):
    from eventloom.operators.person_graph import identity_links, person_graph as graph

    return graph(identity_links(pipeline.events(spark, d)))


@query
def person_graph(spark, d):
    """IDN6, XT1: the person of every id, through chained alias and identify links."""
    return _graph(spark, d)


@query
def people(spark, d):
    """XT1: ids, devices and events of every person."""
    from eventloom.operators.person_graph import people as report

    return report(pipeline.events(spark, d), _graph(spark, d))


@query
def journeys_asof(spark, d):
    """XT1: the person an anonymous id is linked to as of each event."""
    from eventloom.operators.person_graph import journeys_asof as asof

    return asof(pipeline.events(spark, d)).select(F.col("messageId").alias("message_id"), "person_id", "link_no")
