"""Event envelopes (ENV1-ENV7, SRC2, TIM1, MID1, SNK2, SNK3).

Only six calls emit an event. Each becomes one row of the enriched envelope:
``type, event, userId, anonymousId, groupId, properties, traits,
integrations, timestamp, writeKey, messageId, context, sentAt``. Properties and
traits are ``MAP<STRING, VARIANT>``; a payload that is not a JSON object gives
NULL (the event is still sent), and ``props_ok`` says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.ids import message_id
from eventloom.functions.json_values import empty_props, parse_object, str_variant
from eventloom.functions.times import event_time

# ---- fixed values: event kinds ----------------------------------------------
EVENT_TYPES = ["track", "identify", "group", "screen", "page", "alias"]
# ----------------------------------------------------------------------------

PROPS = T.MapType(T.StringType(), T.VariantType())


def emits_event(call: Column) -> Column:
    """SRC2: only six event types exist."""
    return call.isin(*EVENT_TYPES)


def _named(props: Column, name: Column) -> Column:
    """ENV4/ENV5: properties plus ``name``, overwriting a caller's ``name``."""
    kept = F.map_filter(F.coalesce(props, empty_props()), lambda k, v: k != "name")
    return F.map_concat(kept, F.create_map(F.lit("name"), str_variant(name)))


def _null_as_string(props: Column) -> Column:
    return F.transform_values(
        props, lambda k, v: F.when(F.is_variant_null(v), F.lit("null").cast("variant")).otherwise(v)
    )


def split_calls(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC2: calls that emit an event, and the rest (a quarantine/side frame)."""
    ok = emits_event(F.col("call"))
    return calls.filter(ok), calls.filter(~ok)


def build_events(ident: DataFrame, *, null_as_string: bool = False, message_id_col: str | None = None) -> DataFrame:
    """ENV1-ENV6 + IDN3 + TIM1 + MID1: envelope columns for the six event calls.

    ``ident`` is the output of :func:`identity_asof` (state columns present).
    Keeps ``device_id, seq, ts`` and the state columns for downstream jobs.
    ``message_id_col`` names a column with caller-given message ids (the
    custom-id form of ENV7); otherwise ids are derived (MID1).
    """
    call = F.col("call")
    payload = parse_object(F.col("payload_json"))
    if null_as_string:
        payload = _null_as_string(payload)
    props_ok = F.col("payload_json").isNull() | payload.isNotNull()
    properties = (
        F.when(call == "track", payload)
        .when(call.isin("screen", "page"), _named(payload, F.col("name")))
        .when(call == "group", F.when(F.length("group_id") > 0, F.create_map(F.lit("groupId"), str_variant(F.col("group_id")))))
        .when(call == "alias", F.when(F.col("previous_id").isNotNull(), F.create_map(F.lit("previousId"), str_variant(F.col("previous_id")))))
        .cast(PROPS)
    )
    traits = F.when(call.isin("identify", "group"), payload).cast(PROPS)
    return ident.filter(emits_event(call)).select(
        "write_key",
        "device_id",
        "seq",
        "ts",
        F.col("call").alias("type"),
        F.when(call == "track", F.col("name")).alias("event"),
        F.coalesce(F.when(call.isin("identify", "alias"), F.col("user_id")), F.col("user_state")).alias("userId"),
        F.col("anonymous_id").alias("anonymousId"),
        F.col("group_state").alias("groupId"),
        properties.alias("properties"),
        traits.alias("traits"),
        F.lit(None).cast(PROPS).alias("integrations"),
        event_time(F.col("timestamp"), F.col("ts")).alias("timestamp"),
        (F.coalesce(F.col(message_id_col), message_id(F.col("ts"), F.col("device_id"), F.col("seq")))
         if message_id_col else message_id(F.col("ts"), F.col("device_id"), F.col("seq"))).alias("messageId"),
        props_ok.alias("props_ok"),
        *[c for c in ("epoch", "flush_epoch", "initialized", "advertising_id_state", "consent_state") if c in ident.columns],
    )


def envelope(events: DataFrame, sent_at: Column | None = None) -> Column:
    """ENV7: the enriched payload as one struct, fields in wire order."""
    return F.struct(
        F.col("type"), F.col("event"), F.col("userId"), F.col("anonymousId"), F.col("groupId"),
        F.col("properties"), F.col("traits"), F.col("integrations"), F.col("timestamp"),
        F.col("write_key").alias("writeKey"), F.col("messageId"),
        (F.col("context") if "context" in events.columns else F.lit(None)).alias("context"),
        (sent_at if sent_at is not None else F.lit(None).cast("string")).alias("sentAt"),
    )


def to_event_json(env: Column) -> Column:
    """SNK2: event to JSON; absent optionals are left out."""
    return F.to_json(env, {"ignoreNullFields": "true"})
