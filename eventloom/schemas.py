"""Schemas of the engine's input logs."""

from __future__ import annotations

from pyspark.sql import types as T

CALLS_SCHEMA = T.StructType([
    T.StructField("write_key", T.StringType()),
    T.StructField("device_id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("call", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("group_id", T.StringType()),
    T.StructField("advertising_id", T.StringType()),
    T.StructField("previous_id", T.StringType()),
    T.StructField("payload_json", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

ATTEMPTS_SCHEMA = T.StructType([
    T.StructField("write_key", T.StringType()),
    T.StructField("device_id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("attempt_ts", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("batch_size", T.LongType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
])

SETTINGS_SCHEMA = T.StructType([
    T.StructField("write_key", T.StringType()),
    T.StructField("ingestion_host", T.StringType()),
    T.StructField("flush_interval_seconds", T.LongType()),
    T.StructField("max_queue_events", T.LongType()),
    T.StructField("debug", T.BooleanType()),
])
