"""Message-id jobs over received events (MID2, MID3) and the JSON sinks (SNK2, SNK3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventloom.functions.ids import message_id_is_valid, message_id_millis
from eventloom.operators.envelope import EVENT_TYPES


def split_valid(received: DataFrame, id_col: str = "message_id") -> tuple[DataFrame, DataFrame]:
    """MID2: accepted and quarantined rows (a filter each, no shuffle)."""
    ok = message_id_is_valid(F.col(id_col))
    return received.filter(ok), received.filter(~ok)


def validity_counts(received: DataFrame, id_col: str = "message_id", by: str = "write_key") -> DataFrame:
    ok = message_id_is_valid(F.col(id_col))
    return received.groupBy(by).agg(
        F.count(F.when(ok, 1)).alias("n_valid"), F.count(F.when(~ok, 1)).alias("n_invalid")
    )


def id_time_gap(received: DataFrame, id_col: str = "message_id", time_col: str = "event_time") -> DataFrame:
    """MID3: clock gap between the id's time and the event time, per device."""
    id_ms = message_id_millis(F.col(id_col))
    ev_ms = F.unix_millis(F.try_to_timestamp(F.col(time_col), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))
    gap = id_ms - ev_ms
    return received.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(id_ms.isNull(), 1)).alias("n_unparsable"),
        F.max(gap).alias("max_gap_ms"),
        F.min(gap).alias("min_gap_ms"),
    )


def parse_events(lines: DataFrame, json_col: str, schema) -> tuple[DataFrame, DataFrame]:
    """SNK3: event JSON back to typed envelopes. Returns the rows of ``lines``
    with an ``event`` struct of ``schema``, and a quarantine of those whose text
    is not a JSON object of that shape or lacks a known ``type`` or ``messageId``
    (columns of ``lines``, the text among them)."""
    broken = "_broken"
    kind = StructType([*schema.fields, StructField(broken, StringType())])
    parsed = lines.withColumn("event", F.from_json(F.col(json_col), kind, {"columnNameOfCorruptRecord": broken}))
    e = F.col("event")
    ok = F.coalesce(e[broken].isNull() & e["type"].isin(*EVENT_TYPES) & e["messageId"].isNotNull(), F.lit(False))
    return parsed.filter(ok).withColumn("event", e.dropFields(broken)), parsed.filter(~ok).drop("event")


def roundtrip_ok(json_col: str, schema) -> F.Column:
    """SNK3: JSON → envelope struct → JSON gives the same text."""
    return F.coalesce(F.to_json(F.from_json(F.col(json_col), schema), {"ignoreNullFields": "true"}) == F.col(json_col), F.lit(False))
