"""Derive the engine's input tables from the provided parquet tables.

The engine reads four logs: ``calls`` (one row per API call made on a device),
``attempts`` (one row per delivery attempt of a batch), ``device_snapshots``
(raw values a device reported) and ``settings`` (one row per configured
client). The test data has none of them, so they are derived by plain column
rules (FIXTURES.md §2) that DuckDB can repeat in the oracle SQL. Every rule is
a projection except the attempt ordinal, which is a skew-safe running count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.plans.memo import plan
from eventloom.plans.scan import running
from eventloom.session import ensure_utc

# ---- fixed values of the fixture rules (FIXTURES.md §2) ---------------------
ATTEMPT_STATUS_CYCLE = [200, 200, 503, 503, 503, 503, 200, 429, 429, 408, 200, 413, 400, 200, 302, None, 200, 500, 500, 404]
MODEL_CODES = ["iPhone16,2", "iPhone17,1", "iPad14,3", "x86_64", "iPhone99,9", "arm64"]
IDIOMS = ["phone", "pad", "tv", "carPlay", "mac", "unspecified"]
LOCALES = ["en_US", "de_DE", "fr_FR", "ja_JP"]
TIMEZONES = ["America/New_York", "Europe/Berlin", "Europe/Paris", "Asia/Tokyo"]
ATTEMPT_EPOCH_SECONDS = 1704067200  # 2024-01-01T00:00:00Z
# ----------------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _pick(values: list, index: Column) -> Column:
    """``values[index]`` as a CASE chain (keeps NULL entries and codegen)."""
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None)
        out = F.when(index == i, lit) if out is None else out.when(index == i, lit)
    return out


@plan
def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``calls`` from ``events`` (FIXTURES.md §2.1)."""
    ensure_utc(spark)
    return calls_of(read(spark, sf_dir, "events"))


def streamed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``calls`` with ``events`` (a file or a folder of them) read as a stream.

    All files are one micro-batch: a device's rows may lie in any of them, and
    those of a later file with a lower ``seq`` would be late."""
    ensure_utc(spark)
    schema = read(spark, sf_dir, "events").schema
    # As a pattern, since a stream's plain path must be a folder.
    return calls_of(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def calls_of(ev: DataFrame) -> DataFrame:
    """The rules of ``calls`` over rows of ``events``."""
    k_json = F.get_json_object("props", "$.k").cast("int")
    k = F.col("k")
    eid = F.col("event_id")
    et = F.col("event_type")
    call = (
        F.when((et == "signup") & (k % 4 == 0), "alias")
        .when(et == "signup", "identify")
        .when((et == "view") & (k % 2 == 0), "page")
        .when(et == "view", "screen")
        .when((et == "click") & (k % 4 == 0), "group")
        .when((et == "click") & (k % 4 == 1), "setAdvertisingId")
        .when(et == "click", "track")
        .when(et == "purchase", "track")
        .when((et == "error") & (k % 10 == 0), "reset")
        .when((et == "error") & (k % 10 == 1), "clearAdvertisingId")
        .when((et == "error") & (k % 10 == 2), "flush")
        .when((et == "error") & (k % 10 == 3), "initialize")
        .otherwise("track")
    )
    name = (
        F.when(F.col("call").isin("page", "screen"), F.concat(F.lit("p-"), _s(F.col("k"))))
        .when(F.col("call") == "track", F.col("event_type"))
    )
    user_id = (
        F.when(F.col("call") == "alias", F.concat(F.lit("u-"), _s(eid)))
        .when(F.col("call") == "identify", F.concat(F.lit("u-"), _s(eid % 1000)))
    )
    group_id = F.when(F.col("call") == "group", F.when(F.col("k") % 8 == 0, F.lit("")).otherwise(F.concat(F.lit("g-"), _s(F.col("k")))))
    adid = F.when(
        F.col("call") == "setAdvertisingId",
        F.when(F.col("k") % 12 == 1, F.lit(None).cast("string"))
        .when(F.col("k") % 12 == 5, F.lit("  "))
        .otherwise(F.concat(F.lit("ad-"), _s(F.col("k")), F.lit("-"), _s(eid))),
    )
    full_payload = F.concat(
        F.lit('{"flag":true,"k":'), _s(F.col("k")),
        F.lit(',"meta":{"s":"x"},"none":null,"tags":["a",'), _s(F.col("k")),
        F.lit('],"value":'), _s(F.col("value").cast("decimal(10,2)")), F.lit("}"),
    )
    payload = (
        F.when(F.col("call") == "identify", F.concat(F.lit('{"k":'), _s(F.col("k")), F.lit("}")))
        .when(F.col("call").isin("track", "page", "screen"), F.when(F.col("k") == 13, F.lit("{bad")).otherwise(full_payload))
    )
    given_ts = F.when(
        (F.col("event_type") == "purchase") & (F.col("k") % 5 == 0),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'00:00:00'Z'"),
    )
    return (
        ev.select(
            F.concat(F.lit("wk-"), _s(F.col("user_id") % 4)).alias("write_key"),
            F.col("user_id").alias("device_id"),
            eid.alias("seq"),
            eid,
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("event_type"),
            F.col("value"),
            k_json.alias("k"),
        )
        .withColumn("call", call)
        .select(
            "write_key", "device_id", "seq", "ts", "call",
            name.alias("name"),
            user_id.alias("user_id"),
            group_id.alias("group_id"),
            adid.alias("advertising_id"),
            F.lit(None).cast("string").alias("previous_id"),
            payload.alias("payload_json"),
            given_ts.alias("timestamp"),
        )
    )


@plan
def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``attempts`` from ``orders`` (FIXTURES.md §2.2).

    Retry-After headers: ``'5'`` at n%20=7, ``'bad'`` at 8, an HTTP date three
    seconds after the attempt at 9 (form chosen by (n/20)%3) and ``' 2 '`` at 17;
    the header name is ``Retry-After`` or ``retry-after`` by (n/20)%2.
    """
    ensure_utc(spark)
    o = read(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 15).alias("device_id"),
        F.col("o_orderkey"),
        F.col("o_orderdate"),
    )
    # Attempt ordinal per client (15 clients: each is a hot key at scale).
    o = running(o, "device_id", ["o_orderdate", "o_orderkey"], total={"n1": F.lit(1)})
    n = F.col("n1") - 1
    at = F.timestamp_seconds(F.lit(ATTEMPT_EPOCH_SECONDS) + n * 21600)
    cyc = n % 20
    retry_at = F.col("attempt_ts") + F.expr("INTERVAL 3 SECONDS")
    form = F.floor(n / 20) % 3
    http_date = (
        F.when(form == 0, F.concat(F.date_format(retry_at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(form == 1, F.concat(F.date_format(retry_at, "EEEE, dd-MMM-yy HH:mm:ss"), F.lit(" GMT")))
        .otherwise(F.date_format(retry_at, "EEE MMM d HH:mm:ss yyyy"))
    )
    retry_after = (
        F.when(cyc == 7, F.lit("5")).when(cyc == 8, F.lit("bad")).when(cyc == 9, http_date).when(cyc == 17, F.lit(" 2 "))
    )
    header_name = F.when(F.floor(n / 20) % 2 == 0, F.lit("Retry-After")).otherwise(F.lit("retry-after"))
    return (
        o.withColumn("attempt_ts", at)
        .select(
            F.concat(F.lit("wk-"), _s(F.col("device_id") % 4)).alias("write_key"),
            "device_id",
            n.alias("seq"),
            "attempt_ts",
            F.col("o_orderkey").alias("batch_id"),
            (F.lit(1) + F.col("o_orderkey") % 100).alias("batch_size"),
            _pick(ATTEMPT_STATUS_CYCLE, cyc).cast("int").alias("status"),
            F.when(retry_after.isNotNull(), F.create_map(header_name, retry_after))
            .otherwise(F.create_map().cast("map<string,string>"))
            .alias("headers"),
        )
    )


@plan
def device_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``device_snapshots`` from ``customer`` (FIXTURES.md §2.3).

    ``idiom='mac'`` is a native Mac app; ``on_mac`` marks a phone/pad app
    running on a Mac; a NULL idiom is an unsupported platform.
    """
    c = read(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    nk = F.col("c_nationkey")
    idiom = F.when(ck % 17 == 5, F.lit(None).cast("string")).otherwise(_pick(IDIOMS, nk % 6))
    return (
        c.select(
            ck.alias("device_id"),
            _pick(MODEL_CODES, ck % 6).alias("model_code"),
            idiom.alias("idiom"),
            (ck % 7 == 0).alias("on_mac"),
            F.col("c_name").alias("device_name"),
            F.when(ck % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Shop "), _s(ck % 10))).alias("display_name"),
            F.when(ck % 6 == 0, F.lit(None).cast("string")).otherwise(F.lit("shop")).alias("bundle_name"),
            F.when(ck % 9 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("2."), _s(ck % 5), F.lit(".0"))).alias("app_version"),
            F.when(ck % 10 == 0, F.lit(None).cast("string")).otherwise(_s(F.lit(100) + ck % 50)).alias("app_build"),
            F.when(ck % 8 == 0, F.lit(None).cast("string")).otherwise(F.lit("com.example.shop")).alias("bundle_id"),
            F.when(ck % 13 == 4, "visionOS").when(nk % 6 == 1, "iPadOS").when(nk % 6 == 2, "tvOS").otherwise("iOS").alias("system_name"),
            F.concat(F.lit("17."), _s(ck % 6)).alias("system_version"),
            F.lit(14).cast("bigint").alias("os_major"),
            (ck % 6).alias("os_minor"),
            (ck % 3).alias("os_patch"),
            F.when((nk % 6 == 4) & (ck % 4 == 0), F.lit(None)).otherwise(F.lit(393.0)).cast("double").alias("points_width"),
            F.when((nk % 6 == 4) & (ck % 4 == 0), F.lit(None)).otherwise(F.lit(852.0)).cast("double").alias("points_height"),
            (F.lit(1.0) + ck % 3).cast("double").alias("scale"),
            F.when(ck % 5 == 0, F.lit(None).cast("boolean")).otherwise(ck % 2 == 0).alias("wifi"),
            _pick(LOCALES, nk % 4).alias("locale"),
            _pick(TIMEZONES, nk % 4).alias("timezone"),
        )
    )


@plan
def reported_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots that events meet; some devices never reported one."""
    return device_snapshots(spark, sf_dir).filter(F.col("device_id") % 11 != 3)


SNAPSHOT_BASE_TS = "2023-12-31 00:00:00"
SNAPSHOT_UPGRADE_TS = "2024-01-15 00:00:00"


@plan
def device_snapshot_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-stamped device snapshots: every device reports at
    ``SNAPSHOT_BASE_TS``; devices with ``device_id % 4 = 1`` report again at
    ``SNAPSHOT_UPGRADE_TS`` after an app upgrade (version ``3.0.0``, build
    ``300``)."""
    s = reported_snapshots(spark, sf_dir)
    base = s.withColumn("snapshot_ts", F.to_timestamp(F.lit(SNAPSHOT_BASE_TS)))
    upgraded = (
        s.filter(F.col("device_id") % 4 == 1)
        .withColumn("app_version", F.lit("3.0.0"))
        .withColumn("app_build", F.lit("300"))
        .withColumn("snapshot_ts", F.to_timestamp(F.lit(SNAPSHOT_UPGRADE_TS)))
    )
    return base.unionByName(upgraded)


@plan
def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``settings`` from ``customer``: one configured client per customer.

    Rules give every edge case of the settings check: an empty key, hosts with
    a trailing slash, a doubled slash, spaces and newlines, a path, no scheme,
    and zero flush interval and queue size.
    """
    c = read(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    h = ck % 6
    host = (
        F.when(h == 0, F.lit("https://in.example.com/"))
        .when(h == 1, F.lit("  https://in.example.com  "))
        .when(h == 2, F.lit("https://in.example.com/collect"))
        .when(h == 3, F.lit("in.example.com"))
        .when(h == 4, F.lit("https://in.example.com//"))
        .otherwise(F.lit("\nhttps://in.example.com\n"))
    )
    return c.select(
        F.when(ck % 17 == 16, F.lit("")).otherwise(F.concat(F.lit("wk-"), _s(ck))).alias("write_key"),
        host.alias("ingestion_host"),
        ((ck % 3) * 5).alias("flush_interval_seconds"),
        ((ck % 5) * 500).alias("max_queue_events"),
        (ck % 4 == 0).alias("debug"),
    )


def received_messages(events: DataFrame) -> DataFrame:
    """Events as a collector received them, with some ids damaged in transit.

    Rule on ``seq % 17``: 0 drops the last dash, 1 prefixes ``x``, 2 prefixes
    ``+`` (still valid), 3 prefixes a space, 4 cuts the last character,
    5 lower-cases the id (still valid); other rows are unchanged.
    """
    mid = F.col("messageId")
    r = F.col("seq") % 17
    damaged = (
        F.when(r == 0, F.regexp_replace(mid, "-([0-9A-F]{12})$", "$1"))
        .when(r == 1, F.concat(F.lit("x"), mid))
        .when(r == 2, F.concat(F.lit("+"), mid))
        .when(r == 3, F.concat(F.lit(" "), mid))
        .when(r == 4, F.expr("substring(messageId, 1, length(messageId) - 1)"))
        .when(r == 5, F.lower(mid))
        .otherwise(mid)
    )
    return events.select("write_key", "device_id", "seq", damaged.alias("message_id"), F.col("timestamp").alias("event_time"))
