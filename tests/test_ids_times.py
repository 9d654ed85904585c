"""Message ids, times, masks, settings (MID1-3, TIM1, TIM3, GOV1-2, SRC3)."""

import datetime as dt

from pyspark.sql import functions as F

from eventloom.functions.ids import message_id, message_id_is_valid, message_id_millis
from eventloom.functions.masks import mask_key, redact_id
from eventloom.functions.times import retry_after_ms
from eventloom.sources.settings import settings_check


def test_message_id_validation(spark):
    ids = [
        ("1694123456789-550E8400-E29B-41D4-A716-446655440000", True),
        ("invalid-id", False),
        ("1694123456789", False),
        ("not-a-timestamp-550E8400-E29B-41D4-A716-446655440000", False),
        ("1694123456789-invalid-uuid", False),
        ("+1694123456789-550e8400-e29b-41d4-a716-446655440000", True),
        (" 1694123456789-550E8400-E29B-41D4-A716-446655440000", False),
        ("99999999999999999999-550E8400-E29B-41D4-A716-446655440000", False),  # not an Int64
    ]
    df = spark.createDataFrame(ids, "id string, ok boolean")
    for r in df.select("ok", message_id_is_valid(F.col("id")).alias("got")).collect():
        assert r.ok == r.got
    ms = spark.createDataFrame([("1694123456789-x",), ("invalid-message-id",)], "id string").select(
        message_id_millis(F.col("id")).alias("ms")
    ).collect()
    assert [r.ms for r in ms] == [1694123456789, None]


def test_message_id_deterministic(spark):
    ts = dt.datetime(2023, 9, 7, 21, 50, 56, 789999)
    df = spark.createDataFrame([(ts, 1, 2)], "ts timestamp, d long, s long")
    a = df.select(message_id(F.col("ts"), F.col("d"), F.col("s")).alias("m")).first().m
    b = df.select(message_id(F.col("ts"), F.col("d"), F.col("s")).alias("m")).first().m
    assert a == b
    assert a.startswith(str(int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)) + "-")  # cut, not rounded
    assert a.split("-", 1)[1] == a.split("-", 1)[1].upper()


def test_retry_after(spark):
    now = dt.datetime(2024, 1, 1, 6, 0, 0)
    rows = [
        ({"Retry-After": "5"}, 5000),
        ({"retry-after": " 7 "}, 7000),
        ({"RETRY-AFTER": "-3"}, 0),
        ({"Retry-After": "not-a-date"}, None),
        ({"Retry-After": "Mon, 01 Jan 2024 06:00:03 GMT"}, 3000),
        ({"Retry-After": "Monday, 01-Jan-24 06:00:04 GMT"}, 4000),
        ({"Retry-After": "Mon Jan  1 06:00:05 2024"}, 5000),
        ({"Retry-After": "Sun, 31 Dec 2023 06:00:00 GMT"}, 0),
        ({"Retry-After": "Mon, 01 Jan 2024 01:00:06 EST"}, 6000),
        ({"Retry-After": "Mon, 01 Jan 2024 07:00:07 +0100"}, 7000),
        ({"Retry-After": "Mon, 01 Jan 2024 06:00:03"}, None),  # no zone
        ({"Retry-After": "01 Jan 2024 06:00:03 GMT"}, None),  # no weekday
        ({"Retry-After": "0000000000000000000000008"}, 8000),
        ({"Retry-After": "99999999999999999999999999"}, None),
        ({}, None),
    ]
    df = spark.createDataFrame([(h, now, e) for h, e in rows], "h map<string,string>, now timestamp, e long")
    for r in df.select("e", retry_after_ms(F.col("h"), F.col("now")).alias("got")).collect():
        assert r.got == r.e


def test_masks(spark):
    df = spark.createDataFrame([("test-write-key", "ABCDEFGHIJ"), ("abcd", None)], "k string, a string")
    r = df.select(mask_key(F.col("k")).alias("m"), redact_id(F.col("a")).alias("r")).collect()
    assert [(x.m, x.r) for x in r] == [("***-key", "ABCDEFGH***"), ("***", "undefined")]


def test_settings_check(spark):
    rows = [
        ("wk", "https://example.com/", 10, 2000, False),
        ("wk", "  https://example.com  ", 0, 0, False),
        ("wk", "https://host.tld/base", 10, 2000, False),
        ("wk", "example.com", 10, 2000, False),
        ("", "https://example.com", 10, 2000, False),
        ("wk", "https://example.com//", 10, 2000, False),
    ]
    df = spark.createDataFrame(rows, "write_key string, ingestion_host string, flush_interval_seconds long, max_queue_events long, debug boolean")
    got = [(r.host_clean, r.flush_interval_seconds, r.max_queue_events, r.reason) for r in settings_check(df).collect()]
    assert got == [
        ("https://example.com", 10, 2000, None),
        ("https://example.com", 1, 1, None),
        ("https://host.tld/base", 10, 2000, None),
        ("example.com", 10, 2000, "invalid host"),
        ("https://example.com", 10, 2000, "empty write key"),
        ("https://example.com/", 10, 2000, "host ends with slash"),
    ]
