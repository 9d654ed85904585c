"""Streaming: stateful identity equals the batch operator; sinks are idempotent."""

import datetime as dt
import json
import tempfile
import time

from pyspark.sql import functions as F

from eventloom.operators.identity import identity_asof
from eventloom.schemas import CALLS_SCHEMA
from eventloom.sources import adapters
from eventloom.streaming.dedup import dedup_messages, dedup_stream
from eventloom.streaming.identity_state import identity_stream
from eventloom.streaming.sinks import batch_sink, call_stream, enriched_stream

COLS = [
    "device_id", "seq", "epoch", "flush_epoch", "initialized", "user_state", "group_state", "anonymous_id",
    "advertising_id_state", "consent_state",
]


def _write_parts(calls, root, parts=4):
    bounds = calls.agg(F.min("seq"), F.max("seq")).first()
    lo, hi = bounds[0], bounds[1] + 1
    step = (hi - lo) // parts + 1
    for i in range(parts):
        part = calls.filter((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(root)
        time.sleep(1.1)  # file source orders by modification time


def test_stream_equals_batch(spark, sf_small):
    calls = adapters.calls(spark, sf_small)
    root = tempfile.mkdtemp(prefix="eventloom-calls-")
    _write_parts(calls, root)
    stream = call_stream(spark, root, max_files_per_trigger=1)
    out = identity_stream(stream)
    q = (
        out.writeStream.format("memory").queryName("ident_stream").outputMode("append")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="eventloom-ckpt-"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    got = spark.table("ident_stream")
    assert got.filter("late").count() == 0
    want = identity_asof(spark.read.schema(CALLS_SCHEMA).parquet(root))
    a = sorted(tuple(r) for r in got.select(*COLS).collect())
    b = sorted(tuple(r) for r in want.select(*COLS).collect())
    assert a == b


def test_late_rows_flagged(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("wk", 1, s, t0, c, None, u, None, None, None, None, None) for s, c, u in [(5, "identify", "u1"), (3, "identify", "u0")]]
    df = spark.createDataFrame(rows, CALLS_SCHEMA)
    root = tempfile.mkdtemp(prefix="eventloom-late-")
    df.filter("seq = 5").write.mode("append").parquet(root)
    time.sleep(1.1)
    df.filter("seq = 3").write.mode("append").parquet(root)
    q = (
        identity_stream(call_stream(spark, root)).writeStream.format("memory").queryName("late_rows")
        .option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start()
    )
    q.awaitTermination(120)
    got = {r.seq: (r.late, r.user_state) for r in spark.table("late_rows").collect()}
    assert got == {5: (False, "u1"), 3: (True, None)}


def test_foreach_batch_sink_is_idempotent(spark, sf_small):
    calls = adapters.calls(spark, sf_small).filter("device_id < 3")
    from eventloom.operators.envelope import build_events

    ev = build_events(identity_asof(calls))
    out = tempfile.mkdtemp(prefix="eventloom-sink-")
    sink = batch_sink(out, interval="1 day")
    sink(ev, 7)
    first = sorted(r.value for r in spark.read.text(f"{out}/batch_id=7").collect())
    sink(ev, 7)  # replay of the same micro-batch
    again = sorted(r.value for r in spark.read.text(f"{out}/batch_id=7").collect())
    assert first == again and len(first) > 0


def test_enriched_stream_runs(spark, sf_small):
    root = tempfile.mkdtemp(prefix="eventloom-enr-")
    adapters.calls(spark, sf_small).write.mode("append").parquet(root)
    q = (
        enriched_stream(call_stream(spark, root, 10)).writeStream.format("memory").queryName("enr")
        .option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    n = spark.table("enr").count()
    assert n == adapters.calls(spark, sf_small).filter(F.col("call").isin("track", "identify", "group", "screen", "page", "alias")).count()


def test_dedup_batch_and_stream(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("m1", t0 + dt.timedelta(seconds=30)), ("m1", t0), ("m2", t0), ("m1", t0 + dt.timedelta(seconds=60))]
    df = spark.createDataFrame(rows, "message_id string, sent_ts timestamp")
    got = {r.message_id: (r.sent_ts, r.n_copies) for r in dedup_messages(df).collect()}
    assert got == {"m1": (t0, 3), "m2": (t0, 1)}
    root = tempfile.mkdtemp(prefix="eventloom-dd-")
    df.write.mode("append").parquet(root)
    s = spark.readStream.schema("message_id string, sent_ts timestamp").parquet(root)
    q = (
        dedup_stream(s).writeStream.format("memory").queryName("dd").outputMode("append")
        .option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start()
    )
    q.awaitTermination(120)
    assert sorted(r.message_id for r in spark.table("dd").collect()) == ["m1", "m2"]


def test_snapshot_sink_versions(spark, sf_small):
    from eventloom.operators.identity import identity_snapshot
    from eventloom.streaming.sinks import snapshot_sink

    ident = identity_asof(adapters.calls(spark, sf_small))
    out = tempfile.mkdtemp(prefix="eventloom-snap-")
    sink = snapshot_sink(out)
    sink(ident.filter("seq % 2 = 0"), 0)
    sink(ident.filter("seq % 2 = 1"), 1)
    sink(ident.filter("seq % 2 = 1"), 1)  # replay
    got = sorted(tuple(r) for r in spark.read.parquet(f"{out}/version=1").select("device_id", "last_seq", "user_id").collect())
    want = sorted(tuple(r) for r in identity_snapshot(ident).select("device_id", "last_seq", "user_id").collect())
    assert got == want


def test_enrichment_stream_end_to_end(spark, sf_small):
    from eventloom.streaming.sinks import start_enrichment_stream

    root = tempfile.mkdtemp(prefix="eventloom-e2e-")
    calls = adapters.calls(spark, sf_small)
    _write_parts(calls, root, parts=2)
    out = tempfile.mkdtemp(prefix="eventloom-e2e-out-")
    q = start_enrichment_stream(spark, root, out, tempfile.mkdtemp(prefix="eventloom-e2e-ck-"), available_now=True)
    q.awaitTermination(300)
    bodies = spark.read.text(out + "/*")
    parsed = bodies.select(F.explode(F.from_json("value", "batch array<struct<messageId: string>>")["batch"]).alias("e"))
    n_events = calls.filter(F.col("call").isin("track", "identify", "group", "screen", "page", "alias")).count()
    assert parsed.count() == n_events
    assert parsed.select("e.messageId").distinct().count() == n_events


def test_stream_bodies_carry_the_context_of_batch_events(spark, sf_small):
    from eventloom.operators.envelope import envelope, to_event_json
    from eventloom.plans import pipeline
    from eventloom.streaming.sinks import start_enrichment_stream

    root = tempfile.mkdtemp(prefix="eventloom-ctx-")
    _write_parts(adapters.calls(spark, sf_small), root, parts=2)
    out = tempfile.mkdtemp(prefix="eventloom-ctx-out-")
    start_enrichment_stream(spark, root, out, tempfile.mkdtemp(prefix="eventloom-ctx-ck-"), available_now=True,
                            snapshots=adapters.reported_snapshots(spark, sf_small)).awaitTermination(300)
    got = {}
    for r in spark.read.text(out + "/*").collect():
        for e in json.loads(r.value)["batch"]:
            e.pop("sentAt")
            got[e["messageId"]] = e
    ev = pipeline.events(spark, sf_small, with_context=True)
    want = {(e := json.loads(r.j))["messageId"]: e for r in ev.select(to_event_json(envelope(ev)).alias("j")).collect()}
    assert any("context" in e for e in want.values()) and got == want


def test_late_rows_are_written_beside_the_bodies(spark):
    rows = [("wk", 1, 5, dt.datetime(2024, 1, 1), "track", False), ("wk", 1, 3, dt.datetime(2024, 1, 1), "track", True)]
    base = spark.createDataFrame(rows, "write_key string, device_id long, seq long, ts timestamp, call string, late boolean")
    calls = spark.createDataFrame([], CALLS_SCHEMA).join(base.limit(0).select("seq"), "seq", "left_semi").unionByName(base, allowMissingColumns=True)
    ident = identity_asof(calls.drop("late")).join(base.select("seq", "late"), "seq")
    out = tempfile.mkdtemp(prefix="eventloom-late-")
    batch_sink(f"{out}/bodies", f"{out}/late", interval="1 day")(ident, 0)
    assert [r.seq for r in spark.read.json(f"{out}/late/batch_id=0").collect()] == [3]
    assert spark.read.text(f"{out}/bodies/batch_id=0").count() == 1


def test_read_json_call_log_with_quarantine(spark):
    from eventloom.sources.logs import read_calls

    root = tempfile.mkdtemp(prefix="eventloom-json-")
    with open(f"{root}/calls.json", "w") as f:
        f.write('{"write_key":"wk","device_id":1,"seq":1,"ts":"2024-01-01T00:00:00Z","call":"track","name":"a"}\n')
        f.write('{"write_key":"wk","device_id":1,"seq":2,"ts":"2024-01-01T00:00:01Z","call":"identify","user_id":"u1"}\n')
        f.write('{not json\n')
    ok, bad = read_calls(spark, root, fmt="json")
    ok.cache()
    assert sorted(r.seq for r in ok.collect()) == [1, 2]
    assert len(bad.collect()) == 1  # a bare count() would read only the corrupt column, which Spark refuses
    ident = identity_asof(ok)
    assert {r.seq: r.user_state for r in ident.collect()} == {1: None, 2: "u1"}
