"""Context on a stream: changes while it runs, age, repeats, rows without a place."""

import datetime as dt
import tempfile
import time

from pyspark.sql import functions as F

from eventloom.streaming.context_join import attach_context_stream

T0 = dt.datetime(2024, 1, 1)
EVENT = "device_id long, seq long, ts timestamp, name string, advertising_id_state string"
CONTEXT = "device_id long, snapshot_ts timestamp, version string"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def contexts(df):
    device = F.struct(F.lit("phone").alias("model"), F.lit(None).cast("string").alias("advertisingId"))
    return df.select("device_id", "snapshot_ts", F.struct("version", device.alias("device")).alias("context"))


EVENTS = [
    (1, 1, at(0), "a", "x"), (1, 2, at(5), "b", None), (1, 3, at(10), "c", "y"), (1, 4, at(200), "d", "y"),
    (2, 1, at(5), "e", None), (3, 1, at(1), "f", "z"), (1, 2, at(5), "b", None),
    (None, 9, at(5), "g", None), (1, 9, None, "h", None), (1, None, at(6), None, None),
]
SNAPSHOTS = [
    (1, at(0), "1"), (1, at(5), "2"), (1, at(9), "3"), (1, at(12), "4"), (2, at(6), "1"), (3, at(-100), "1"), (None, at(1), "9"), (1, None, "9"),
]
WANT = {
    (1, 1): ("a", "1", "x"), (1, 2): ("b", "2", None), (1, 3): ("c", "3", "y"), (1, 4): ("d", None, None),
    (2, 1): ("e", None, None), (3, 1): ("f", None, None), (1, None): (None, "2", None),
}


def result(df):
    rows = df.select("device_id", "seq", "name", "context.version", "context.device.advertisingId").collect()
    assert len(rows) == len({(r[0], r[1]) for r in rows})
    return {(r[0], r[1]): tuple(r[2:]) for r in rows}


def test_tables(spark):
    ev, cx = spark.createDataFrame(EVENTS, EVENT), contexts(spark.createDataFrame(SNAPSHOTS, CONTEXT))
    assert result(attach_context_stream(ev, cx, "4 days")) == WANT
    assert result(attach_context_stream(ev.where("false"), cx, "4 days")) == {}
    assert {v[1] for v in result(attach_context_stream(ev, cx.where("false"), "4 days")).values()} == {None}


def test_stream_of_several_batches(spark):
    root = tempfile.mkdtemp(prefix="eventloom-context-")
    end = dt.datetime(2030, 1, 1)
    ev = spark.createDataFrame([*EVENTS, (-1, 0, end, None, None)], EVENT)
    cx = spark.createDataFrame([*SNAPSHOTS, (-1, end, None)], CONTEXT)
    for part in (f"< '{at(6)}' OR {{t}} IS NULL", f"BETWEEN '{at(6)}' AND '{at(300)}'", f"> '{at(300)}'"):
        for df, t, name in ((ev, "ts", "events"), (cx, "snapshot_ts", "contexts")):
            df.where(f"{t} {part.format(t=t)}").coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        time.sleep(1.1)
    read = lambda schema, name: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")
    out = attach_context_stream(read(EVENT, "events"), contexts(read(CONTEXT, "contexts")), "4 days")
    q = (out.writeStream.format("memory").queryName("with_context").outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    # Filtered here: Spark would move the filter before the watermark, which the last rows raise.
    assert result(spark.table("with_context").where("device_id >= 0")) == WANT


def test_kept_fields_of_the_context_that_the_whole_one_decides(spark):
    device = F.struct(F.lit("phone").alias("model"), F.lit(None).cast("string").alias("advertisingId"))
    rows = [(1, at(0), str(v % 3), str(v)) for v in range(9)]  # one time: the hash of all fields counts
    cx = spark.createDataFrame(rows, "device_id long, snapshot_ts timestamp, version string, other string").select(
        "device_id", "snapshot_ts", F.struct("version", "other", device.alias("device")).alias("context"))
    ev = spark.createDataFrame(EVENTS, EVENT)
    kept = F.struct(F.col("context.version").alias("version"), F.struct(F.col("context.device.advertisingId").alias("advertisingId")).alias("device"))
    got = attach_context_stream(ev, cx, "4 days", kept=kept)
    assert got.select("context.*").columns == ["version", "device"]
    assert result(got) == result(attach_context_stream(ev, cx, "4 days"))
