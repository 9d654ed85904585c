"""Typed-state identity: columns against the call by call rule, resuming, late rows."""

import datetime as dt
import random
import tempfile
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import eventloom.streaming.resumed_identity as resumed
from eventloom.operators.identity import disabled_drop, identity_asof, identity_snapshot
from eventloom.schemas import CALLS_SCHEMA
from eventloom.streaming.identity_state import _fresh, _step
from eventloom.streaming.resumed_identity import _FRESH, advance, gate, resumed_identity, use_state_store
from eventloom.streaming.sinks import answer_stream, call_stream

KINDS = ["track", "identify", "group", "reset", "initialize", "setAdvertisingId", "clearAdvertisingId", "flush", "alias"]


def some_calls(rnd, n):
    return pd.DataFrame(
        [(i, rnd.choice(KINDS), rnd.choice(["u", "v", None, ""]), rnd.choice(["g", None, ""]), rnd.choice(["a", None, "  ", "\n", " \t"])) for i in range(n)],
        columns=["seq", "call", "user_id", "group_id", "advertising_id"])


@pytest.mark.parametrize("seed", range(8))
def test_columns_equal_the_rule_call_by_call(seed):
    rnd = random.Random(seed)
    state, columns = _fresh(), _FRESH
    for n in (40, 1, 25):
        calls = some_calls(rnd, n)
        want = []
        for r in calls.itertuples():
            _step(state, r.call, r.user_id, r.group_id, r.advertising_id)
            state[0] = r.seq
            want.append(tuple(state[1:]))
        got, columns = advance(calls, columns)
        names = ["epoch", "initialized", "user_state", "group_state", "advertising_id_state", "consent_state", "flush_epoch"]
        assert [tuple(None if v is None else v for v in row) for row in got[names].astype(object).itertuples(index=False)] == want
        assert columns == tuple(state)


@pytest.fixture
def typed_state(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    use_state_store(spark)
    yield
    spark.conf.set(name, before)


def test_resumed_stream_with_late_rows(spark, typed_state):
    rnd = random.Random(1)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("wk", d, s, t0 + dt.timedelta(seconds=s), rnd.choice(KINDS), None, rnd.choice(["u", None]), "g", rnd.choice(["a", None]), None, None, None)
            for d in (1, 2, 3) for s in range(60)]
    calls = spark.createDataFrame(rows, CALLS_SCHEMA)
    begun = identity_asof(calls.where("seq < 20 AND device_id < 3"))
    root = tempfile.mkdtemp(prefix="eventloom-resume-")
    for part in ("seq < 40", "seq >= 40 AND seq < 50", "seq >= 45"):  # 45 to 49 come twice
        calls.where(part).where("device_id = 3 OR seq >= 20").coalesce(1).write.mode("append").parquet(root)
        time.sleep(1.1)
    out = resumed_identity(call_stream(spark, root, 1), identity_snapshot(begun), ttl_ms=3_600_000)
    q = (out.writeStream.format("memory").queryName("resumed").outputMode("append").option("checkpointLocation", tempfile.mkdtemp())
         .trigger(availableNow=True).start())
    deadline = time.time() + 200  # with idle time a query does not end by itself
    while q.isActive and spark.table("resumed").where("NOT late").count() < 140 and time.time() < deadline:
        time.sleep(0.5)
    q.stop()
    cols = ["device_id", "seq", "epoch", "flush_epoch", "initialized", "user_state", "group_state", "anonymous_id", "advertising_id_state", "consent_state"]
    got = spark.table("resumed")
    assert got.where("NOT late").count() == 140
    assert sorted((r.device_id, r.seq) for r in got.where("late").collect()) == [(d, s) for d in (1, 2, 3) for s in range(45, 50)]
    assert got.where("late AND (epoch IS NOT NULL OR anonymous_id IS NOT NULL)").count() == 0
    want = identity_asof(calls).where("device_id = 3 OR seq >= 20")
    assert sorted(map(tuple, got.where("NOT late").select(*cols).collect()), key=str) == sorted(map(tuple, want.select(*cols).collect()), key=str)


@pytest.mark.parametrize("seed", range(12))
def test_gate_equals_the_rule_row_by_row(seed):
    rnd = random.Random(seed)
    t0 = pd.Timestamp("2024-01-01")
    at = sorted(rnd.choices(range(40), k=60))
    calls = pd.DataFrame({"seq": range(60), "ts": [t0 + pd.Timedelta(seconds=x) for x in at], "call": [rnd.choice(["track", "track", "track", "reset"]) for _ in at]})
    fatal = [t0 + pd.Timedelta(seconds=rnd.choice(range(40))) for _ in range(rnd.choice([0, 1, 6]))]
    rows = sorted([(t, 0, -1, None) for t in fatal] + [(r.ts, 1, r.seq, r.call) for r in calls.itertuples()], key=lambda r: r[:3])
    off, want = False, []
    for _, src, seq, call in rows:
        off = True if src == 0 else False if call == "reset" else off
        if src and not off:
            want.append(seq)
    got, state, start = [], (None, []), 0
    for end in (0, 1, 20, 41, 60):  # all answers come with the first calls
        part = calls[start:end].reset_index(drop=True)
        keep, state = gate(part, pd.DataFrame({"ts": fatal if start == end == 0 else []}, dtype="datetime64[us]"), state)
        got += part["seq"][keep].tolist()
        start = end
    assert got == want


def test_an_answer_that_comes_late_counts_from_then_on_unless_reset():
    t0 = pd.Timestamp("2024-01-01")
    at = lambda *s: pd.DataFrame({"ts": [t0 + pd.Timedelta(seconds=x) for x in s]}, dtype="datetime64[us]")
    keep, state = gate(at(1, 5).assign(seq=[0, 1], call="track"), at(), (None, []))
    assert keep.all() and state == (None, [])
    keep, state = gate(at(6, 7, 8).assign(seq=[2, 3, 4], call=["track", "reset", "track"]), at(3), state)
    assert keep.tolist() == [False, True, True]
    assert gate(at(9).assign(seq=[5], call="track"), at(6, 7), state)[0].all()  # both before the reset, or with it


def test_disabled_calls_on_a_stream_set_nothing(spark, typed_state):
    t0 = dt.datetime(2024, 1, 1)
    call = lambda d, s, kind, user=None: ("wk", d, s, t0 + dt.timedelta(seconds=s), kind, None, user, None, None, None, None, None)
    rows = [call(d, *c) for d in (1, 2, None) for c in [(0, "identify", "a"), (1, "track"), (2, "identify", "b"), (3, "track"), (4, "reset"), (5, "track")]]
    calls = spark.createDataFrame(rows, CALLS_SCHEMA)
    root, log = tempfile.mkdtemp(prefix="eventloom-gate-"), tempfile.mkdtemp(prefix="eventloom-answers-")
    for part in ("seq < 3", "seq >= 2"):  # 2 comes twice
        calls.where(part).coalesce(1).write.mode("append").parquet(root)
        time.sleep(1.1)
    answers = [(1, t0 + dt.timedelta(seconds=2), 404), (2, t0 + dt.timedelta(seconds=2), 500), (9, t0, 401)]
    spark.createDataFrame(answers, "device_id long, attempt_ts timestamp, status int").write.mode("append").parquet(log)
    out = resumed_identity(call_stream(spark, root, 1), answers=answer_stream(spark, log))
    out.writeStream.format("memory").queryName("gated").outputMode("append").option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start().awaitTermination(300)
    got = spark.table("gated")
    users = {d: [r.user_state for r in got.where("NOT late").where(F.col("device_id").eqNullSafe(F.lit(d))).orderBy("seq").collect()] for d in (1, 2, None)}
    assert users == {1: ["a", "a", None, None], 2: ["a", "a", "b", "b", None, None], None: ["a", "a", "b", "b", None, None]}
    assert sorted(str(r.device_id) for r in got.where("late AND seq = 2").collect()) == ["1", "2", "None"] and got.where("late").count() == 3


@pytest.mark.parametrize("seed", range(4))
def test_many_devices_at_once_equal_one_after_the_other(seed):
    rnd = random.Random(seed)
    parts, states, want, after = [], [], [], []
    for n in (1, 30, 2, 17):
        _, state = advance(some_calls(rnd, 20), _FRESH)
        states.append(rnd.choice([state, _FRESH]))
        parts.append(some_calls(rnd, n).assign(seq=lambda p: p["seq"] + 20))
        columns, last = advance(parts[-1], states[-1])
        want.append(columns)
        after.append(last)
    firsts = [0, 1, 31, 33]
    got, last = resumed.advance_all(pd.concat(parts, ignore_index=True), np.array(firsts), states)
    pd.testing.assert_frame_equal(got, pd.concat(want, ignore_index=True))
    assert last == after


def test_devices_of_one_bucket_keep_their_own_state(spark, typed_state, monkeypatch):
    monkeypatch.setattr(resumed, "BUCKETS", 2)
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    devices = [*range(9), 2**60 + 1, 2**60 + 2]
    rows = [("wk", d, s, t0 + dt.timedelta(seconds=s), rnd.choice(KINDS), None, rnd.choice(["u", None]), "g", rnd.choice(["a", None]), None, None, None)
            for d in devices for s in range(30)]
    calls = spark.createDataFrame(rows, CALLS_SCHEMA)
    answers = spark.createDataFrame([(d, t0 + dt.timedelta(seconds=12), 404) for d in (3, 4, 50)], "device_id long, attempt_ts timestamp, status int")
    root, log = tempfile.mkdtemp(prefix="eventloom-bucket-"), tempfile.mkdtemp(prefix="eventloom-bucket-answers-")
    answers.write.mode("append").parquet(log)
    for part in ("seq BETWEEN 10 AND 19 OR device_id = 8 AND seq < 20", "seq >= 20"):
        calls.where(part).coalesce(1).write.mode("append").parquet(root)
        time.sleep(1.1)
    begun = identity_snapshot(identity_asof(calls.where("seq < 10 AND device_id != 8")))
    older = begun.where("device_id < 4").withColumns({"write_key": F.lit("old"), "last_seq": F.lit(2).cast("long"), "user_id": F.lit("old")})
    out = resumed_identity(call_stream(spark, root, 1), begun.unionByName(older), answers=answer_stream(spark, log))
    out.writeStream.format("memory").queryName("buckets").outputMode("append").option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start().awaitTermination(300)
    got = spark.table("buckets")
    rest = calls.where("seq >= 10 OR device_id = 8")
    want = identity_asof(disabled_drop(rest, answers), start=begun)
    cols = ["device_id", "seq", "ts", "epoch", "flush_epoch", "initialized", "user_state", "group_state", "anonymous_id", "advertising_id_state", "consent_state"]
    assert got.where("late").count() == 0
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want.select(*cols).collect()), key=str)


def test_times_after_the_year_2262_pass_the_stream(spark, typed_state):
    at = lambda year, s: dt.datetime(year, 1, 1, 0, 0, s, 123456)
    rows = [("wk", 1, s, at(y, s), "track", *[None] * 7) for s, y in ((1, 2024), (2, 2300), (3, 4500))] + [("wk", 2, 1, None, "track", *[None] * 7)]
    root, log = tempfile.mkdtemp(prefix="eventloom-year-"), tempfile.mkdtemp(prefix="eventloom-year-answers-")
    spark.createDataFrame(rows, CALLS_SCHEMA).coalesce(1).write.mode("append").parquet(root)
    spark.createDataFrame([(1, at(4000, 0), 404)], "device_id long, attempt_ts timestamp, status int").write.mode("append").parquet(log)
    out = resumed_identity(call_stream(spark, root, 1), answers=answer_stream(spark, log))
    out.writeStream.format("memory").queryName("years").outputMode("append").option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start().awaitTermination(300)
    assert {(r.device_id, r.seq, r.ts) for r in spark.table("years").collect()} == {(1, 1, at(2024, 1)), (1, 2, at(2300, 2)), (2, 1, None)}


def test_settings_of_the_state_store_hold_in_the_block_only(spark):
    names = ["spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows",
             "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"]
    before = [spark.conf.get(n, None) for n in names]
    with resumed.state_store(spark):
        assert [spark.conf.get(n) for n in names] == [resumed.STATE_STORE, "false", "true"]
    assert [spark.conf.get(n, None) for n in names] == before


def test_a_stream_has_no_more_stores_than_task_slots_need(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    most = max(resumed.LEAST_STORES, resumed.STORES_A_SLOT * spark.sparkContext.defaultParallelism)
    try:
        for session, stores in ((6, 6), (most, most), (100 * most, most)):
            spark.conf.set(name, session)
            with resumed.state_store(spark):
                assert int(spark.conf.get(name)) == stores
            assert int(spark.conf.get(name)) == session
    finally:
        spark.conf.set(name, before)


def test_a_state_that_was_just_begun_is_not_read_again():
    class Entries(dict):
        def getValue(self, key):  # noqa: N802
            reads.append(key[0])
            return self.get(key)

        def updateValue(self, key, value):  # noqa: N802
            self[key] = value

    reads, entries = [], Entries()
    processor = resumed.IdentityProcessor(None)
    processor.init(type("Handle", (), {"getMapState": lambda self, *_: entries})())
    begun = pd.DataFrame({
        "device_id": [1, 1, 2], "last_seq": [3, 1, 0], "epoch": 1, "initialized": True, "user_id": ["new", "old", None], "group_id": None,
        "advertising_id": None, "consent_state": "unknown", "flush_epoch": 0})
    processor.handleInitialState((5,), begun, None)
    calls = pd.DataFrame([{n: None for n in resumed._CALL_NAMES} | {"device_bucket": 5, "device_id": d, "seq": 4, "ts": 0, "call": "track"} for d in (1, 3)])
    out = pd.concat(processor.handleInputRows((5,), iter([calls]), None))
    assert reads == [3] and out["user_state"].tolist() == ["new", None] and out["epoch"].tolist() == [1, 0]
    assert entries[(1,)][:4] == (4, 1, True, "new") and entries[(2,)][:2] == (0, 1)
    list(processor.handleInputRows((6,), iter([calls.assign(device_bucket=6)]), None))
    assert reads == [3, 1, 3]  # another bucket


def test_events_in_a_folder_are_streamed_whole(spark, tmp_path):
    from eventloom.sources import adapters

    rows = [(i, dt.datetime(2024, 1, 20, 0, 0, i), i % 2, "view", 1.0, '{"k": 2}') for i in range(8)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    for part in ("event_id >= 4", "event_id < 4"):  # the earlier rows are in the later file
        events.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/folder/events.parquet")
        time.sleep(1.1)
    events.coalesce(1).write.parquet(f"{tmp_path}/one")
    (tmp_path / "file").mkdir()
    next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / "file" / "events.parquet")
    for kind in ("folder", "file"):
        out = resumed.run_to_table(resumed_identity(adapters.streamed_calls(spark, f"{tmp_path}/{kind}")), tempfile.mkdtemp(prefix="eventloom-folder-"))
        assert sorted(map(tuple, out.select("seq", "late").collect())) == [(i, False) for i in range(8)]
