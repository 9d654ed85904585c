"""The queue over time against a queue object, and the clamped scan against a loop."""

import datetime as dt
import random
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators.queue import event_fates, flush_groups, group_summary, pending, queue_log
from eventloom.plans import scan
from eventloom.plans.scan import clamped

T0 = dt.datetime(2024, 1, 1)
CALLS = "write_key string, device_id long, seq long, ts timestamp, call string"
ATTEMPTS = "write_key string, device_id long, seq long, attempt_ts timestamp, batch_size long, status int"


@pytest.mark.parametrize("width", [0, 7, 1000])
def test_clamped_equals_a_loop(spark, width):
    rnd = random.Random(width)
    rows, want = [], {}
    for key in (None, 1, 2, 3):
        x = 5
        for i in range(rnd.choice([1, 60, 300])):
            low = rnd.choice([-(2**60), -3, 0])
            add, high = rnd.randrange(-4, 5), rnd.choice([2**60, 4, low])
            x = min(max(x + add, low), high)
            rows.append((key, i, add, low, high))
            want[key, i] = x
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, i long, a long, l long, h long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        out = clamped(df, "k", "i", "x", add=F.col("a"), low=F.col("l"), high=F.col("h"), start=5, width=width)
        assert out.columns == [*df.columns, "x"]
        assert {(r.k, r.i): r.x for r in out.collect()} == want
        assert clamped(df.where("false"), "k", "i", "x", add=F.col("a"), low=F.col("l"), high=F.col("h"), width=width).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_composition_is_associative():
    rng = np.random.default_rng(0)
    f = np.stack([rng.integers(-9, 9, 50), rng.integers(-9, 0, 50), rng.integers(0, 9, 50)])
    a, b, c = f[:, :16], f[:, 16:32], f[:, 32:48]
    assert np.array_equal(scan._after(scan._after(c, b), a), scan._after(c, scan._after(b, a)))


def simulate(calls, attempts, capacity):
    """Fates and lengths of one device's queue, with a queue object."""
    log = sorted([(t, 1, s, c, None, 0) for s, t, c in calls] + [(t, 0, s, None, st, n) for s, t, n, st in attempts])
    queue, fate, lengths, disabled, n413 = deque(), {}, {}, False, 0
    for t, src, seq, call, status, n in log:
        if src == 1:
            if call == "reset":
                fate |= {e: ("reset", None) for e in queue}
                queue.clear()
                disabled = False
            elif call != "flush" and not disabled:
                if len(queue) >= capacity:
                    fate[queue.popleft()] = ("overflow", None)
                queue.append(seq)
        elif status in (401, 403, 404):
            fate |= {e: ("fatal", seq) for e in queue}
            queue.clear()
            disabled = True
        else:
            size = max(1, 100 >> n413)
            n413 += status == 413
            retry = status is None or status in (408, 429) or 500 <= status < 600 or (status == 413 and size > 1)
            if not retry:
                body = [queue.popleft() for _ in range(min(n, len(queue)))]
                fate |= {e: ("delivered" if 200 <= status < 300 else "dropped", seq) for e in body}
        lengths[src, seq] = len(queue)
    return fate | {e: ("pending", None) for e in queue}, lengths, list(queue)


def logs(rnd, n):
    clock = lambda: T0 + dt.timedelta(seconds=rnd.randrange(0, 400))
    times = sorted(clock() for _ in range(n))
    calls = [(i, t, rnd.choices(["track", "flush", "reset", "identify", "initialize"], [20, 2, 1, 5, 1])[0]) for i, t in enumerate(times)]
    times = sorted(clock() for _ in range(n // 4))
    attempts = [(i, t, rnd.randrange(0, 9), rnd.choices([200, 503, 400, 413, 404, None, 429], [8, 3, 2, 3, 1, 1, 1])[0]) for i, t in enumerate(times)]
    return calls, attempts


@pytest.mark.parametrize("width", [0, 37_000_000])
def test_queue_log_equals_a_queue_object(spark, width):
    rnd = random.Random(11)
    data = {d: (*logs(rnd, n), cap) for d, n, cap in [(1, 200, 6), (2, 90, 1), (3, 150, 2000), (4, 1, 6), (5, 60, 6)]}
    key = {6: "a", 1: "b", 2000: "none"}
    calls = spark.createDataFrame([(key[cap], d, s, t, c) for d, (cs, _, cap) in data.items() for s, t, c in cs], CALLS)
    attempts = spark.createDataFrame([(key[cap], d, s, t, n, st) for d, (_, ats, cap) in data.items() for s, t, n, st in ats], ATTEMPTS)
    settings = spark.createDataFrame([("a", 6), ("b", 1), ("b", 1), (None, 3)], "write_key string, max_queue_events long")
    log = queue_log(calls, attempts, settings, width=width)
    lengths = {(r.device_id, r.src, r.seq): r.queue_length for r in log.collect()}
    fates = {(r.device_id, r.seq): (r.fate, r.attempt_seq) for r in event_fates(log, width=width).collect()}
    want_lengths, want_fates, waiting = {}, {}, {}
    for d, (cs, ats, cap) in data.items():
        fate, length, queue = simulate([c for c in cs if c[2] != "initialize"], ats, cap)
        want_fates |= {(d, s): f for s, f in fate.items()}
        want_lengths |= {(d, *k): n for k, n in length.items()}
        waiting |= {(d, s): i + 1 for i, s in enumerate(queue)}
    assert lengths == want_lengths
    assert fates == want_fates
    assert {f for f, _ in want_fates.values()} == {"delivered", "dropped", "overflow", "reset", "fatal", "pending"}
    assert {(r.device_id, r.seq): r.queue_pos for r in pending(event_fates(log)).collect()} == waiting


def test_queue_of_empty_logs(spark):
    calls, attempts = spark.createDataFrame([], CALLS), spark.createDataFrame([], ATTEMPTS)
    assert queue_log(calls, attempts).count() == event_fates(queue_log(calls, attempts)).count() == 0
    one = spark.createDataFrame([("k", None, 1, T0, "track"), ("k", None, 2, T0, "track")], CALLS)
    assert [(r.queue_length, r.gone) for r in queue_log(one, attempts, capacity=1).orderBy("seq").collect()] == [(1, 0), (1, 1)]


def test_groups_end_at_whatever_comes_first(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    plan = [(1, "track"), (2, "track"), (3, "track"), (4, "track"), (9, "track"), (12, "track"), (13, "flush"), (14, "track"), (15, "reset"), (16, "reset"),
            (17, "track"), (18, "track"), (19, "track"), (19, "reset"), (21, "track"), (35, "track")]
    calls = spark.createDataFrame([("k", 1, i, at(s), c) for i, (s, c) in enumerate(plan)], CALLS)
    attempts = spark.createDataFrame([("k", 1, 0, at(36), 5, 404)], ATTEMPTS)
    groups = flush_groups(queue_log(calls, attempts), F.lit(10), threshold=3)
    got = [(r.first_seq, r.last_seq, r.size, r.ended_by) for r in group_summary(groups, 3).orderBy("first_seq").collect()]
    assert got == [(0, 2, 3, "threshold"), (3, 4, 2, "timer"), (5, 5, 1, "flush"), (7, 7, 1, "reset"), (10, 12, 3, "threshold"), (14, 14, 1, "timer"), (15, 15, 1, "fatal")]
