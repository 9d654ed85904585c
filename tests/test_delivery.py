"""Delivery-log operators against a step-by-step replay of the dispatcher and
circuit breaker (DLV1-DLV5)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eventloom.operators.delivery import breaker, retry_delay, with_actions
from eventloom.schemas import ATTEMPTS_SCHEMA

T0 = dt.datetime(2024, 1, 1)
STATUSES = [200, 201, 299, 500, 503, 599, 408, 429, 413, 400, 422, 401, 403, 404, 302, 101, 600, None]


def replay(statuses):
    """Step-by-step state machine; attempts never overlap, so an open breaker
    has always cooled down (half-open) by the next attempt."""
    state, streak, opens, size = "closed", 0, 0, 100
    out = []
    for s in statuses:
        if state == "open":
            state = "half"
        size_now = size
        trip = False
        if s is not None and 200 <= s <= 299:
            streak, state = 0, "closed"
        elif s is None or 500 <= s <= 599 or s in (408, 429):
            streak += 1
            if (state == "closed" and streak >= 3) or state == "half":
                opens += 1
                state, streak, trip = "open", 0, True
        elif s in (401, 403, 404):
            pass
        else:
            streak = 0
            if s == 413 and size > 1:
                size = max(1, size // 2)
        out.append((trip, opens if trip else None, size_now))
    return out


def attempts(spark, per_device):
    rows = []
    for dev, statuses in per_device.items():
        for i, s in enumerate(statuses):
            rows.append(("wk", dev, i, T0 + dt.timedelta(minutes=i), 1, 10, s, {}))
    return spark.createDataFrame(rows, ATTEMPTS_SCHEMA)


def test_breaker_matches_replay(spark):
    rnd = random.Random(3)
    per_device = {d: [rnd.choice(STATUSES[:9] + [None] * 2 + [413, 400, 404]) for _ in range(rnd.randrange(5, 120))] for d in range(12)}
    per_device[99] = [503] * 40 + [200] + [None] * 5  # long outage on one client
    a = attempts(spark, per_device)
    for width in (0, 8):
        got = breaker(a, width).select("device_id", "seq", "trip", "trip_no", "size_in_force", "cooldown_min_ms", "cooldown_max_ms").collect()
        by = {(r.device_id, r.seq): r for r in got}
        for dev, statuses in per_device.items():
            for i, (trip, opens, size) in enumerate(replay(statuses)):
                r = by[(dev, i)]
                assert r.trip == trip, (dev, i)
                assert r.size_in_force == size, (dev, i)
                if trip:
                    base = min(120000, 10000 * 2 ** (opens - 1))
                    assert r.trip_no == opens
                    assert (r.cooldown_min_ms, r.cooldown_max_ms) == (base - int(base * 0.2), base + int(base * 0.2))


def test_states_after_a_trip(spark):
    a = attempts(spark, {1: [503, 503, 503, 400, 404, 503, 200, 503, 503, 401, 503]})
    got = [(r.breaker_state, r.streak, r.trip_no) for r in breaker(a).orderBy("seq").collect()]
    assert got == [
        ("closed", 1, 0), ("closed", 2, 0), ("open", 0, 1), ("half_open", 0, 1), ("half_open", 0, 1), ("open", 0, 2), ("closed", 0, 2),
        ("closed", 1, 2), ("closed", 2, 2), ("closed", 2, 2), ("open", 0, 3),
    ]


def test_every_status_class(spark):
    statuses = [200, 503, 408, 429, 413, 413, 400, 302, 101, 600, None, 401]
    a = attempts(spark, {1: statuses})
    got = [r.action for r in with_actions(a).orderBy("seq").collect()]
    assert got == [
        "delivered", "requeue", "requeue", "requeue", "halve_requeue", "halve_requeue",
        "drop", "drop", "drop", "drop", "requeue", "disable",
    ]
    seven = attempts(spark, {2: [413] * 8})
    sizes = [r.size_in_force for r in with_actions(seven).orderBy("seq").collect()]
    assert sizes == [100, 50, 25, 12, 6, 3, 1, 1]
    acts = [r.action for r in with_actions(seven).orderBy("seq").collect()]
    assert acts[-2:] == ["halve_requeue", "drop"] or acts[-1] == "drop"


def test_retry_delay(spark):
    rows = [
        ("wk", 1, 0, T0, 1, 1, 503, {"Retry-After": "2"}),
        ("wk", 1, 1, T0, 1, 1, 503, {}),
        ("wk", 1, 2, T0, 1, 1, 503, {}),       # third failure trips: 10 s
        ("wk", 1, 3, T0, 1, 1, 429, {}),       # half-open failure trips again: 20 s
        ("wk", 1, 4, T0, 1, 1, 200, {}),
        ("wk", 1, 5, T0, 1, 1, 429, {"retry-after": "0"}),
        ("wk", 1, 6, T0, 1, 1, 413, {}),
        ("wk", 1, 7, T0, 1, 1, 400, {}),
        ("wk", 1, 8, T0, 1, 1, None, {}),
    ]
    a = spark.createDataFrame(rows, ATTEMPTS_SCHEMA)
    got = [r.retry_delay_ms for r in retry_delay(a).orderBy("seq").collect()]
    assert got == [2000, 100, 10000, 20000, None, 1000, 0, None, 0]


def test_several_settings_of_a_key_give_one_row(spark):
    from eventloom.operators.delivery import _one_setting

    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 1), ("b", None, 3)], "write_key string, x int, y int")
    assert sorted(map(tuple, _one_setting(df).collect())) == [("a", 2, 1), ("b", None, 3)]
