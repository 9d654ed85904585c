"""Repeats across runs: removed by the stored ids, from the days that matter only."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from eventloom.streaming.history import LAST_DAY, NO_DAY, add_to_history, id_day, new_messages, read_history

DAY = 86_400_000
T0 = dt.datetime(2024, 1, 1)
SCHEMA = "message_id string, device_id long, sent_ts timestamp"


def mid(day, n):
    return f"{day * DAY + n}-00000000-0000-0000-0000-{n:012d}"


def rows(spark, ids, minutes=0):
    return spark.createDataFrame([(i, k, T0 + dt.timedelta(minutes=minutes + k)) for k, i in enumerate(ids)], SCHEMA)


def test_repeats_of_earlier_runs_go(spark):
    path = tempfile.mkdtemp(prefix="eventloom-history-")
    first = rows(spark, [mid(1, 1), mid(1, 2), mid(2, 3), "no id", None])
    add_to_history(first, path, 1)
    add_to_history(first, path, 1)  # done again
    add_to_history(rows(spark, [mid(9, 9)]), path, 2)
    assert read_history(spark, path).count() == 5
    second = rows(spark, [mid(1, 2), mid(2, 3), mid(2, 4), mid(2, 4), "no id", "other", mid(9, 9), None])
    got = {r.message_id: (r.device_id, r.n_copies) for r in new_messages(second, read_history(spark, path, before_run=2)).collect()}
    assert got == {mid(2, 4): (2, 2), "other": (5, 1), mid(9, 9): (6, 1), None: (7, 1)}
    assert mid(9, 9) not in {r.message_id for r in new_messages(second, read_history(spark, path)).collect()}
    assert new_messages(second.where("false"), read_history(spark, path)).count() == 0


def test_days_of_ids(spark):
    ids = [mid(3, 7), "x", None, f"{10**18}-a", f"-{DAY}-a"]
    assert [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i string").select(id_day(F.col("i"))).collect()] == [3, NO_DAY, NO_DAY, LAST_DAY, NO_DAY]


def test_plan_reads_the_days_of_the_run(spark):
    path = tempfile.mkdtemp(prefix="eventloom-history-")
    add_to_history(rows(spark, [mid(d, d) for d in range(1, 40)]), path, 1)
    out = new_messages(rows(spark, [mid(5, 5), mid(5, 6)]), read_history(spark, path))
    assert [r.message_id for r in out.collect()] == [mid(5, 6)]
    plan = out._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()
