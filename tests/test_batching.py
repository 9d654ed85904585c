"""Queue and batching rules (BUF1-BUF9, SNK1) on small frames and brute force."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from eventloom.operators.batching import (
    batch_assign, batch_bodies, count_windows, drop_front, keep_first, keep_newest, requeue_merge, size_batches,
)

T0 = dt.datetime(2024, 1, 1)


def ints(spark, n, dev=1):
    return spark.createDataFrame([(dev, i, T0 + dt.timedelta(seconds=i)) for i in range(1, n + 1)], "device_id long, seq long, ts timestamp")


def seqs(df):
    return sorted(r.seq for r in df.collect())


def test_capacity_drop_oldest_and_newest(spark):
    assert seqs(keep_newest(ints(spark, 5), 2)) == [4, 5]
    assert seqs(keep_newest(ints(spark, 5), 10)) == [1, 2, 3, 4, 5]
    assert seqs(keep_newest(ints(spark, 3), 3)) == [1, 2, 3]      # exactly capacity
    assert seqs(keep_newest(ints(spark, 4), 3)) == [2, 3, 4]      # capacity + 1
    assert seqs(keep_first(ints(spark, 5), 2)) == [1, 2]


def test_drain_and_drop_front(spark):
    assert seqs(keep_first(ints(spark, 5), 3)) == [1, 2, 3]
    assert seqs(drop_front(ints(spark, 5), 2)) == [3, 4, 5]
    assert seqs(drop_front(ints(spark, 5), 2, width=2)) == [3, 4, 5]


def test_requeue_to_front(spark):
    failed = spark.createDataFrame([(1, 1), (1, 2)], "device_id long, seq long")
    new = spark.createDataFrame([(1, 3), (1, 4), (1, 5)], "device_id long, seq long")
    got = [(r.seq, r.queue_pos) for r in requeue_merge(failed, new, capacity=4).orderBy("queue_pos").collect()]
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4)]  # newest new event lost
    got = [r.seq for r in requeue_merge(failed, new, capacity=10).orderBy("queue_pos").collect()]
    assert got == [1, 2, 3, 4, 5]


def test_batch_assign_and_bodies(spark):
    ev = ints(spark, 250).withColumn("messageId", F.concat(F.lit("m"), F.col("seq").cast("string"))).withColumn("write_key", F.lit("wk"))
    for width in (0, 16):
        b = batch_assign(ev, interval="1 hour", max_batch=100, width=width)
        sizes = sorted(r["count"] for r in b.groupBy("batch_no").count().collect())
        assert sizes == [50, 100, 100]
    env = F.struct(F.col("messageId"), F.lit(None).cast("string").alias("sentAt"))
    bodies = batch_bodies(b, env).orderBy("batch_id").collect()
    first = json.loads(bodies[0].body)["batch"]
    assert [e["messageId"] for e in first[:3]] == ["m1", "m2", "m3"]
    assert len({e["sentAt"] for e in first}) == 1


def test_count_windows(spark):
    got = [(r.group_no, r.first_seq, r.last_seq, r.size) for r in count_windows(ints(spark, 45), 20, width=7).orderBy("group_no").collect()]
    assert got == [(0, 1, 20, 20), (1, 21, 40, 20), (2, 41, 45, 5)]


def brute_sizes(rows, max_bytes, sizes=(100, 50, 25, 12, 6, 3, 1)):
    """{seq: (batch_no, size, piece)} of one key's events in one window."""
    ok, out = [(s, b) for s, b in rows if 12 + b <= max_bytes], {}
    for no in range(0, len(ok), 100):
        batch = ok[no:no + 100]
        for c in sizes:
            pieces = [batch[i:i + c] for i in range(0, len(batch), c)]
            if all(12 + sum(b for _, b in p) + len(p) - 1 <= max_bytes for p in pieces):
                out |= {s: (no // 100, c, i) for i, p in enumerate(pieces) for s, _ in p}
                break
    return out


def test_size_batches_brute_force(spark):
    rnd = random.Random(5)
    data = {d: [(i, rnd.choice([rnd.randrange(20, 60)] * 8 + [rnd.randrange(200, 900), rnd.randrange(2900, 3100)]))
                for i in range(rnd.randrange(1, 400))] for d in range(8)}
    df = spark.createDataFrame([(d, s, dt.datetime(2024, 1, 1), b) for d, rows in data.items() for s, b in rows],
                               "device_id long, seq long, ts timestamp, bytes long")
    for width in (0, 16):
        out, quarantine = size_batches(df, 3000, width=width)
        got = {(r.device_id, r.seq): (r.batch_no, r.batch_size, r.piece) for r in out.collect()}
        assert got == {(d, s): v for d, rows in data.items() for s, v in brute_sizes(rows, 3000).items()}
        assert quarantine.count() == sum(1 for rows in data.values() for _, b in rows if 12 + b > 3000)


def test_no_stamped_body_exceeds_the_limit(spark, sf_small):
    from eventloom.operators.batching import stamped_bytes
    from eventloom.operators.envelope import envelope
    from eventloom.plans import pipeline

    ev = pipeline.events(spark, sf_small, with_context=True)
    env = envelope(ev)
    sized = ev.select("device_id", "seq", "ts", stamped_bytes(env, F.col("ts")).alias("bytes"),
                      F.to_json(env.withField("sentAt", F.lit("2024-01-01T00:00:00Z")), {"ignoreNullFields": "true"}).alias("j"))
    ok, _ = size_batches(sized.drop("j"), 4000, interval="7 days")
    bodies = (ok.join(sized.select("device_id", "seq", "j"), ["device_id", "seq"]).groupBy("device_id", "flush_start", "batch_no", "piece")
              .agg(F.concat(F.lit('{"batch":['), F.array_join(F.collect_list("j"), ","), F.lit("]}")).alias("body")))
    assert bodies.where(F.octet_length("body") > 4000).count() == 0 and bodies.count() > 0


def test_top_k_at_full_capacity_in_both_layouts(spark):
    from eventloom.plans.scan import SPLIT_CONF

    df = spark.range(5_000).selectExpr("id % 2 AS device_id", "id AS seq", "timestamp'2024-01-01' AS ts")
    want = {"newest": [s for s in range(5_000) if s >= 1_000], "first": [s for s in range(5_000) if s < 4_000]}
    for split in ("false", "true"):
        spark.conf.set(SPLIT_CONF, split)
        try:
            assert seqs(keep_newest(df, 2000)) == want["newest"] and seqs(keep_first(df, 2000)) == want["first"]
            merged = requeue_merge(df.where("seq >= 4000"), df.where("seq < 4000"), 2000).where("device_id = 1")
            assert [(r.is_new, r.seq) for r in merged.orderBy("queue_pos").collect()][498:502] == [(False, 4997), (False, 4999), (True, 1), (True, 3)]
        finally:
            spark.conf.unset(SPLIT_CONF)


def test_bodies_by_batch_keys_need_no_shuffle_of_their_own(spark, sf_small):
    from eventloom.operators.batching import batch_assign, batch_bodies, batch_keys, batch_summary
    from eventloom.operators.envelope import envelope
    from eventloom.plans import pipeline

    b = batch_assign(pipeline.events(spark, sf_small), key="write_key", interval="7 days")
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    by = batch_keys("write_key")
    new, old = batch_bodies(b, envelope(b), by), batch_bodies(b, envelope(b))
    assert shuffles(new.select("batch_id", "n_events", "body")) == shuffles(b) == shuffles(old) - 1
    assert shuffles(batch_summary(b, by)) == shuffles(batch_summary(b)) - 1
    cols = ["batch_id", "n_events", "body"]
    assert sorted(map(tuple, new.select(*cols).collect())) == sorted(map(tuple, old.select(*cols).collect()))


def test_prebind_replay_by_devices(spark):
    from eventloom.operators.batching import prebind_replay

    calls = {1: "ttttti", 2: "ttt", 3: "itt", 4: "tittit", 5: "i", 6: "tt?i"}  # t track, i initialize, ? no name
    names = {"t": "track", "i": "initialize", "?": None}
    rows = [(d, s, names[c]) for d, text in calls.items() for s, c in enumerate(text)]
    df = spark.createDataFrame(rows, "device_id long, seq long, call string")
    out = prebind_replay(df, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()  # before it runs, so that it is shown once
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert sorted((r.device_id, r.seq, r.replay_pos) for r in out.collect()) == [(1, 2, 1), (1, 3, 2), (1, 4, 3), (4, 0, 1), (6, 0, 1), (6, 1, 2), (6, 2, 3)]
    assert prebind_replay(df.where("false")).count() == 0


def test_bodies_are_stamped_without_another_sort_of_the_rows(spark):
    from pyspark.sql import functions as F

    from eventloom.operators.batching import batch_bodies

    rows = spark.createDataFrame(
        [("a", 1, "2024-01-01 00:00:05", "x"), ("a", 0, "2024-01-01 00:00:09", None), ("b", 0, None, "}"), ("c", 0, "2300-01-01 00:00:00", "{")],
        "batch_id string, batch_pos long, ts string, name string").withColumn("ts", F.col("ts").cast("timestamp"))
    out = batch_bodies(rows, F.struct("name", F.lit(None).cast("string").alias("sentAt")))
    assert {r.batch_id: (r.n_events, r.body) for r in out.collect()} == {
        "a": (2, '{"batch":[{"sentAt":"2024-01-01T00:00:09Z"},{"name":"x","sentAt":"2024-01-01T00:00:09Z"}]}'),
        "b": (1, '{"batch":[{"name":"}"}]}'), "c": (1, '{"batch":[{"name":"{","sentAt":"2300-01-01T00:00:00Z"}]}')}
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
