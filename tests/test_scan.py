"""The two-level running scan equals a plain per-key window, for any chunking."""

import random

from pyspark.sql import functions as F

import eventloom.plans.scan as scan
from eventloom.plans.scan import running


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else rnd.randrange(1, 20)  # key 0 is hot
        v = rnd.choice([None, None, "a", "b", ""])
        rows.append((key, i * 3 + rnd.randrange(3), v, rnd.randrange(5)))
    return spark.createDataFrame(rows, "k long, seq long, v string, x long")


def _run(df, width):
    return running(
        df, "k", "seq",
        last={"lv": F.col("v"), "ls": F.when(F.col("x") == 0, F.struct(F.col("v").alias("v")))},
        total={"t": F.col("x"), "n": F.lit(1)},
        width=width,
    ).select("k", "seq", "lv", F.col("ls.v").alias("lsv"), "t", "n")


def _brute(rows):
    out = {}
    state = {}
    for k, seq, v, x in sorted(rows, key=lambda r: (r[0], r[1])):
        s = state.setdefault(k, {"lv": None, "ls": None, "has_ls": False, "t": 0, "n": 0})
        if v is not None:
            s["lv"] = v
        if x == 0:
            s["ls"] = v
        s["t"] += x
        s["n"] += 1
        out[(k, seq)] = (s["lv"], s["ls"], s["t"], s["n"])
    return out


def test_chunked_equals_brute_force(spark):
    df = _frame(spark)
    expected = _brute([tuple(r) for r in df.collect()])
    for width in (0, 7, 64, 1 << 20):
        got = {(r.k, r.seq): (r.lv, r.lsv, r.t, r.n) for r in _run(df, width).collect()}
        assert got == expected, f"width={width}"


def test_hot_key_is_split_into_chunks(spark):
    df = _frame(spark)
    plan = _run(df, 64)._jdf.queryExecution().executedPlan().toString()
    assert "__chunk" in plan


def _values(out):
    return {(r.k, r.seq): (r.lv, r.lsv, r.t, r.n) for r in out.collect()}


def test_split_session_equals_whole_keys(spark, monkeypatch):
    df = _frame(spark)
    whole = _values(_run(df, None))
    monkeypatch.setattr(scan, "SEQ_WIDTH", 5)
    spark.conf.set(scan.SPLIT_CONF, "true")
    try:
        split = _run(df, None)
        assert "__chunk" in split._jdf.queryExecution().executedPlan().toString()
        assert _values(split) == whole
    finally:
        spark.conf.unset(scan.SPLIT_CONF)


def test_whole_keys_are_one_shuffle(spark):
    plan = _run(_frame(spark), 0)._jdf.queryExecution().executedPlan().toString()
    assert "__chunk" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_null_order_values_and_null_keys_are_exact(spark):
    rows = [("a", None, 5), ("a", 1, 1), ("a", 900, 2), (None, None, 7), (None, 3, 1), (None, 50, 1)]
    df = spark.createDataFrame(rows, "k string, seq long, x long")
    got = {w: sorted(map(str, running(df, "k", "seq", total={"t": F.col("x")}, width=w).collect())) for w in (0, 10)}
    assert got[0] == got[10]
    assert sum(r.x for r in df.collect() if r.k == "a") == max(
        r.t for r in running(df, "k", "seq", total={"t": F.col("x")}, width=10).collect() if r.k == "a")


def test_one_outlier_does_not_defeat_the_split(spark):
    df = spark.range(10_000).select(F.lit(1).alias("k"), F.col("id").alias("seq")).union(
        spark.createDataFrame([(1, 10**15)], "k int, seq long"))
    cells = df.groupBy(F.floor(F.col("seq") / 100)).count()
    assert cells.agg(F.max("count")).first()[0] <= 200
    got = running(df, "k", "seq", total={"n": F.lit(1)}, width=100)
    assert got.agg(F.max("n")).first()[0] == 10_001


def test_building_starts_no_job(spark, sf_small, monkeypatch):
    from eventloom.plans import memo
    from eventloom.plans.catalog import REGISTRY

    tracker = spark.sparkContext.statusTracker()
    memo.clear()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        for name in sorted(REGISTRY):
            REGISTRY[name](spark, sf_small)
        # Only schema reads of the input files.
        jobs = [j for j in tracker.getJobIdsForGroup("build")]
        shuffles = [j for j in jobs if len(tracker.getJobInfo(j).stageIds) > 1]
        assert not shuffles
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
