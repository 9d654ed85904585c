"""Delivery-log analysis (DLV1-DLV7).

Input is the ``attempts`` log: one row per delivery attempt of a client
(``device_id``) in ``seq`` order, with the answer ``status`` (NULL = no answer)
and ``headers``. The reference's dispatcher and circuit breaker are replayed as
window computations over that log. Exact as long as one client's attempts do
not overlap and the process does not restart (the breaker's trip count never
resets within a process, and that is kept here).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.masks import mask_key
from eventloom.functions.times import retry_after_ms
from eventloom.plans.scan import DEFAULT_WIDTH, running

# ---- fixed values: dispatcher and breaker settings ------------------------------
INITIAL_BATCH = 100
FAILURE_THRESHOLD = 3
BASE_COOLDOWN_MS = 10_000
MAX_COOLDOWN_MS = 120_000
JITTER_RATIO = 0.2
MIN_RETRY_MS = 100
MIN_RETRY_429_MS = 1000
FATAL = (401, 403, 404)
# ---------------------------------------------------------------------------------

_MAX_SHIFT = 30


def outcome(status: Column) -> Column:
    """Breaker effect of an answer: success, failure, nonretry or fatal."""
    return (
        F.when(status.isNull(), "failure")
        .when(status.between(200, 299), "success")
        .when(status.between(500, 599) | status.isin(408, 429), "failure")
        .when(status.isin(*FATAL), "fatal")
        .otherwise("nonretry")
    )


def size_from(n413: Column, status: Column) -> Column:
    """DLV4 from the count of 413 answers up to this one."""
    before = n413 - F.coalesce((status == 413).cast("bigint"), F.lit(0))
    return F.greatest(F.lit(1), (F.lit(INITIAL_BATCH) / F.pow(F.lit(2), F.least(before, F.lit(_MAX_SHIFT)))).cast("bigint")).cast("bigint")


def with_batch_size(attempts: DataFrame, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """DLV4: batch size in force: starts at 100, halves at each 413, never
    below 1, never grows back. Adds ``size_in_force``."""
    a = running(attempts, "device_id", "seq", total={"__n413": (F.col("status") == 413).cast("bigint")}, width=width)
    return a.withColumn("size_in_force", size_from(F.col("__n413"), F.col("status"))).drop("__n413")


def action(status: Column, size_in_force: Column) -> Column:
    """DLV1: what the dispatcher does with the batch."""
    return (
        F.when(status.isNull(), "requeue")
        .when(status.between(200, 299), "delivered")
        .when(status.between(500, 599) | status.isin(408, 429), "requeue")
        .when((status == 413) & (size_in_force > 1), "halve_requeue")
        .when(status == 413, "drop")
        .when(status.isin(*FATAL), "disable")
        .otherwise("drop")
    )


def with_actions(attempts: DataFrame, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    a = with_batch_size(attempts, width)
    return a.withColumn("outcome", outcome(F.col("status"))).withColumn("action", action(F.col("status"), F.col("size_in_force")))


def delivery_actions(attempts: DataFrame, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """DLV1 report: attempts and events per client and action."""
    a = with_actions(attempts, width)
    return a.groupBy("device_id", "action").agg(
        F.count(F.lit(1)).alias("n"), F.sum("batch_size").cast("bigint").alias("events")
    )


def breaker(attempts: DataFrame, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """DLV5: circuit-breaker trips replayed from the log (gaps and islands).

    A closed breaker trips at the 3rd failure in a row, which zeroes the streak.
    The next attempt after a trip is a half-open probe: a failure trips again, a
    success closes, any other answer leaves it half-open. A non-retryable answer
    zeroes the streak, a fatal one does not. Cooldown of trip n is
    ``min(120000, 10000 * 2^(n-1))`` ms with ±20 % jitter, given as bounds. Adds
    ``outcome, size_in_force, streak, trip, trip_no, cooldown_ms,
    cooldown_min_ms, cooldown_max_ms, breaker_state`` (state after the answer).
    """
    o = F.col("outcome")
    a = attempts.withColumn("outcome", outcome(F.col("status")))
    is413 = (F.col("status") == 413).cast("bigint")
    # Pass 1: streak islands (a success or non-retryable answer starts a new one) and 413s so far.
    a = running(
        a, "device_id", "seq",
        total={"__brk": o.isin("success", "nonretry").cast("bigint"), "__n413": is413},
        width=width,
    )
    before = F.col("__n413") - F.coalesce(is413, F.lit(0))
    halvings = F.least(before, F.lit(_MAX_SHIFT))
    a = a.withColumn("size_in_force", F.greatest(F.lit(1), (F.lit(INITIAL_BATCH) / F.pow(F.lit(2), halvings)).cast("bigint"))).drop("__n413")
    # Pass 2: failures in a row within the island.
    a = running(a, ["device_id", "__brk"], "seq", total={"streak": (o == "failure").cast("bigint")}, width=width)
    # Pass 3: state after the row: success closes (0); the failure that reaches the threshold opens (1).
    a = running(
        a, "device_id", "seq",
        last={"__open": F.when(o == "success", F.lit(0)).when((o == "failure") & (F.col("streak") >= FAILURE_THRESHOLD), F.lit(1))},
        width=width,
    )
    is_open = F.coalesce(F.col("__open"), F.lit(0)) == 1
    a = a.withColumn("trip", (o == "failure") & is_open).withColumn("streak", F.when(is_open, F.lit(0)).otherwise(F.col("streak")).cast("bigint"))
    # Pass 4: trips so far.
    a = running(a, "device_id", "seq", total={"trip_no": F.col("trip").cast("bigint")}, width=width)
    exp = F.least(F.col("trip_no") - 1, F.lit(_MAX_SHIFT))
    base = F.least(F.lit(MAX_COOLDOWN_MS), (F.lit(BASE_COOLDOWN_MS) * F.pow(F.lit(2), exp)).cast("bigint"))
    jitter = F.floor(base * JITTER_RATIO)
    return (
        a.withColumn("cooldown_ms", F.when(F.col("trip"), base).cast("bigint"))
        .withColumn("cooldown_min_ms", F.when(F.col("trip"), base - jitter).cast("bigint"))
        .withColumn("cooldown_max_ms", F.when(F.col("trip"), base + jitter).cast("bigint"))
        .withColumn("breaker_state", F.when(F.col("trip"), "open").when(is_open, "half_open").otherwise("closed"))
        .drop("__brk", "__open")
    )


def retry_delay(attempts: DataFrame, width: int | None = DEFAULT_WIDTH, replayed: DataFrame | None = None) -> DataFrame:
    """DLV2: delay before the retry the dispatcher schedules (NULL = none).

    5xx/408: ``max(100, retryAfter ?? breaker)``; 429: ``max(1000, retryAfter
    ?? 0, breaker)``; no answer: ``breaker``; 413 while halving: 0. ``breaker``
    is the jitter-free cooldown when this attempt trips the breaker, else 0.
    ``replayed`` may pass an existing :func:`breaker` output of ``attempts``.
    """
    a = replayed if replayed is not None else breaker(attempts, width)
    s = F.col("status")
    ra = retry_after_ms(F.col("headers"), F.col("attempt_ts"))
    brk = F.coalesce(F.col("cooldown_ms"), F.lit(0)).cast("bigint")
    delay = (
        F.when(s.isNull(), brk)
        .when(s.between(500, 599) | (s == 408), F.greatest(F.lit(MIN_RETRY_MS), F.coalesce(ra, brk)))
        .when(s == 429, F.greatest(F.lit(MIN_RETRY_429_MS), F.coalesce(ra, F.lit(0)), brk))
        .when((s == 413) & (F.col("size_in_force") > 1), F.lit(0))
    )
    return a.withColumn("retry_delay_ms", delay.cast("bigint"))


def fatal_clients(attempts: DataFrame) -> DataFrame:
    """DLV3: clients disabled by a fatal answer, with the first one."""
    fatal = attempts.filter(F.col("status").isin(*FATAL))
    first = F.min_by(F.struct("seq", "status", "attempt_ts"), F.col("seq"))
    return fatal.groupBy("write_key", "device_id").agg(first.alias("f"), F.count(F.lit(1)).alias("n_fatal")).select(
        "write_key", "device_id", F.col("f.seq").alias("first_fatal_seq"), F.col("f.status").alias("first_fatal_status"),
        F.unix_micros(F.col("f.attempt_ts")).alias("first_fatal_ts_us"), "n_fatal",
    )


def undelivered(
    batched: DataFrame, acknowledged: DataFrame, width: int | None = DEFAULT_WIDTH
) -> DataFrame:
    """DLV6: events sent or created but never acknowledged, in queue order.

    ``acknowledged`` holds the ``messageId`` of acknowledged batch members;
    the anti join shuffles both sides on the id (no broadcast: both grow).
    """
    left = batched.join(acknowledged.select("messageId").distinct(), "messageId", "left_anti")
    return running(left, "device_id", "seq", total={"queue_pos": F.lit(1)}, width=width)


def _one_setting(settings: DataFrame) -> DataFrame:
    """One row per write key (of several the greatest, column by column order)."""
    rest = [c for c in settings.columns if c != "write_key"]
    return settings.groupBy("write_key").agg(F.max(F.struct(*rest)).alias("s")).select("write_key", *[F.col(f"s.{c}").alias(c) for c in rest])


def pipeline_status(
    write_keys: DataFrame,
    pending: DataFrame,
    snapshot: DataFrame,
    breaker_log: DataFrame,
    settings: DataFrame,
) -> DataFrame:
    """DLV7: status report per write key: masked key, queue length, identity
    coverage, open breakers and checked settings. All inputs are aggregated per
    write key before the joins, so every join is one row per key."""
    q = pending.groupBy("write_key").agg(F.count(F.lit(1)).alias("queue_length"))
    ids = snapshot.groupBy("write_key").agg(
        F.count(F.lit(1)).alias("n_devices"), F.count("user_id").alias("n_identified")
    )
    last_state = breaker_log.groupBy("write_key", "device_id").agg(F.max_by("breaker_state", "seq").alias("state"))
    brk = last_state.groupBy("write_key").agg(F.count(F.when(F.col("state") == "open", 1)).alias("n_open_breakers"))
    s = _one_setting(settings.select(
        "write_key", "host_clean", "flush_interval_seconds", "max_queue_events", F.col("valid").alias("settings_valid")
    ))
    out = write_keys.select("write_key").distinct()
    for t in (q, ids, brk, s):
        out = out.join(t, "write_key", "left")
    return out.select(
        "write_key", mask_key(F.col("write_key")).alias("masked_key"),
        F.coalesce("queue_length", F.lit(0)).alias("queue_length"),
        F.coalesce("n_devices", F.lit(0)).alias("n_devices"),
        F.coalesce("n_identified", F.lit(0)).alias("n_identified"),
        F.coalesce("n_open_breakers", F.lit(0)).alias("n_open_breakers"),
        "host_clean", "flush_interval_seconds", "max_queue_events", "settings_valid",
    )


def device_status(
    ident: DataFrame,
    attempts: DataFrame,
    pending: DataFrame,
    breaker_log: DataFrame,
    settings: DataFrame,
) -> DataFrame:
    """DLV7 per client: the client's debug information as of its last call.

    ``lifecycle`` is ``disabled`` after a fatal answer not followed by a
    ``reset``, else ``ready`` when initialized, else ``idle``; the queue length
    counts undelivered events; the circuit state is the breaker state after the
    last attempt. Every input is reduced to one row per device (partial
    aggregates) before the joins.
    """
    last = ident.groupBy("write_key", "device_id").agg(
        F.max_by(
            F.struct(
                F.col("initialized"), F.col("anonymous_id"), F.col("user_state").alias("user_id"),
                F.col("group_state").alias("group_id"),
            ),
            F.col("seq"),
        ).alias("s"),
        F.max(F.when(F.col("call") == "reset", F.col("ts"))).alias("last_reset_ts"),
    )
    fatal = attempts.filter(F.col("status").isin(*FATAL)).groupBy("device_id").agg(F.max("attempt_ts").alias("last_fatal_ts"))
    queue = pending.groupBy("device_id").agg(F.count(F.lit(1)).alias("queue_length"))
    circuit = breaker_log.groupBy("device_id").agg(F.max_by("breaker_state", "seq").alias("circuit_state"))
    s = _one_setting(settings.select("write_key", "flush_interval_seconds", "max_queue_events"))
    out = last.join(fatal, "device_id", "left").join(queue, "device_id", "left").join(circuit, "device_id", "left").join(s, "write_key", "left")
    disabled = F.col("last_fatal_ts").isNotNull() & (F.col("last_reset_ts").isNull() | (F.col("last_fatal_ts") > F.col("last_reset_ts")))
    lifecycle = F.when(disabled, "disabled").when(F.col("s.initialized"), "ready").otherwise("idle")
    return out.select(
        "write_key", mask_key(F.col("write_key")).alias("masked_key"), "device_id", lifecycle.alias("lifecycle"),
        F.coalesce("queue_length", F.lit(0)).alias("queue_length"),
        F.coalesce("circuit_state", F.lit("closed")).alias("circuit_state"),
        F.col("s.anonymous_id").alias("anonymous_id"), F.col("s.user_id").alias("user_id"), F.col("s.group_id").alias("group_id"),
        "flush_interval_seconds", "max_queue_events",
    )
