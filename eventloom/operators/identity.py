"""Identity as of each call (IDN1-IDN7) and the disabled-client filter (FLT1).

Order within a device is ``seq``. ``reset`` clears user, group and advertising
id and starts a new epoch; the anonymous id is one per device and epoch and is
``"unknown"`` after a reset until an ``initialize`` row (epoch 0 counts as
initialized, its id being stored). ``identify`` and ``group`` set state before
their own event is built, so every running value includes the current row.
Empty string is a value, not "unset".

All running values come from :func:`eventloom.plans.scan.running`, which keeps a
hot device parallel. Two passes are needed: the advertising id depends on
whether the client is ready at the row that sets it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.ids import anonymous_id
from eventloom.plans.scan import DEFAULT_WIDTH, running

FATAL_STATUSES = (401, 403, 404)
_START = "__start"


def _null_struct():
    return F.struct(F.lit(None).cast("string").alias("v"))


def _blank(c):
    # Trims spaces and tabs only (a newline is not whitespace for this check).
    return F.regexp_replace(c, r"^[\p{Zs}\t]+|[\p{Zs}\t]+$", "") == ""


def identity_asof(
    calls: DataFrame, *, width: int | None = DEFAULT_WIDTH, with_adid: bool = True, alias_sets_user: bool = False,
    start: DataFrame | None = None,
) -> DataFrame:
    """IDN1, IDN2, IDN5: add ``epoch, flush_epoch, initialized, user_state,
    group_state, anonymous_id`` and (``with_adid``) ``advertising_id_state,
    consent_state``. ``flush_epoch`` counts explicit ``flush`` calls so far
    (a flush drains the queue, so batches never span one).

    ``alias`` only emits an event; with ``alias_sets_user=True`` it also sets
    the user id like ``identify`` (the documented, not the coded, behaviour).

    ``start`` (an :func:`identity_snapshot`) is the state to resume from: a
    daily run reads the day's calls and the last snapshot. Its ``last_seq`` must
    be below the device's calls; devices without a row start fresh.
    """
    if start is not None:
        first = start.select(
            "write_key", "device_id", F.col("last_seq").alias("seq"), F.lit(_START).alias("call"), "user_id", "group_id", "advertising_id",
            F.struct("epoch", "flush_epoch", "initialized", "consent_state").alias("__start"))
        calls = calls.unionByName(first, allowMissingColumns=True)
    else:
        calls = calls.withColumn("__start", F.lit(None).cast("struct<epoch:bigint,flush_epoch:bigint,initialized:boolean,consent_state:string>"))
    call = F.col("call")
    is_start = call == _START
    begin = F.col("__start")
    is_reset = call == "reset"
    sets_user = (call.isin("identify", "alias") if alias_sets_user else (call == "identify")) | is_start
    ident = running(
        calls,
        "device_id",
        "seq",
        last={
            "__u": F.when(is_reset, _null_struct()).when(sets_user, F.struct(F.col("user_id").alias("v"))),
            "__g": F.when(is_reset, _null_struct()).when((call == "group") | is_start, F.struct(F.col("group_id").alias("v"))),
            "__m": F.when(is_reset, F.lit(False)).when(call == "initialize", F.lit(True)).when(is_start, begin["initialized"]),
        },
        total={
            "epoch": F.coalesce(begin["epoch"], is_reset.cast("bigint")),
            "flush_epoch": F.coalesce(begin["flush_epoch"], (call == "flush").cast("bigint")),
        },
        width=width,
    )
    initialized = F.coalesce(F.col("__m"), F.lit(True))
    ident = ident.select(
        *[c for c in ident.columns if c not in ("__u", "__g", "__m")],
        initialized.alias("initialized"),
        F.col("__u.v").alias("user_state"),
        F.col("__g.v").alias("group_state"),
        F.when(initialized, anonymous_id(F.col("device_id"), F.col("epoch"))).otherwise(F.lit("unknown")).alias("anonymous_id"),
    )
    if not with_adid:
        return ident.where(~is_start).drop("__start")

    ready = F.col("initialized")
    adid = F.col("advertising_id")
    valid_set = (call == "setAdvertisingId") & (adid.isNull() | ~_blank(adid))
    change = (
        F.when(is_start, F.struct(adid.alias("v"), begin["consent_state"].alias("c")))
        .when(is_reset, F.struct(F.lit(None).cast("string").alias("v"), F.lit("unknown").alias("c")))
        .when(ready & valid_set, F.struct(adid.alias("v"), F.when(adid.isNull(), "withdrawn").otherwise("granted").alias("c")))
        .when(ready & (call == "clearAdvertisingId"), F.struct(F.lit(None).cast("string").alias("v"), F.lit("withdrawn").alias("c")))
    )
    ident = running(ident, "device_id", "seq", last={"__a": change}, width=width)
    return ident.where(~is_start).select(
        *[c for c in ident.columns if c not in ("__a", "__start")],
        F.col("__a.v").alias("advertising_id_state"),
        F.coalesce(F.col("__a.c"), F.lit("unknown")).alias("consent_state"),
    )


def identity_snapshot(ident: DataFrame) -> DataFrame:
    """IDN4: latest identity per device (what a restart loads: ``start`` of
    :func:`identity_asof`).

    ``max_by`` is a partial aggregate, so a hot device is pre-reduced per task.
    """
    latest = F.max_by(
        F.struct(
            F.col("seq"),
            F.col("epoch"),
            F.col("anonymous_id"),
            F.col("user_state").alias("user_id"),
            F.col("group_state").alias("group_id"),
            F.col("advertising_id_state").alias("advertising_id"),
            F.col("initialized"),
            F.col("consent_state"),
            F.col("flush_epoch"),
        ),
        F.col("seq"),
    )
    return ident.groupBy("write_key", "device_id").agg(latest.alias("s")).select(
        "write_key",
        "device_id",
        F.col("s.seq").alias("last_seq"),
        F.col("s.epoch").alias("epoch"),
        F.col("s.anonymous_id").alias("anonymous_id"),
        F.col("s.user_id").alias("user_id"),
        F.col("s.group_id").alias("group_id"),
        F.col("s.advertising_id").alias("advertising_id"),
        F.col("s.initialized").alias("initialized"),
        F.col("s.consent_state").alias("consent_state"),
        F.col("s.flush_epoch").alias("flush_epoch"),
    )


def alias_edges(events: DataFrame) -> DataFrame:
    """IDN6: link anonymous id → user id from alias events, with first time."""
    return (
        events.filter(F.col("type") == "alias")
        .groupBy(F.col("anonymousId").alias("anonymous_id"), F.col("userId").alias("user_id"))
        .agg(
            F.min("seq").alias("first_seq"),
            F.min(F.unix_micros("ts")).alias("first_ts_us"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def consent_audit(events: DataFrame) -> DataFrame:
    """IDN7: events per consent state and how many still carry an advertising
    id (must be none after withdrawal)."""
    return events.groupBy("consent_state").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count("advertising_id_state").alias("n_with_adid"),
    )


def disabled_drop(calls: DataFrame, attempts: DataFrame, *, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """FLT1: drop calls made after a fatal 401/403/404 answer until ``reset``.

    Calls and fatal attempts are merged per device in time order (attempts
    first on a tie); a running marker (fatal → 1, reset → 0) flags disabled
    rows. ``reset`` itself is never dropped. Run before identity: a dropped
    ``identify`` sets nothing. A hot device is chunked by time ranges.
    """
    fatal = attempts.filter(F.col("status").isin(*FATAL_STATUSES)).select(
        "device_id", F.col("attempt_ts").alias("__t"), F.lit(0).alias("__src"), F.lit(None).cast("bigint").alias("seq")
    )
    c = calls.withColumn("__t", F.col("ts")).withColumn("__src", F.lit(1))
    merged = c.unionByName(fatal, allowMissingColumns=True)
    marker = F.when(F.col("__src") == 0, F.lit(1)).when(F.col("call") == "reset", F.lit(0))
    flagged = running(
        merged,
        "device_id",
        ["__t", "__src", "seq"],
        last={"__off": marker},
        width=width,
    )
    return (
        flagged.filter((F.col("__src") == 1) & (F.coalesce(F.col("__off"), F.lit(0)) == 0))
        .drop("__t", "__src", "__off")
    )
