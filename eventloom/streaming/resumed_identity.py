"""STR1 with typed state: per-device identity that resumes from a snapshot.

``transformWithStateInPandas`` keeps an entry of state a device, loads the
stored identity (IDN4) as initial state, and drops devices that were idle for
``ttl_ms``. A group of it is a bucket of devices (by a hash of their id; without an id, one
of its own) and the state a map of them, so that a call of Python handles many
devices: their rows of a micro-batch, sorted by device and seq, are handled as
columns. Each running value is the last row of the device that sets it, found by
a running maximum of row numbers, or the stored value before the first such row.
Output and late rows are those of :func:`eventloom.streaming.identity_state.identity_stream`.

With a stream of answers beside the calls, calls made while a fatal answer keeps
the client disabled (FLT1) are dropped before they can set anything. A device then
has a second entry of state: its last reset and the fatal answers after it.

Times go through Python as microseconds, since pandas' nanoseconds end in 2262.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType, _parse_datatype_string

from eventloom.functions.ids import anonymous_id
from eventloom.operators.identity import FATAL_STATUSES
from eventloom.streaming.identity_state import _CALL_NAMES, _STATE_NAMES, OUTPUT_SCHEMA, STATE_SCHEMA, _blank

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FRESH = (-(2**63), 0, True, None, None, None, "unknown", 0)
GATE_SCHEMA = "last_reset long, fatal array<long>"
_OPEN = (None, [])
DEVICE_SCHEMA = "device_id long"
#: Groups that devices are dealt to. Part of the state: a checkpoint is read with
#: the number that it was written with.
BUCKETS = 1024
_BUCKET = "device_bucket"
_NO_DEVICE = -1
#: A missing time, seq or device id among longs, which have no null in pandas.
_MISSING = -(2**63)
#: The ``call`` of a fatal answer's row among the calls.
ANSWER = "fatal answer"


def use_state_store(spark: SparkSession) -> None:
    """Typed state needs the RocksDB store in the session that starts the query."""
    spark.conf.set(_PROVIDER, STATE_STORE)


#: Settings of the store: commits write the changes, not whole files, and no row is
#: looked up only to count rows.
_STORE = {
    _PROVIDER: STATE_STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
_PARTITIONS = "spark.sql.shuffle.partitions"
#: A micro-batch opens and commits a store in each partition, however few rows it
#: holds, so a stream has this many a task slot, and at least so many, not as many as
#: the session's shuffles if these are more. A larger partition is sorted on disk.
STORES_A_SLOT = 3
LEAST_STORES = 48


def store_count(spark: SparkSession) -> int:
    """Partitions of a new stream's state, at most the session's shuffle partitions. A
    checkpoint keeps the number that it was begun with."""
    return min(int(spark.conf.get(_PARTITIONS)), max(LEAST_STORES, STORES_A_SLOT * spark.sparkContext.defaultParallelism))


@contextmanager
def state_store(spark: SparkSession):
    """:func:`use_state_store` and its settings for the queries started in the block only."""
    settings = _STORE | {_PARTITIONS: str(store_count(spark))}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _text(column: pd.Series) -> np.ndarray:
    return column.astype(object).where(column.notna(), None).to_numpy()


def _running(sets: np.ndarray, values: np.ndarray, first: np.ndarray, stored: np.ndarray) -> np.ndarray:
    """The value at the last row so far where ``sets``, not before the row ``first``
    of the same device, or ``stored``."""
    at = np.maximum.accumulate(np.where(sets, np.arange(len(sets)), -1))
    return np.where(at >= first, values[at], stored)


def _counted(sets: np.ndarray, first: np.ndarray, stored: np.ndarray) -> np.ndarray:
    n = np.cumsum(sets)
    return stored + n - (n - sets)[first]


def _column(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def advance_all(calls: pd.DataFrame, firsts: np.ndarray, states: list[tuple]) -> tuple[pd.DataFrame, list[tuple]]:
    """State columns of the ``calls`` of devices (one after the other, each ordered
    by seq, none late) after their ``states``, and the states after them. ``firsts``
    are the first rows of the devices."""
    device = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(calls))))
    first = firsts[device]
    _, epoch, ready, user, group, adid, consent, flushes = (_column(list(v))[device] for v in zip(*states, strict=True))
    call = calls["call"].to_numpy(object)
    nothing = np.full(len(calls), None, object)
    reset = call == "reset"
    users = _running(reset | (call == "identify"), np.where(call == "identify", _text(calls["user_id"]), nothing), first, user)
    groups = _running(reset | (call == "group"), np.where(call == "group", _text(calls["group_id"]), nothing), first, group)
    can = _running(reset | (call == "initialize"), (call == "initialize").astype(object), first, ready).astype(bool)
    given = _text(calls["advertising_id"])
    setter = call == "setAdvertisingId"
    grants = can & setter & np.array([v is not None and not _blank(v) for v in given], bool)
    withdraws = can & ((call == "clearAdvertisingId") | (setter & np.array([v is None for v in given], bool)))
    adids = _running(reset | grants | withdraws, np.where(grants, given, nothing), first, adid)
    consents = _running(
        reset | grants | withdraws, np.where(grants, "granted", np.where(withdraws, "withdrawn", "unknown")).astype(object), first, consent)
    epochs = _counted(reset, first, epoch.astype("int64"))
    flushes = _counted(call == "flush", first, flushes.astype("int64"))
    out = pd.DataFrame({
        "epoch": epochs, "initialized": can, "user_state": users, "group_state": groups, "advertising_id_state": adids,
        "consent_state": consents, "flush_epoch": flushes, "late": False})
    last = np.append(firsts[1:], len(calls)) - 1
    columns = (calls["seq"].to_numpy("int64"), epochs, can, users, groups, adids, consents, flushes)
    return out, list(zip(*(c[last].tolist() for c in columns), strict=True))


def advance(calls: pd.DataFrame, state: tuple) -> tuple[pd.DataFrame, tuple]:
    """:func:`advance_all` for one device."""
    out, after = advance_all(calls, np.array([0]), [state])
    return out, after[0]


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy("datetime64[us]").astype("int64")  # a missing time is first


def gate(calls: pd.DataFrame, answers: pd.DataFrame, state: tuple) -> tuple[np.ndarray, tuple]:
    """FLT1 for one device: which of its ``calls`` (none late) are kept, and
    ``(last reset, fatal answers)`` after them.

    A call is off if the latest fatal answer not after it is later than the last
    reset before it; of an answer and a call with one time the answer is first. A
    reset is never off. An answer after the calls seen so far waits in the state; of those
    already passed the first is enough, since a reset to come follows them all."""
    reset_at, waiting = state
    fatal = np.unique(np.concatenate([np.array(waiting, "int64"), _micros(answers["ts"])]))
    if reset_at is not None:
        fatal = fatal[fatal > reset_at]
    keep = np.ones(len(calls), bool)
    if len(calls):
        at = _micros(calls["ts"])
        order = np.lexsort((calls["seq"].to_numpy(), at))
        at, resets = at[order], (calls["call"].to_numpy(object) == "reset")[order]
        known = reset_at is not None
        rows = np.maximum.accumulate(np.where(resets, np.arange(len(at)), -1))
        before = np.concatenate([[-1], rows[:-1]])  # the last reset above each call
        since = np.where(before >= 0, at[before], reset_at if known else 0)
        last = np.searchsorted(fatal, at, side="right") - 1
        off = (last >= 0) & (((before < 0) & (not known)) | (np.append(fatal, 0)[last] > since))
        keep[order] = resets | ~off
        if rows[-1] >= 0:
            reset_at = int(at[rows[-1]])
            fatal = fatal[fatal > reset_at]
        passed = int(np.searchsorted(fatal, at[-1], side="right"))
        fatal = np.delete(fatal, slice(1, passed))
    return keep, (reset_at, fatal.tolist())


def _firsts(device: np.ndarray) -> np.ndarray:
    """First rows of the devices of sorted rows."""
    return np.flatnonzero(np.append(True, device[1:] != device[:-1])) if len(device) else np.zeros(0, int)


class IdentityProcessor(StatefulProcessor):
    def __init__(self, ttl_ms: int | None, gated: bool = False) -> None:
        self.ttl_ms, self.gated = ttl_ms, gated

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("identity", DEVICE_SCHEMA, STATE_SCHEMA, self.ttl_ms)
        self.begun: tuple = (None, {})
        if self.gated:
            self.gate = handle.getMapState("gate", DEVICE_SCHEMA, GATE_SCHEMA, None)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        if self.begun[0] != key:  # a bucket's rows may come in parts
            self.begun = (key, {})
        known, given = self.begun[1], {name: initialState[name].astype(object).where(initialState[name].notna(), None).tolist() for name in initialState}
        for row in zip(*(given[n] for n in ("device_id", "last_seq", "epoch", "initialized", "user_id", "group_id", "advertising_id",
                                            "consent_state", "flush_epoch")), strict=True):
            device, seq = int(row[0]), int(row[1])
            if device not in known or seq >= known[device][0]:
                known[device] = (seq, int(row[2]), bool(row[3]), *row[4:8], int(row[8]))
                self.state.updateValue((device,), known[device])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        frames = [p for p in rows if len(p)]
        if not frames:
            return
        calls = pd.concat(frames, ignore_index=True)[[_BUCKET, *_CALL_NAMES]]
        calls = calls.iloc[np.lexsort((calls["seq"].to_numpy("int64"), calls["device_id"].to_numpy("int64")))].reset_index(drop=True)
        waiting: dict[int, pd.DataFrame] = {}
        if self.gated:
            answer = (calls["call"] == ANSWER).to_numpy(bool)
            waiting = {int(d): a for d, a in calls[answer].groupby("device_id")}
            calls = calls[~answer].reset_index(drop=True)
        device, seq = calls["device_id"].to_numpy("int64"), calls["seq"].to_numpy("int64")
        firsts = _firsts(device)
        begun = self.begun[1] if self.begun[0] == key else {}  # just written, so not read again
        stored = {d: begun.get(d) or (tuple(s) if (s := self.state.getValue((d,))) else _FRESH) for d in device[firsts].tolist()}
        newest = np.repeat([stored[d][0] for d in device[firsts].tolist()], np.diff(np.append(firsts, len(calls)))).astype("int64")
        late = seq <= newest
        late[1:] |= (seq[1:] == seq[:-1]) & (device[1:] == device[:-1])
        if late.any():
            held = calls[late].reset_index(drop=True)
            nothing = pd.DataFrame(None, index=held.index, columns=_STATE_NAMES, dtype=object)
            yield pd.concat([held, nothing.assign(late=True)], axis=1)
        calls, device, seq = calls[~late].reset_index(drop=True), device[~late], seq[~late]
        firsts = _firsts(device)
        ends = np.append(firsts[1:], len(calls))[: len(firsts)]
        last_seq = dict(zip(device[firsts].tolist(), seq[ends - 1].tolist(), strict=True))
        if self.gated:
            keep = self._open(calls, dict(zip(device[firsts].tolist(), zip(firsts, ends, strict=True), strict=True)), waiting)
            calls, device = calls[keep].reset_index(drop=True), device[keep]
            firsts = _firsts(device)
        after = {}
        if len(calls):
            walked = device[firsts].tolist()
            columns, states = advance_all(calls, firsts, [stored[d] for d in walked])
            after = dict(zip(walked, states, strict=True))
        for d, newest_seq in last_seq.items():  # a dropped call sets nothing, but its repeats are late
            self.state.updateValue((d,), (newest_seq, *after.get(d, stored[d])[1:]))
        if len(calls):
            yield pd.concat([calls, columns[_STATE_NAMES]], axis=1)

    def _open(self, calls: pd.DataFrame, places: dict[int, tuple[int, int]], waiting: dict[int, pd.DataFrame]) -> np.ndarray:
        """Which ``calls`` are kept by :func:`gate`; ``places``: each device's first row and end."""
        keep = np.ones(len(calls), bool)
        at, kind = _micros(calls["ts"]), calls["call"].to_numpy(object)
        for d in {**places, **waiting}:
            a, b = places.get(d, (0, 0))
            value = self.gate.getValue((d,))
            before = (value[0], list(value[1])) if value else _OPEN
            if d in waiting or before[1]:
                keep[a:b], after = gate(calls.iloc[a:b], waiting.get(d, calls.iloc[:0]), before)
            else:  # no fatal answer so far
                resets = at[a:b][kind[a:b] == "reset"]
                after = (int(resets.max()), []) if len(resets) else before
            if after != before:
                self.gate.updateValue((d,), after)
        return keep

    def close(self) -> None:
        pass


def _longs(rows: DataFrame, *names: str) -> DataFrame:
    """``rows`` with their bucket, and ``names`` as longs without null."""
    device = F.col("device_id")
    bucket = F.when(device.isNull(), _NO_DEVICE).otherwise(F.pmod(F.xxhash64(device), F.lit(BUCKETS))).cast("long")
    return rows.withColumns({_BUCKET: bucket} | {n: F.coalesce(F.unix_micros(n) if n == "ts" else F.col(n), F.lit(_MISSING)) for n in ("device_id", *names)})


def resumed_identity(
    calls: DataFrame, snapshot: DataFrame | None = None, ttl_ms: int | None = None, answers: DataFrame | None = None
) -> DataFrame:
    """STR1: stateful identity over a call stream (or table), each device
    starting from its row of ``snapshot`` (:func:`identity_snapshot`; without a
    row, fresh). With ``ttl_ms`` a device without calls for that long starts
    fresh, and the query goes on making empty batches until it is stopped, also
    with ``availableNow``. Rows not after the stored ``seq``, and repeats of one, are ``late``
    and change nothing. ``answers`` (``device_id, attempt_ts, status``; a stream
    if the calls are one) drops calls made while disabled (:func:`gate`); a call
    that was emitted before its fatal answer came stays. See :func:`use_state_store`."""
    if answers is not None:
        fatal = answers.where(F.col("status").isin(*FATAL_STATUSES)).select(
            "device_id", F.col("attempt_ts").alias("ts"), F.lit(ANSWER).alias("call"))
        calls = calls.unionByName(fatal, allowMissingColumns=True)
    kept = _parse_datatype_string(OUTPUT_SCHEMA)
    columns = StructType([StructField(_BUCKET, LongType()), *(StructField("ts", LongType()) if f.name == "ts" else f for f in kept)])
    out = _longs(calls, "seq", "ts").groupBy(_BUCKET).transformWithStateInPandas(
        statefulProcessor=IdentityProcessor(ttl_ms, answers is not None), outputStructType=columns, outputMode="Append",
        timeMode="None" if ttl_ms is None else "ProcessingTime", initialState=_longs(snapshot).groupBy(_BUCKET) if snapshot is not None else None)
    out = out.withColumns({
        "device_id": F.when(F.col(_BUCKET) != _NO_DEVICE, F.col("device_id")), "seq": F.nullif("seq", F.lit(_MISSING)),
        "ts": F.timestamp_micros(F.nullif("ts", F.lit(_MISSING)))}).drop(_BUCKET)
    anonymous = F.when(F.col("initialized"), anonymous_id(F.col("device_id"), F.col("epoch"))).otherwise(F.lit("unknown"))
    return out.withColumn("anonymous_id", F.when(~F.col("late"), anonymous))


def run_to_table(stream: DataFrame, path: str) -> DataFrame:
    """Write all that a stream has now under ``path`` (rows and checkpoint) and
    read it back. The session's state store is set for the run only."""
    with state_store(stream.sparkSession):
        _run(stream, path)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")


def _run(stream: DataFrame, path: str) -> None:
    query = (stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
