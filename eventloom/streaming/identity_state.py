"""STR1: per-device identity state on Structured Streaming.

``groupBy(device_id).applyInPandasWithState`` keeps one small state row per
device (epoch, readiness, user, group, advertising id, consent, last seq) in
the state store and walks that device's new calls in ``seq`` order. The output
equals the batch operator :func:`eventloom.operators.identity.identity_asof`
when the stream is replayed with ``availableNow``. Rows with a ``seq`` not
above the stored one are late: they pass through with ``late = true`` and do
not change the state.

The per-call walk is a short loop over one device's rows of one micro-batch;
Spark partitions and shuffles the devices, and the anonymous id is computed
afterwards with the same built-in expression as the batch path.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from eventloom.functions.ids import anonymous_id

CALL_COLUMNS = [
    "write_key string", "device_id long", "seq long", "ts timestamp", "call string", "name string",
    "user_id string", "group_id string", "advertising_id string", "previous_id string",
    "payload_json string", "timestamp string",
]
STATE_COLUMNS = [
    "epoch long", "initialized boolean", "user_state string", "group_state string",
    "advertising_id_state string", "consent_state string", "flush_epoch long", "late boolean",
]
OUTPUT_SCHEMA = ", ".join(CALL_COLUMNS + STATE_COLUMNS)
_CALL_NAMES = [c.split()[0] for c in CALL_COLUMNS]
_STATE_NAMES = [c.split()[0] for c in STATE_COLUMNS]
STATE_SCHEMA = (
    "last_seq long, epoch long, initialized boolean, user_state string, group_state string, "
    "advertising_id_state string, consent_state string, flush_epoch long"
)


def _blank(text: str) -> bool:
    # Spaces and tabs only; a newline is not blank for this check.
    return all(ch == "\t" or unicodedata.category(ch) == "Zs" for ch in text)


def _fresh() -> list:
    return [-(2**63), 0, True, None, None, None, "unknown", 0]


def _step(state: list, call: str, user_id, group_id, adid) -> None:
    """Apply one call to ``[last_seq, epoch, initialized, user, group, adid, consent, flushes]``."""
    if call == "flush":
        state[7] += 1
    elif call == "reset":
        state[1] += 1
        state[2] = False
        state[3] = state[4] = state[5] = None
        state[6] = "unknown"
    elif call == "initialize":
        state[2] = True
    elif call == "identify":
        state[3] = user_id
    elif call == "group":
        state[4] = group_id
    elif call == "setAdvertisingId" and state[2]:
        if adid is None:
            state[5], state[6] = None, "withdrawn"
        elif not _blank(adid):
            state[5], state[6] = adid, "granted"
    elif call == "clearAdvertisingId" and state[2]:
        state[5], state[6] = None, "withdrawn"


def _update(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    st = list(state.get) if state.exists else _fresh()
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return
    pdf = pd.concat(frames, ignore_index=True).sort_values("seq", kind="stable").reset_index(drop=True)
    rows = []
    for seq, call, uid, gid, adid in zip(pdf["seq"], pdf["call"], pdf["user_id"], pdf["group_id"], pdf["advertising_id"]):
        uid = None if pd.isna(uid) else uid
        gid = None if pd.isna(gid) else gid
        adid = None if pd.isna(adid) else adid
        if seq <= st[0]:
            rows.append((None, None, None, None, None, None, None, True))
            continue
        _step(st, call, uid, gid, adid)
        st[0] = seq
        rows.append((st[1], st[2], st[3], st[4], st[5], st[6], st[7], False))
    state.update(tuple(st))
    out = pd.concat([pdf[_CALL_NAMES], pd.DataFrame(rows, columns=_STATE_NAMES)], axis=1)
    yield out


def identity_stream(calls: DataFrame) -> DataFrame:
    """Stateful identity over a (streaming or batch) call DataFrame."""
    out = calls.groupBy("device_id").applyInPandasWithState(
        _update, OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )
    return out.withColumn(
        "anonymous_id",
        F.when(F.col("late"), F.lit(None)).when(F.col("initialized"), anonymous_id(F.col("device_id"), F.col("epoch"))).otherwise(F.lit("unknown")),
    )
