"""Column expressions for ids (MID1-MID3, IDN2).

Ids are derived from the row's key and sequence with ``md5`` instead of a
random UUID, so a retried task, a replayed stream batch and the SQL oracle all
produce the same id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: message id shape --------------------------------------
# "<epoch millis>-<8 hex>-<4 hex>-<4 hex>-<4 hex>-<12 hex>"
UUID_PATTERN = "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
MESSAGE_ID_PATTERN = "^[+]?[0-9]+-" + UUID_PATTERN + "$"
INT64_TEXT = "^[+-]?[0-9]+$"
# ----------------------------------------------------------------------------


def uuid_from(*parts: Column) -> Column:
    """Lower-case 8-4-4-4-12 text of ``md5(part1:part2:...)``."""
    h = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def epoch_millis(ts: Column) -> Column:
    """Whole milliseconds since the epoch, cut toward zero like the reference."""
    return F.unix_millis(ts)


def message_id(ts: Column, *key: Column) -> Column:
    """MID1: ``<epochMillis>-<UPPER-CASE UUID>``."""
    return F.concat(epoch_millis(ts).cast("string"), F.lit("-"), F.upper(uuid_from(*key)))


def anonymous_id(device_id: Column, epoch: Column) -> Column:
    """IDN2: one lower-case UUID per device and reset epoch."""
    return uuid_from(device_id, epoch)


def _int64(text: Column) -> Column:
    """Strict Int64 parse: optional sign and digits only; NULL otherwise or on overflow."""
    return F.when(text.rlike(INT64_TEXT), text.try_cast("bigint"))


def message_id_is_valid(mid: Column) -> Column:
    """MID2: six dash-separated parts, the first an Int64, the rest a UUID."""
    first = F.split(mid, "-").getItem(0)
    return F.coalesce(mid.rlike(MESSAGE_ID_PATTERN) & _int64(first).isNotNull(), F.lit(False))


def message_id_millis(mid: Column) -> Column:
    """MID3: epoch millis inside the id; NULL if part 0 is not an Int64."""
    return _int64(F.split(mid, "-").getItem(0))
