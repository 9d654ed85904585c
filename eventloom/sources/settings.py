"""Settings check (SRC3): one row per configured client, valid or rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settings_check(settings: DataFrame) -> DataFrame:
    """Clean and validate client settings.

    The host is trimmed of spaces and newlines and one trailing ``/`` is cut;
    a host without a scheme, an empty write key, or a host still ending in
    ``/`` is rejected (checked in that order). Flush interval and queue size
    are floored at 1.
    """
    trimmed = F.regexp_replace(F.col("ingestion_host"), r"^\s+|\s+$", "")
    host = F.regexp_replace(trimmed, "/$", "")
    has_scheme = host.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    reason = (
        F.when(~has_scheme, F.lit("invalid host"))
        .when(F.length(F.col("write_key")) == 0, F.lit("empty write key"))
        .when(host.endswith("/"), F.lit("host ends with slash"))
    )
    return settings.select(
        "write_key",
        host.alias("host_clean"),
        F.greatest(F.lit(1), F.col("flush_interval_seconds")).cast("bigint").alias("flush_interval_seconds"),
        F.greatest(F.lit(1), F.col("max_queue_events")).cast("bigint").alias("max_queue_events"),
        reason.isNull().alias("valid"),
        reason.alias("reason"),
    )
