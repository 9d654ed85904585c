"""Masked copies of event tables for sharing (GOV1, GOV2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.masks import mask_key, redact_id


def masked_events(events: DataFrame, key_col: str = "write_key", adid_col: str = "advertising_id_state") -> DataFrame:
    """Add ``masked_write_key`` and ``redacted_adid``; a pure projection."""
    return events.withColumn("masked_write_key", mask_key(F.col(key_col))).withColumn(
        "redacted_adid", redact_id(F.col(adid_col))
    )
