"""Masking expressions (GOV1, GOV2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_key(key: Column) -> Column:
    """GOV1: ``***`` + last 4 characters when longer than 4, else ``***``."""
    return F.when(F.length(key) > 4, F.concat(F.lit("***"), F.substring(key, -4, 4))).otherwise(F.lit("***"))


def redact_id(value: Column) -> Column:
    """GOV2: first 8 characters + ``***``; NULL becomes ``undefined``."""
    return F.coalesce(F.concat(F.substring(value, 1, 8), F.lit("***")), F.lit("undefined"))
