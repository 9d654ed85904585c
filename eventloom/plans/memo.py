"""Reuse of built DataFrame plans within one session.

Building a plan from Python costs thousands of JVM round trips; queries that
share a stage (calls → identity → events, attempts → breaker replay) reuse the
same lazy DataFrame instead of rebuilding it. Only plans are kept, no data; the
key includes the session and the input folder.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_PLANS: dict[tuple, DataFrame] = {}


def _session_key(spark: SparkSession) -> tuple:
    return (id(spark), spark.sparkContext.applicationId)


def plan(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str, *args, **kw) -> DataFrame:
        key = (fn.__module__, fn.__qualname__, _session_key(spark), sf_dir, args, tuple(sorted(kw.items())))
        df = _PLANS.get(key)
        if df is None:
            df = fn(spark, sf_dir, *args, **kw)
            _PLANS[key] = df
        return df

    return wrapper


def clear() -> None:
    _PLANS.clear()
