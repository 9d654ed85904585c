"""Broadcast bounds: by rows, and by bytes where a column has no fixed width."""

import pytest
from pyspark.sql import functions as F

from eventloom.llm.common import sized


def sent(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("n, width, expected", [(10, 5, True), (11, 5, False), (10, 200, False), (0, 5, True)])
def test_sized_by_rows_and_bytes(spark, n, width, expected):
    table = spark.range(n).select("id", F.repeat(F.lit("é"), width).alias("words"), F.array(F.lit(None).cast("string")).alias("nulls"))
    assert sent(sized(table, rows=10, size=1000)) is expected


def test_fixed_widths_need_no_sum(spark):
    assert sent(sized(spark.range(10), rows=10, size=1))
    assert not sent(sized(spark.range(11), rows=10, size=1))
