"""Every registered query equals its DuckDB oracle at sf0.001 (the driver's
check runs the same at sf0.01); entry() runs on sf0.001."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
import eventloom.plans.scan as scan
from eventloom.plans import memo
from eventloom.plans.catalog import REGISTRY
from eventloom.plans.oracle import ORACLE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NO_ORACLE: set[str] = set()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(str(_norm(r[c])) for c in cols) for r in df.to_dict("records")))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_small) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(REGISTRY) - set(ORACLE) == NO_ORACLE
    assert set(REGISTRY) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"message_id", "type", "user_id", "anonymous_id"} <= set(df.columns)


@pytest.fixture(params=["whole", "split"])
def layout(request, spark, monkeypatch):
    """Every query with keys whole, and split into chunks of a few rows."""
    memo.clear()
    if request.param == "split":
        monkeypatch.setattr(scan, "SEQ_WIDTH", 7)
        monkeypatch.setattr(scan, "TIME_WIDTH_US", 3600 * 1_000_000)
        spark.conf.set(scan.SPLIT_CONF, "true")
    yield request.param
    spark.conf.unset(scan.SPLIT_CONF)
    memo.clear()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - NO_ORACLE))
def test_query_matches_oracle(spark, duck, sf_small, name, layout):
    got = E.queries()[name](spark, sf_small).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
