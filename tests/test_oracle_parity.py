"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from fleetlens.plans.catalog import queries
from fleetlens.plans.oracle import oracle_sql

TABLES = ["events", "lineitem", "pages"]
KEYS = sorted(oracle_sql())  # the optional operators have their own tests


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck(smoke_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed_rows_only():
    rows_only = set(queries()) - set(oracle_sql())
    assert rows_only == {"train_logistic"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, smoke_dir, key):
    sdf = E.queries()[key](spark, smoke_dir)
    rel = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(sdf.columns)
    s_rows = sorted((tuple(_norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    idx = [dcols.index(c) for c in order]
    d_rows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"as_of_date", "serial_number", "label_30d", "smart_5_raw_mean_7d", "year", "month"} <= set(df.columns)
