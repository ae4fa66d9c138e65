"""Every catalog query against its DuckDB oracle SQL on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans.oracle import ORACLE_SQL
from tessera.session import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert rows(got) == rows(want)


def test_entry(spark):
    assert E.entry(spark).count() > 0
