"""Every registered query against its SQL in DuckDB, whole tables, smallest data set."""

import collections
import contextlib
import io
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from lectern.registry import CHECKS, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "DOUBLE": "double",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def plan_text(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_windows_and_columns_reach_the_scan(spark):
    plan = plan_text(entry_module.queries()["date_window_filter"](spark, FOLDER))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    plan = plan_text(entry_module.queries()["seat_occupancy"](spark, FOLDER))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_every_query_has_a_check():
    assert set(CHECKS) == set(QUERIES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "BatchEvalPython" not in plan
    want = duck.sql(entry_module.oracle_sql()[name])
    kinds = {c: str(t) for c, t in zip(want.columns, want.types)}
    assert dict(df.dtypes) == {c: KINDS.get(t, t.lower()) for c, t in kinds.items()}
    cols = df.columns
    at = [want.columns.index(c) for c in cols]
    got = collections.Counter(tuple(r) for r in df.collect())
    assert got == collections.Counter(tuple(r[i] for i in at) for r in want.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
