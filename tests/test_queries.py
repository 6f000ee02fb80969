"""Every registered query with SQL against DuckDB, over the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from harvestry.plans import oracles, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables aren't here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(df):
    def text(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
            return "NULL"
        return str(int(x)) if isinstance(x, float) and x == int(x) else str(x)

    rows = df[sorted(df.columns)].map(text)
    return rows.sort_values(list(rows.columns)).reset_index(drop=True)


def test_each_query_has_its_sql():
    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    got, want = plain(queries.queries()[name](spark, SF).toPandas()), plain(duck.sql(oracles.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(got, want)


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@needs_tables
def test_scans_read_only_what_they_need(spark):
    plan = queries.feed_per_source(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "user_id" not in plan and "props" not in plan
    plan = queries.new_refs_anti(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "text" not in plan
