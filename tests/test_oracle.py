"""Every registered query against its DuckDB oracle on the smallest test tables.

This mirrors the driver's correctness gate (row count, column names, order-insensitive
values) at sf0.001 so it runs in the unit suite.
"""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
from compare import key, rows_of  # noqa: E402

from tillpoint.plans.oracle import ORACLE_SQL  # noqa: E402
from tillpoint.plans.registry import QUERIES  # noqa: E402
from tillpoint.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE = ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(sdf.columns) > 0
        return
    odf = duck.execute(ORACLE[name]).df()
    sc, sr = rows_of(sdf)
    oc, orr = rows_of(odf)
    assert sc == oc
    assert len(sr) == len(orr)
    assert sorted(sr, key=key) == sorted(orr, key=key)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "total_revenue"]
    assert df.count() > 0
