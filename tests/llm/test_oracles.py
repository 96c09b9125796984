import sys
from pathlib import Path

import duckdb
import pytest

from tests.llm.conftest import SF
from tillpoint.llm.queries import ORACLE_SQL, QUERIES
from tillpoint.sources.tables import TABLES

sys.path.insert(0, str(Path(__file__).parents[2] / "tools"))
from compare import key, rows_of  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    columns, rows = rows_of(QUERIES[name](spark, SF).toPandas())
    wanted, expected = rows_of(con.execute(ORACLE_SQL[name]).df())
    assert columns == wanted and sorted(rows, key=key) == sorted(expected, key=key)
