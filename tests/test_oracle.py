"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF_SMALL}/lineitem.parquet"), reason="no driver tables")

import __spark_entry__ as entry  # noqa: E402

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from tools.check_oracle import register_tables
    con = duckdb.connect()
    register_tables(con, SF_SMALL)
    yield con
    con.close()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "gross_revenue" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    import tools.check_oracle as co
    from tools.check_oracle import compare
    co.STRICT = True  # floats must match bit for bit
    sdf = QUERIES[name](spark, SF_SMALL)
    if name not in SQL:
        assert sdf.count() >= 0
        return
    problems, _ = compare(sdf, duck, SQL[name])
    assert not problems, problems
