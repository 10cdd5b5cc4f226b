"""Operators that SQL can express, against DuckDB on the same table."""

import os

import duckdb
import pandas as pd
import pytest

from martline.llm.oracles import ORACLES
from martline.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(DIR, table + '.parquet')}'")
    want = con.execute(ORACLES[name]).fetchdf()
    got = QUERIES[name](spark, DIR).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    key = "doc_id" if "doc_id" in cols else "conv_id"
    pd.testing.assert_frame_equal(got[cols].sort_values(key, ignore_index=True), want[cols].sort_values(key, ignore_index=True))
