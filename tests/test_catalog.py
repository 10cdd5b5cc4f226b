"""SQL access through temp views, bucketed writes, and the command line."""

import os

import pytest

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF_SMALL}/lineitem.parquet"), reason="no driver tables")


def test_sql_over_registered_warehouse(spark):
    from martline.catalog import register_warehouse
    names = register_warehouse(spark, SF_SMALL)
    assert "fact_ecommerce_daily" in names and "cross_channel_daily" in names
    a = spark.sql("SELECT sum(line_items) AS n FROM fact_ecommerce_daily").collect()[0].n
    b = spark.sql("SELECT count(*) AS n FROM fact_ecommerce_transactions").collect()[0].n
    assert a == b
    r = spark.sql("""SELECT d.season_flag, count(*) AS days FROM cross_channel_daily c
                     JOIN dim_date d ON c.date = d.date GROUP BY d.season_flag""").collect()
    assert sum(x.days for x in r) == spark.table("dim_date").count()

def test_cli_list(capsys):
    from martline.__main__ import main
    assert main(["list"]) == 0
    assert "ecommerce_daily" in capsys.readouterr().out


def test_cli_query_and_profile(tmp_path, capsys):
    from martline.__main__ import main
    out = str(tmp_path / "q")
    assert main(["query", "promo_impact", "--sf", SF_SMALL, "--out", out]) == 0
    assert any(f.endswith(".parquet") for f in os.listdir(out))
    d = tmp_path / "raw"
    d.mkdir()
    (d / "paid_a_part1.csv").write_text("date,channel,spend\n2024-01-01,A,1.5\n")
    (d / "paid_a_part2.csv").write_text("date,channel,spend_usd\n2024-01-02,A,2.0\n")
    assert main(["profile", str(d)]) == 0
    printed = capsys.readouterr().out
    assert "== inventory" in printed and "spend_usd" in printed
