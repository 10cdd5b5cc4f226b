"""Rows dealt by fine keys: shares that do not grow with the input, one shuffle, the same results."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martline.operators import joins, rollup
from martline.plans import quality, storage
from martline.plans.checks import Suite, total
from martline.sources import sinks

METRICS = [("n", "nunique", "v"), ("s", "sum", "x"), ("m", "money", "x"), ("c", "count", "v")]


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"Exchange hashpartitioning\(.*", plan)


def before_first_shuffle(df):
    """The operators below the lowest shuffle."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan[plan.rindex("Exchange hashpartitioning"):]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(f"k{i % 40}" if i % 9 else None, i % 3, f"v{i % 7}" if i % 5 else None, i % 11 if i % 4 else None) for i in range(900)],
                                 "k string, `j j` int, v string, x int").repartition(4)


@pytest.mark.parametrize("keep", [True, False])
def test_fine_rollup_is_the_plain_one_with_one_shuffle_of_plain_rows(spark, frame, keep):
    fine = rollup.rollup(frame, ["k", "j j"], METRICS, keep_null_keys=keep, fine=True)
    plain = rollup.rollup(frame, ["k", "j j"], METRICS, keep_null_keys=keep)
    assert fine.dtypes == plain.dtypes
    assert len(shuffles(fine)) == 1 < len(shuffles(plain)) and "Aggregate" not in before_first_shuffle(fine)
    assert sorted(map(str, fine.collect())) == sorted(map(str, plain.collect()))


def test_number_of_shares_follows_the_bytes_read(spark, tmp_path):
    spark.range(20_000).select(F.col("id").alias("k"), F.sha1(F.col("id").cast("string")).alias("t")).coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    size = rollup.read_bytes(df)
    assert 0.5 < size / sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet")) < 2
    assert rollup.dealt(df, ["k"], size // 10).rdd.getNumPartitions() in (10, 11, 12)
    assert rollup.read_bytes(df.union(df)) == 2 * size
    assert rollup.dealt(df.where("k < 0"), ["k"]).count() == 0


def test_grain_checks_hold_no_table_of_groups_before_the_shuffle(spark, frame):
    assert "Aggregate" not in before_first_shuffle(quality.duplicate_members(frame, ["k", "j j"]))
    assert quality.duplicate_members(frame, ["k", "j j"]).first().dups == 900
    suite = Suite().grain("t", ("k", "j j")).filled("t").totals("t", ("t", total("x")), ("t", total("x")))
    out = suite.rows(spark, {"t": frame})
    assert "Aggregate" not in before_first_shuffle(out)
    assert {(r.check, r.status, r.detail) for r in out.collect()} == {("grain", "FAIL", "900"), ("empty_columns", "PASS", ""), ("reconcile", "PASS", "0.00")}


def test_outputs_made_row_by_row_are_written_as_they_come(spark, tmp_path, monkeypatch):
    df = spark.sql("SELECT date_add(date'2024-01-30', CAST(id % 60 AS INT)) AS date, id AS v FROM range(500) UNION ALL SELECT NULL, -1")
    hints = []
    real = sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda d, p, **kw: (hints.append((os.path.basename(p), kw.get("gather", True))), real(d, p, **kw)))
    got = storage.two_outputs(df, {"detail": lambda d: d.withColumn("w", F.col("v") * 2), "daily": lambda d: d.groupBy("date").agg(F.sum("v").alias("v"))}, row_by_row=("detail",))
    assert {(r.table_name, r.n_rows) for r in got.collect()} == {("clean", 501), ("detail", 501), ("daily", 61)}
    assert hints == [("clean", True), ("detail", False), ("daily", True)]
    paths = sinks.write_outputs(df, "clean", {"detail": lambda d: d}, str(tmp_path), by_month="date", row_by_row=("detail",))
    assert sorted(map(str, sinks.read_table(spark, paths["detail"], "date", "2024-02-01", "2024-02-29").collect())) == \
        sorted(map(str, df.where("date BETWEEN '2024-02-01' AND '2024-02-29'").collect()))


@pytest.mark.skipif(not os.path.exists(f"{SF_SMALL}/lineitem.parquet"), reason="no driver tables")
def test_ecommerce_daily_shuffles_its_lines_once_by_the_grain(spark, monkeypatch):
    from martline.plans import facts
    from martline.sources import views
    monkeypatch.setattr(rollup.dealt, "__defaults__", (10_000,))  # the small tables fill one share
    daily = facts.ecommerce_daily(facts.ecommerce_clean(views.v_txn.__wrapped__(spark, SF_SMALL)))
    assert len([s for s in shuffles(daily) if s.startswith("Exchange hashpartitioning(date#")]) == 1


def executed(df):
    """The rows, and the plan as it ran."""
    rows = sorted(map(str, df.collect()))
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_rows_spread_over_days_are_not_shuffled_for_their_grain(spark, monkeypatch):
    from martline.operators.overlap import expand_period
    monkeypatch.setattr(rollup.dealt, "__defaults__", (100,))  # the few rows fill one share
    weekly = spark.sql("SELECT date_add(date'2024-01-01', CAST(7 * (id % 5) AS INT)) AS week, 'AP' || CAST(id % 8 AS STRING) AS code, IF(id = 3, NULL, CAST(id AS DOUBLE)) AS spend, "
                       "IF(id % 2 = 0, 'x', NULL) AS form FROM range(78)")
    weekly = weekly.unionByName(weekly.where("code = 'AP1'").withColumn("code", F.lit(None).cast("string")))
    keys = ("date", "code", "form")
    suite = lambda: Suite().dated(t="date").exists("t").grain("t", keys).filled("t").totals("t", ("t", total("spend")), ("t", total("spend"))).alignment("t", "t", "t", [("n", total("spend"), total("spend"))])
    plain, before = executed(suite().rows(spark, {"t": expand_period(weekly, "week", 7, ("spend",))}))
    rows, plan = executed(suite().dealt("t").rows(spark, {"t": expand_period(rollup.dealt(weekly, ["code"]), "week", 7, ("spend",))}))
    assert rows == plain and any("grain" in r and "FAIL" in r for r in rows)
    wide = r"Exchange hashpartitioning\(date#\d+, code"
    assert re.search(wide, before) and not re.search(wide, plan) and "Exchange hashpartitioning(code" in plan
    # a table that does not come dealt after all is grouped right nevertheless
    assert executed(suite().dealt("t").rows(spark, {"t": expand_period(weekly, "week", 7, ("spend",))}))[0] == plain


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small tables of the driver's schema with unmatched, null and repeated keys."""
    d = str(tmp_path_factory.mktemp("tables"))
    ts = "CAST(timestamp_ntz'1998-01-10 05:00:00' + make_interval(0, 0, 0, CAST({} AS INT)) AS timestamp_ntz)"
    made = {
        "region": "SELECT CAST(id AS INT) AS r_regionkey, 'REGION_' || id AS r_name FROM range(5)",
        "nation": "SELECT CAST(id AS INT) AS n_nationkey, 'NATION_' || id AS n_name, CAST(id % 5 AS INT) AS n_regionkey FROM range(25)",
        "customer": "SELECT id AS c_custkey, 'c' || id AS c_name, IF(id = 4, NULL, CAST(id % 26 AS INT)) AS c_nationkey, 1.5D AS c_acctbal, 'M' AS c_mktsegment FROM range(40)",
        "supplier": "SELECT id % 11 AS s_suppkey, 'Supplier ' || id AS s_name, CAST(id % 25 AS INT) AS s_nationkey, CAST(id - 3 AS DOUBLE) AS s_acctbal FROM range(12)",
        "part": "SELECT id % 29 AS p_partkey, 'p' || id AS p_name, 'B' AS p_brand, IF(id = 5, NULL, 'T' || id % 3) AS p_type, CAST(id % 50 AS INT) AS p_size, 900.0D + id AS p_retailprice FROM range(30)",
        "orders": f"SELECT IF(id = 7, NULL, id % 95) AS o_orderkey, id % 43 AS o_custkey, 'O' AS o_orderstatus, 1.0D AS o_totalprice, {ts.format('id % 60')} AS o_orderdate, 'x' AS o_orderpriority FROM range(100)",
        "lineitem": f"SELECT IF(id = 9, NULL, id % 101) AS l_orderkey, id % 31 AS l_partkey, IF(id = 12, NULL, id % 12) AS l_suppkey, CAST(id % 7 AS INT) AS l_linenumber, CAST(id % 50 AS DOUBLE) AS l_quantity, "
                    f"100.25D * (id % 13) AS l_extendedprice, IF(id = 20, NULL, (id % 11) / 100D) AS l_discount, 0.0D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, IF(id = 30, NULL, {ts.format('id % 90')}) AS l_shipdate FROM range(600)",
        "events": f"SELECT id AS event_id, {ts.format('9496 + id % 20')} AS ts, id % 17 AS user_id, element_at(array('click', 'view', 'signup', 'purchase', 'error'), CAST(id % 5 AS INT) + 1) AS event_type, "
                  "CAST(id % 40 AS DOUBLE) AS value, '{\"k\": ' || id % 80 || '}' AS props FROM range(300)",
    }
    for name, sql in made.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_shared_views_have_the_rows_of_the_plain_ones(spark, tables, no_broadcast):
    from martline.plans import warehouse as wh
    from martline.sources import views
    for plain, shared in ((views.v_txn(spark, tables), views.v_txn(spark, tables, True)), (views.v_ooh_weekly(spark, tables), views.v_ooh_weekly(spark, tables, True)),
                          *((wh.table_by_name(spark, tables, n), wh.suite_table(spark, tables, n)) for n in ("fact_ecommerce_transactions", "fact_ecommerce_daily", "fact_ooh_daily", "dim_geography"))):
        assert plain.dtypes == shared.dtypes
        rows = sorted(map(str, plain.collect()))
        assert rows == sorted(map(str, shared.collect())) and rows


@pytest.mark.parametrize("name", ["dq_suite", "dq_summary"])
def test_suite_shuffles_the_lines_of_a_stream_once(spark, tables, no_broadcast, monkeypatch, name):
    from martline import registry
    monkeypatch.setattr(rollup.dealt, "__defaults__", (2_000,))
    monkeypatch.setattr(joins.sized_join, "__defaults__", ("inner", -1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan that shows what is reused before it runs
    try:
        plan = registry.QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    made = re.findall(r"[+:]- Exchange hashpartitioning\(([a-z_]+)#\w+(?:, ([a-z_]+)#)?", plan)  # a reused one stands after its own mark
    assert made.count(("l_orderkey", "")) == made.count(("l_partkey", "")) == 1
    assert ("date", "airport_code") not in made
    # the weekly rows are joined to the airports where they lie, in shares that follow the input
    weekly = re.findall(r"[+:]- Exchange hashpartitioning\(airport_code#\w+, (\d+)\), REPARTITION_BY_NUM", plan)
    assert weekly == re.findall(r"[+:]- Exchange hashpartitioning\(week_start_date#\w+, l_suppkey#\w+, (\d+)\)", plan)
    assert len(weekly) == 1 and weekly != [spark.conf.get("spark.sql.shuffle.partitions")]


def test_suite_of_shared_tables_has_the_rows_of_single_ones(spark, tables):
    from collections import Counter

    from martline import registry
    from martline.plans import warehouse as wh
    from martline.sources import views
    derived = {"lineitem": lambda s, d: views.table(s, d, "lineitem"), "events": lambda s, d: views.table(s, d, "events"), "raw_txn": wh.transactions_clean,
               "raw_paid": views.paid_raw, "raw_ooh_weekly": views.v_ooh_weekly, "raw_web_parts": views.v_web_parts}
    single = registry.warehouse_suite().rows(spark, lambda n: derived[n](spark, tables) if n in derived else wh.table_by_name(spark, tables, n)).collect()
    assert sorted(registry.QUERIES["dq_suite"](spark, tables).collect()) == sorted(single)
    assert {r.status: r.checks for r in registry.QUERIES["dq_summary"](spark, tables).collect()} == Counter(r.status for r in single) + Counter(TOTAL=len(single))
    assert {r.status for r in single} == {"PASS", "FAIL"}
