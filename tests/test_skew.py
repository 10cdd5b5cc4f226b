"""Skew: one key holds a third of the rows.  Plans must spread it, results must stay whole."""

import re

from pyspark.sql import functions as F

from martline.operators import rollup, topk


def hot_frame(spark, n=3000):
    rows = [("hot" if i % 3 == 0 else f"k{i % 97}", f"v{i % 500}", i) for i in range(n)]
    return spark.createDataFrame(rows, "k string, v string, x int"), rows


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)]


def test_distinct_count_shuffles_on_key_and_value_first(spark):
    df, rows = hot_frame(spark)
    out = rollup.rollup(df, ["k"], [("n", "nunique", "v"), ("s", "sum", "x")])
    ex = exchanges(out)
    assert any("k" in e and "v" in e for e in ex), ex      # (key, value) before the key-only exchange
    got = {r.k: (r.n, r.s) for r in out.collect()}
    hot = [r for r in rows if r[0] == "hot"]
    assert got["hot"] == (len({r[1] for r in hot}), sum(r[2] for r in hot))
    assert sum(s for _, s in got.values()) == sum(r[2] for r in rows)   # nothing dropped


def test_first_is_a_partial_aggregate_not_a_window(spark):
    df, _ = hot_frame(spark)
    out = rollup.rollup(df, ["k"], [("f", "first", "v")], order_by=["x"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "min_by" in plan
    assert {r.k: r.f for r in out.collect()}["hot"] == "v0"


def test_top_k_ranks_salted_subgroups_first(spark):
    df, rows = hot_frame(spark)
    out = topk.top_k(df, ["k"], [F.col("x").desc()], 3, salt_buckets=16)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    got = sorted(r.x for r in out.where("k = 'hot'").collect())
    assert got == sorted(r[2] for r in rows if r[0] == "hot")[-3:]
