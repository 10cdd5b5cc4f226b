"""Key discovery against every subset of columns."""

import itertools
import random

import pytest

from martline.operators import keys


def brute(rows, cols, most):
    found = []
    for size in range(1, most + 1):
        for c in itertools.combinations(range(len(cols)), size):
            if not any(set(k) <= set(c) for k in found) and len({tuple(r[i] for i in c) for r in rows}) == len(rows):
                found.append(c)
    return [tuple(cols[i] for i in c) for c in found]


@pytest.mark.parametrize("seed,at_once", [(1, 64), (2, 3), (3, 1)])
def test_minimal_keys(spark, seed, at_once):
    rng = random.Random(seed)
    rows = list({(rng.randrange(4), rng.choice(["x", "y", None]), rng.randrange(6), rng.choice([None, 1.5, 2.5, 3.5]), rng.randrange(3)) for _ in range(40)})
    cols = ["a", "b", "c c", "d", "e"]
    df = spark.createDataFrame(rows, "a int, b string, `c c` int, d double, e int").repartition(3)
    assert keys.minimal_keys(df, max_size=5, at_once=at_once) == brute(rows, cols, 5)


def test_nulls_are_equal_and_do_not_trade_places(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, None)], "a int, b int")
    assert keys.minimal_keys(df) == [("a", "b")]
    assert keys.minimal_keys(df.unionByName(df)) == []


def test_pruning_leaves_out_supersets_and_small_products(spark, monkeypatch):
    df = spark.range(1000).selectExpr("id", "id % 10 AS x", "id % 7 AS y", "id div 10 AS z")
    seen = []
    counted = keys._counted
    monkeypatch.setattr(keys, "_counted", lambda d, c: seen.extend(c) or counted(d, c))
    assert keys.minimal_keys(df, max_size=3) == [("id",), ("x", "z")]
    assert seen == [("id",), ("x",), ("y",), ("z",), ("x", "z")]  # x, y: 70 combinations; y, z: 700; nothing with id or x, z


def test_few_rows(spark):
    assert keys.minimal_keys(spark.range(0)) == [()] and keys.minimal_keys(spark.range(1)) == [()]
    report = keys.key_report(spark, {"t": spark.range(3), "none": spark.createDataFrame([(1,), (1,)], "a int")}).collect()
    assert [tuple(r) for r in report] == [("t", "id", 1)]


def test_pairs_with_many_equal_rows_are_disproved_by_a_slice_of_their_values(spark, monkeypatch):
    df = spark.range(30_000).selectExpr("id % 20000 AS a", "id % 15000 AS b", "id % 1000 AS c", "if(id = 7, 8, id) AS near", "'x' AS d")
    seen = []
    counted = keys._counted
    monkeypatch.setattr(keys, "_counted", lambda d, c: seen.extend(c) or counted(d, c))
    # a and c repeat every 20000 rows; b and near repeat nowhere or once, which a slice need not show
    assert keys.minimal_keys(df, max_size=2) == [("a", "b"), ("a", "near"), ("b", "near"), ("c", "near")]
    assert ("a", "c") not in seen and ("b", "c") not in seen and {("a", "b"), ("b", "near")} <= set(seen)


def test_one_pair_of_equal_rows_outside_the_slice_is_found(spark, monkeypatch):
    monkeypatch.setattr(keys, "SLICES", 1 << 40)  # nothing lies in the slice
    df = spark.range(3000).selectExpr("if(id = 9, 8, id) AS a", "id div 10 AS b", "id AS c")
    assert keys.minimal_keys(df.drop("c"), max_size=2) == []
    assert keys.minimal_keys(df.drop("a"), max_size=2) == [("c",)]
