"""Overlapping ranges in cells against all pairs."""

import datetime as dt
import random

import pytest

from martline.operators import intervals, joins


def pairs(rows):
    """Every pair of distinct ranges of one group that share a moment."""
    rows = sorted({r for r in rows if None not in r[2:] and r[2] <= r[3]}, key=lambda r: (r[0] is not None, r))
    out = []
    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            if a[0] == b[0] and a[2] <= b[3] and b[2] <= a[3]:
                x, y = sorted([a[1:], b[1:]])
                out.append((a[0], x[0], y[0], max(x[1], y[1]), min(x[2], y[2])))
    return sorted(out, key=str)


def run(spark, rows, kind):
    df = spark.createDataFrame(rows, f"g string, id string, s {kind}, e {kind}").repartition(3)
    return sorted((tuple(r) for r in joins.interval_pairs(df, "id", "s", "e", ["g"]).collect()), key=str)


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_equals_all_pairs(spark, kind):
    rng = random.Random(3)
    rows = []
    for i in range(90):
        days = rng.choice([0, 0, 1, 3, 40, 900, 36_500])
        s = dt.datetime(1999, 12, 25) + dt.timedelta(days=rng.randrange(60), microseconds=rng.randrange(1 << 36) if rng.random() < 0.7 else 0)
        e = s + dt.timedelta(days=days, microseconds=rng.choice([0, 1, 999]))
        row = (rng.choice(["a", "b", None]), f"f{i % 70}", s, e)
        rows.append(tuple(x.date() if kind == "date" and isinstance(x, dt.datetime) else x for x in row))
    edge = dt.date(1969, 12, 31) if kind == "date" else dt.datetime(1969, 12, 31, 23, 59, 59, 999_999)
    step = dt.timedelta(days=1) if kind == "date" else dt.timedelta(microseconds=1)
    rows += [("a", "x", edge, edge), ("a", "y", edge, edge), ("a", "z", edge + step, edge + step), ("a", "w", edge, edge + step), ("a", "back", edge + step, edge),
             ("b", "n", None, edge), ("b", "m", edge, None), ("a", "x", edge, edge)]
    got = run(spark, rows, kind)
    assert got == pairs(rows) and len(got) > 300


def test_time_of_day_and_centuries_make_few_rows(spark):
    rows = [("a", f"f{i}", dt.datetime(1900, 1, 1) + dt.timedelta(hours=i), dt.datetime(2100, 1, 1, 13, 30, 0, i)) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, id string, s timestamp_ntz, e timestamp_ntz")
    assert intervals.overlapping(df, "id", "s", "e").count() == 40 * 39 // 2
    first = intervals.units(df.s, "timestamp_ntz")[0].alias("_first")
    last = intervals.units(df.e, "timestamp_ntz")[0].alias("_last")
    cells = df.select(first, last).select(intervals.range_cells(None, None, 31).alias("c")).collect()
    assert max(len(r.c) for r in cells) <= 2 * 3 * 31


def test_far_dates_are_exact(spark):
    s, e = dt.datetime(9999, 1, 1, 0, 0, 0, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999_999)
    rows = [("a", "x", s, e), ("a", "y", e, e), ("a", "z", dt.datetime(9998, 1, 1), s - dt.timedelta(microseconds=1)), ("a", "w", dt.datetime(1, 1, 1), s)]
    assert run(spark, rows, "timestamp_ntz") == pairs(rows)


def test_cover_is_exact(spark):
    rng = random.Random(4)
    ranges = [(a := rng.randrange(-70, 70), a + rng.randrange(0, 90)) for _ in range(60)]
    rows = spark.createDataFrame(ranges, "_first bigint, _last bigint").select("*", intervals.range_cells(None, None, 8).alias("c")).collect()
    for r in rows:
        covered = sorted(x for c in r.c for x in range(c.cell * 4 ** c.level, (c.cell + 1) * 4 ** c.level))
        assert covered == list(range(r._first, r._last + 1))
