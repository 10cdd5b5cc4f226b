"""Row positions: file order survives any shuffle."""

from pyspark.sql import functions as F

from martline.sources import position


def write(tmp_path, n=3000):
    lines = ["k,v"] + [f"k{(i * 7919) % 97},{i}" for i in range(n)]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text("k,v\nnew,0\nk1,-1\n,5\n")
    return [(f"k{(i * 7919) % 97}", str(i)) for i in range(n)] + [("new", "0"), ("k1", "-1"), (None, "5")]


def test_csv_rows_in_several_splits_are_numbered_as_in_the_file(spark, tmp_path):
    expected = write(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = position.read_csv_rows(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 1
        got = [(r.k, r.v) for r in df.orderBy("file", "row").collect()]
        assert got == expected
        assert [r.row for r in df.where(F.col("file").endswith("b.csv")).orderBy("row").collect()] == [0, 1, 2]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_first_rows_and_appearance_do_not_depend_on_the_shuffle(spark, tmp_path):
    expected = write(tmp_path)
    df = position.read_csv_rows(spark, str(tmp_path))
    order = list(dict.fromkeys(k for k, _ in expected))
    first = {}
    for k, v in expected:
        first.setdefault(k, v)
    for shuffled in (df, df.repartition(7, "v"), df.orderBy(F.desc("v"))):
        numbers = {r.k: r.n for r in position.number_by_appearance(shuffled, ["k"], "n", rows_per_bucket=50).collect()}
        assert numbers == {k: i + 1 for i, k in enumerate(order)}
        assert {r.k: r.v for r in position.first_rows(shuffled, ["k"], ["v"]).collect()} == first


def test_parquet_rows_and_first_values_skip_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("b", None, 3)], "k string, v string, n int").coalesce(1).write.parquet(path)
    df = position.read_parquet_rows(spark, path).repartition(3)
    assert sorted((r.row, r.n) for r in df.collect()) == [(0, 1), (1, 2), (2, 3)]
    assert sorted(tuple(r) for r in position.first_values(df, ["k"], ["v", "n"]).collect()) == [("a", "x", 1), ("b", None, 3)]
    assert sorted(tuple(r) for r in position.first_rows(df, ["k"], ["v", "n"]).collect()) == [("a", None, 1), ("b", None, 3)]
