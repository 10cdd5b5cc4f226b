"""Tables replaced whole or not at all, and checksums that find a changed row."""

import pytest
from pyspark.sql import functions as F

from martline.sources import sinks, versions


def test_checksum_ignores_order_and_finds_changes(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS k", "CASE WHEN id % 5 = 0 THEN NULL ELSE cast(id AS string) END AS s")
    base = versions.checksum(df)
    assert base == versions.checksum(df.orderBy(F.desc("id")).repartition(7)) == versions.checksum(df.select("s", "k", "id"))
    for other in (df.where("id <> 3"), df.unionByName(df.where("id = 3")), df.withColumn("k", F.when(F.col("id") == 9, 99).otherwise(F.col("k"))),
                  df.withColumn("s", F.coalesce("s", F.lit(""))), df.unionByName(df.where("id < 2")).where("id <> 5 AND id <> 6")):
        assert versions.checksum(other) != base
    # a null and the value beside it do not trade places unseen
    a = spark.createDataFrame([(None, 1)], "a int, b int")
    assert versions.checksum(a) != versions.checksum(a.select(F.col("b").alias("a"), F.col("a").alias("b")))
    assert versions.checksum(df.limit(0)).rows == 0


def test_replace_reads_its_own_table_and_keeps_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.replace(spark.range(10).withColumn("p", F.col("id") % 2), path, ["p"]) == 1
    assert versions.replace(versions.read_version(spark, path).where("id < 4"), path) == 2
    assert versions.read_version(spark, path).count() == 4 and versions.read_version(spark, path, 1).count() == 10
    assert versions.versions(spark, path) == [(1, 10), (2, 4)] and versions.verify(spark, path)
    with pytest.raises(ValueError, match="no version 7"):
        versions.read_version(spark, path, 7)


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark.range(5), path)
    broken = spark.range(5).select((F.col("id") / F.lit(0)).alias("id")) if spark.conf.get("spark.sql.ansi.enabled") == "true" else \
        spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        versions.replace(broken, path)
    assert versions.read_version(spark, path).count() == 5 and versions.versions(spark, path) == [(1, 5)]


def test_damaged_version_is_found(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark.range(5), path)
    folder = versions._log(spark, path)[-1].folder
    spark.range(1).write.mode("append").parquet(f"{path}/{folder}")
    assert not versions.verify(spark, path)


def test_publish_raises_on_a_wrong_copy(spark, tmp_path, monkeypatch):
    src = str(tmp_path / "src")
    spark.range(9).write.parquet(src)
    found = sinks.publish(spark, [(src, str(tmp_path / "ok"))])
    assert found[str(tmp_path / "ok")].rows == 9
    write = sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda df, path, **kw: write(df.where("id <> 4"), path, **kw))
    with pytest.raises(ValueError, match="not a copy"):
        sinks.publish(spark, [(src, str(tmp_path / "bad"))])


def test_steps_count_rows_in_and_out(spark, tmp_path):
    step = sinks.Step("kept", "date", "dropped two")
    df = spark.sql("SELECT id, date'2024-01-01' + cast(id AS int) AS date FROM range(10)")
    sinks.write_table(step.out(step.into(df).where("id > 1")), str(tmp_path / "kept"))
    plain = sinks.Step("plain")
    sinks.write_table(plain.out(df.select("id")), str(tmp_path / "plain"))
    rows = [tuple(r) for r in sinks.step_metrics(spark, [step, plain]).collect()]
    assert rows == [("kept", 10, 8, "2024-01-03", "2024-01-10", "dropped two"), ("plain", None, 10, None, None, "")]
