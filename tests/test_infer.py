"""Type inference: the narrowest type that all values of a column fit, over all files."""

import datetime as dt
from decimal import Decimal

from martline.sources import infer


def types_of(spark, **columns):
    n = max(len(v) for v in columns.values())
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    return infer.infer_types(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)).repartition(3))


def test_lattice(spark):
    got = types_of(spark, whole=["1", "-20", "0"], wide=["1", "9223372036854775808"], money=["1", "22.50", "-0.125"], real=["1", "2.5", "1e-3"], day=["2024-01-01", "2024-02-29"],
                   moment=["2024-01-01", "2024-01-01 10:00:00", "2024-01-02T03:04:05.123456"], flag=["true", "FALSE"], zip=["03101", "30301"], plus=["+1", "2"],
                   mixed=["1", "2024-01-01"], nothing=[None, None], noday=["2024-02-30"], huge=["1" * 39], half=[".5", "1."], word=["true", "1"], dot=["."], sign=["-"])
    assert got == {"whole": "bigint", "wide": "decimal(19,0)", "money": "decimal(5,3)", "real": "double", "day": "date", "moment": "timestamp_ntz", "flag": "boolean",
                   "zip": "string", "plus": "string", "mixed": "string", "nothing": "string", "noday": "string", "huge": "double", "half": "double", "word": "string",
                   "dot": "string", "sign": "string"}


def test_files_are_merged_by_name_and_one_value_decides(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount,day\n1,10,2024-01-01\n2,None,2024-01-02\n")
    (tmp_path / "b.csv").write_text("day,id,amount,note\n2024-01-03 12:00:00,3,2.75,x\n")
    df = infer.read_inferred(spark, str(tmp_path))
    assert dict(df.dtypes) == {"id": "bigint", "amount": "decimal(4,2)", "day": "timestamp_ntz", "note": "string", "_source_file": "string"}
    assert sorted((r.id, r.amount, r.day, r._source_file) for r in df.where("amount IS NOT NULL").collect()) == [
        (1, Decimal("10.00"), dt.datetime(2024, 1, 1), "a.csv"), (3, Decimal("2.75"), dt.datetime(2024, 1, 3, 12), "b.csv")]
    raw = spark.createDataFrame([("a", "1"), ("b", "x")], "file string, v string")
    per_file = {r.file: r.type for r in infer.with_types(infer.evidence(raw, "file")).collect()}
    assert per_file == {"a": "bigint", "b": "string"}
    assert infer.infer_types(raw, "file") == {"v": "string"}


def test_late_value_far_down_counts(spark):
    rows = spark.range(20_000).selectExpr("CASE WHEN id = 19999 THEN 'n/a' ELSE cast(id AS string) END AS v")
    assert infer.infer_types(rows) == {"v": "string"}


def test_no_rows(spark):
    assert infer.infer_types(spark.createDataFrame([], "v string")) == {"v": "string"}
