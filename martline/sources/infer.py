"""Column types inferred from all values of CSV files.

Every value has a mask of the types it fits: whole number, decimal, double,
date, timestamp, boolean.  A wider type's bit is set wherever a narrower one's
is (a date is a timestamp at midnight, a whole number a decimal), so the types
a column fits are the bitwise AND of its values' masks, and a column's type is
the narrowest bit left.  AND is associative: masks merge per file and across
files, in one aggregation with partial sums on the map side; one row per
column reaches the driver.

Text that a number would not keep stays text: numbers with leading zeros (ZIP
codes) or a plus sign have no bit.  A column without values is a string.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.sources.files import DEFAULT_NULL_TOKENS, read_source

#: Bits of a mask, narrowest type of each kind first.
BOOLEAN, WHOLE, DECIMAL, DOUBLE, DATE, TIMESTAMP = (1 << i for i in range(6))
ALL = (1 << 6) - 1

_WHOLE = r"^-?(0|[1-9][0-9]*)$"
_DECIMAL = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
_DOUBLE = r"^-?(0|[1-9][0-9]*)?(\.[0-9]*)?([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"
#: Digits of a decimal that Spark can hold.
MAX_DIGITS = 38


def type_mask(v: Column) -> Column:
    """The types that the text ``v`` fits, as bits; null for null."""
    whole = v.rlike(_WHOLE) & v.try_cast("bigint").isNotNull()
    number = v.rlike(_DOUBLE) & v.try_cast("double").isNotNull()
    date = v.rlike(_DATE) & v.try_cast("date").isNotNull()
    stamp = v.rlike(_TIMESTAMP) & v.try_cast("timestamp_ntz").isNotNull()
    return (F.when(v.isNull(), F.lit(None).cast("int"))
            .when(whole, F.lit(WHOLE | DECIMAL | DOUBLE)).when(v.rlike(_DECIMAL), F.lit(DECIMAL | DOUBLE)).when(number, F.lit(DOUBLE))
            .when(date, F.lit(DATE | TIMESTAMP)).when(stamp, F.lit(TIMESTAMP))
            .when(F.lower(v).isin("true", "false"), F.lit(BOOLEAN)).otherwise(F.lit(0)))


def _figures(cols: Sequence[str]) -> list[Column]:
    out = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        number = v.rlike(_DECIMAL)
        out += [F.count(v).alias(f"n{i}"), F.bit_and(type_mask(v)).alias(f"mask{i}"),
                F.max(F.when(number, F.length(F.regexp_extract(v, "^-?([0-9]+)", 1)))).alias(f"digits{i}"),
                F.max(F.when(number, F.length(F.regexp_extract(v, r"\.([0-9]+)$", 1)))).alias(f"scale{i}")]
    return out


def evidence(raw: DataFrame, source_col: str | None = None) -> DataFrame:
    """One row per column (and file, with ``source_col``): column_name, n_values, mask, digits, scale."""
    cols = [c for c in raw.columns if c != source_col]
    by = [F.col(f"`{source_col}`").alias("file")] if source_col else []
    wide = raw.groupBy(*by).agg(*_figures(cols))
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_values"), F.col(f"mask{i}").alias("mask"),
                              F.col(f"digits{i}").alias("digits"), F.col(f"scale{i}").alias("scale")) for i, c in enumerate(cols)])
    return wide.select(*(["file"] if source_col else []), F.inline(rows))


def merge(found: DataFrame) -> DataFrame:
    """Evidence of several files as evidence of their union."""
    return found.groupBy("position", "column_name").agg(F.sum("n_values").alias("n_values"), F.bit_and("mask").alias("mask"),
                                                        F.max("digits").alias("digits"), F.max("scale").alias("scale"))


def with_types(found: DataFrame) -> DataFrame:
    """Evidence plus ``type``, the narrowest type that all values fit."""
    has = lambda bit: F.col("mask").bitwiseAND(F.lit(bit)) != 0
    size = F.col("digits") + F.col("scale")
    kind = (F.when(F.col("mask").isNull(), "string").when(has(BOOLEAN), "boolean").when(has(WHOLE), "bigint")
            .when(has(DECIMAL) & (size <= MAX_DIGITS), F.concat(F.lit("decimal("), size.cast("string"), F.lit(","), F.col("scale").cast("string"), F.lit(")")))
            .when(has(DOUBLE), "double").when(has(DATE), "date").when(has(TIMESTAMP), "timestamp_ntz").otherwise("string"))
    return found.withColumn("type", kind)


def infer_types(raw: DataFrame, source_col: str | None = None) -> dict[str, str]:
    """Column name to type, over all values; one row per column is collected."""
    found = with_types(merge(evidence(raw, source_col))).orderBy("position").collect()
    return {r.column_name: r.type for r in found}


def read_inferred(spark: SparkSession, paths: str | Sequence[str], null_tokens: Iterable[str] = DEFAULT_NULL_TOKENS,
                  source_col: str = "_source_file") -> DataFrame:
    """CSV files, folders or globs, matched by header, with inferred types and each row's file."""
    raw = read_source(spark, paths, None, null_tokens, "csv", source_col)
    types = infer_types(raw, source_col)
    return raw.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in raw.columns if c != source_col], F.col(f"`{source_col}`"))
