"""K1/K3: tables that are replaced whole or not at all, and copies that are verified.

A versioned table is a folder with one sub-folder of data per version and a
log.  ``replace`` writes the new version's data, then reads back what it wrote,
and only if the checksum is that of the rows it was given adds one row to the
log: that append is the switch.  Readers take the version of the last log row,
so a write that fails at any point leaves the table as it was.

A checksum does not depend on row order or on files: the number of rows, and
the sum and the XOR of a 64-bit hash of each row.  Partial sums are formed
where the rows are; one row is compared.  Observing it during the write costs
no extra pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "_log"
LOG_SCHEMA = "version bigint, folder string, rows bigint, hash_sum string, hash_xor bigint"


class Checksum(NamedTuple):
    rows: int
    hash_sum: str
    hash_xor: int


def _row_hash(df: DataFrame) -> Column:
    """A hash of a row's values by column name; columns that can't be hashed are hashed as JSON."""
    cols = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.col(f"`{f.name}`")
        plain = c if not isinstance(f.dataType, (T.MapType, T.VariantType)) else F.to_json(c)
        # a null is skipped by the hash, so its place is told apart by the flag
        cols += [plain, c.isNull()]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("bigint")


def _figures(df: DataFrame) -> list[Column]:
    h = _row_hash(df)
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("hash_sum"),
            F.coalesce(F.bit_xor(h), F.lit(0)).alias("hash_xor")]


def checksum(df: DataFrame) -> Checksum:
    """The order-independent checksum of a table's rows."""
    return Checksum(*df.agg(*_figures(df)).first())


def write_checked(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Checksum:
    """Write ``df`` as Parquet to a new folder, read it back and compare; raises where they differ."""
    seen = Observation()
    w = df.observe(seen, *_figures(df)).write.mode("error")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    given = Checksum(*[seen.get[k] for k in Checksum._fields])
    # partition values come back from folder names: the schema says their types
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    stored = checksum(kept.select(*[F.col(f"`{c}`") for c in df.columns]))
    if stored != given:
        raise ValueError(f"{path} holds {stored}, not {given}")
    return stored


def _log(spark: SparkSession, path: str) -> list:
    """The log, oldest first: one row per version."""
    try:
        return sorted(spark.read.schema(LOG_SCHEMA).parquet(f"{path}/{LOG}").collect())
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replace the table at ``path`` by ``df``; returns the new version's number.

    ``df`` may read the table itself.  Old versions stay until ``forget``.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"data-{uuid.uuid4().hex}"
    found = write_checked(df, f"{path}/{folder}", partition_by)
    log = _log(spark, path)
    version = log[-1].version + 1 if log else 1
    row = spark.createDataFrame([(version, folder, *found)], LOG_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{path}/{LOG}")
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table at ``path`` (its last version, or a given one)."""
    log = _log(spark, path.rstrip("/"))
    found = [r for r in log if version is None or r.version == version]
    if not found:
        raise ValueError(f"no version {'' if version is None else version} of {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{found[-1].folder}")


def versions(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(version, rows) of a table, oldest first."""
    return [(r.version, r.rows) for r in _log(spark, path.rstrip("/"))]


def verify(spark: SparkSession, path: str) -> bool:
    """Whether the last version's rows are those that were written."""
    last = _log(spark, path.rstrip("/"))[-1]
    return checksum(read_version(spark, path)) == Checksum(last.rows, last.hash_sum, last.hash_xor)
