"""File and constant-table sources."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions.text import remainder_after_first_dash

# The null tokens a CSV reader must treat as missing.  The
# empty field and the literal word None (pandas reads both as NA, trap Z2).
DEFAULT_NULL_TOKENS = ("", "None")


def _normalise_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


class SourceFile(NamedTuple):
    """One input file: a name unique among the files read together, its path and size in bytes."""
    name: str
    path: str
    size: int


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> list[SourceFile]:
    """The files behind paths, folders and globs, sorted by path (one listing; no content is read).

    A file is named by its last path element, or by its whole path where
    several files share that.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = sorted((r.path, r.length) for r in spark.read.format("binaryFile").load(paths).select("path", "length").collect())
    names = Counter(p.rsplit("/", 1)[-1] for p, _ in found)
    return [SourceFile(p.rsplit("/", 1)[-1] if names[p.rsplit("/", 1)[-1]] == 1 else p, p, n) for p, n in found]


def _plain(path: str) -> str:
    """A path without the empty authority some readers print (``file:///x`` and ``file:/x`` are the same file)."""
    return re.sub(r"^(\w+):///", r"\1:/", path)


def file_headers(spark: SparkSession, files: Sequence[SourceFile]) -> dict[str, tuple[str, ...]]:
    """Normalised header of each CSV file by name, from one job over the first blocks of all files."""
    if not files:
        return {}
    lines = (spark.read.text([f.path for f in files])
             .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                     F.monotonically_increasing_id().alias("nth"))
             .where("at = 0").groupBy("path").agg(F.min_by("value", "nth").alias("first")))
    name = {_plain(f.path): f.name for f in files}
    return {name[_plain(r.path)]: tuple(c.strip().lower() for c in next(csv.reader([(r["first"] or "").lstrip("\ufeff")]), []))
            for r in lines.collect()}


def _tag(df: DataFrame, files: Sequence[SourceFile], source_col: str) -> DataFrame:
    """Each row's file name; the name is the path only for files whose last path element is not unique."""
    path = F.regexp_replace(F.col("_metadata.file_path"), r"^(\w+):///", "$1:/")
    long = [f.path for f in files if f.name == f.path]
    name = F.when(path.isin([_plain(p) for p in long]), path) if long else None
    base = F.col("_metadata.file_name")
    return df.withColumn(source_col, name.otherwise(base) if name is not None else base)


def read_source(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
                null_tokens: Iterable[str] = DEFAULT_NULL_TOKENS, fmt: str = "csv",
                source_col: str = "_source_file") -> DataFrame:
    """Read files, folders or globs as one DataFrame.

    * CSV: header row, no type inference (inference drops ZIP leading zeros
      and costs a full extra pass), header names stripped and lower-cased,
      every token in ``null_tokens`` becomes NULL.
    * Columns are matched by (normalised) header name, never by position:
      the headers of all files are read in one job, files are grouped by
      header and each group is read in its own column order.  Columns a file
      lacks are NULL.  With a ``schema`` its types and columns apply and extra
      columns are dropped; without one all columns are strings.
    * Each row is tagged with the file it came from so per-file rules (drift,
      overlap) can target one file after a single scan instead of one scan
      per file.
    """
    if fmt == "parquet":
        paths = [paths] if isinstance(paths, str) else list(paths)
        df = spark.read.parquet(*paths)
        return df.withColumn(source_col, F.col("_metadata.file_name")) if source_col else df
    files = list_files(spark, paths)
    return _read_csv(spark, files, file_headers(spark, files), schema, null_tokens, source_col)


def _read_csv(spark: SparkSession, files: Sequence[SourceFile], headers: dict[str, tuple[str, ...]], schema: T.StructType | None,
              null_tokens: Iterable[str], source_col: str | None) -> DataFrame:
    tokens = list(null_tokens)
    base = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
            .option("nullValue", tokens[0] if tokens else None))
    by_name = {f.name.lower(): f for f in schema.fields} if schema is not None else {}
    groups: dict[tuple[str, ...], list[SourceFile]] = {}
    for f in files:
        if f.name in headers:
            groups.setdefault(headers[f.name], []).append(f)
    df = None
    for header, group in sorted(groups.items()):
        types = T.StructType([T.StructField(c, by_name[c].dataType if c in by_name else T.StringType()) for c in header])
        g = base.schema(types).csv([f.path for f in group])
        g = _tag(g, files, "__file")
        if schema is not None:
            cols = [(F.col(f.name.lower()) if f.name.lower() in header else F.lit(None).cast(f.dataType)).alias(f.name)
                    for f in schema.fields]
        else:
            cols = [F.col(f"`{c}`") for c in header]
        g = g.select(*cols, *([F.col("__file").alias(source_col)] if source_col else []))
        df = g if df is None else df.unionByName(g, allowMissingColumns=True)
    if df is None:
        fields = [T.StructField(f.name, f.dataType) for f in schema.fields] if schema is not None else []
        return spark.createDataFrame([], T.StructType(fields + ([T.StructField(source_col, T.StringType())] if source_col else [])))
    extra = tokens[1:]
    if extra:
        strings = {c for c, t in df.dtypes if t == "string" and c != source_col}
        df = df.select(*[(F.when(F.col(f"`{c}`").isin(extra), F.lit(None).cast("string")).otherwise(F.col(f"`{c}`")).alias(c)
                          if c in strings else F.col(f"`{c}`")) for c in df.columns])
    return df


def read_untyped(spark: SparkSession, paths: str | Sequence[str],
                 source_col: str = "_source_file") -> DataFrame:
    """Every column as STRING, empty fields stay '' (no NA conversion)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("nullValue", "\u0000").option("emptyValue", "").csv(paths))
    df = _normalise_header(df)
    # the CSV parser yields NULL for an unquoted empty field; untyped rows keep ''
    df = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])
    if source_col:
        df = df.withColumn(source_col, F.col("_metadata.file_name"))
    return df


def constant_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A literal table (fixed-size; safe to broadcast)."""
    return spark.createDataFrame(list(rows), schema)


def airport_lookup(raw: DataFrame, codes: DataFrame, code_col: str = "iata_code",
                   region_col: str = "iso_region") -> DataFrame:
    """Trimmed code, restricted to the wanted codes, state from the region.

    ``codes`` is a one-column DataFrame of wanted codes; a semi join keeps the
    restriction distributed however many codes there are (no driver list).
    """
    wanted = codes.select(F.trim(F.col(codes.columns[0])).alias("_code")).distinct()
    df = raw.withColumn(code_col, F.trim(F.col(code_col)))
    df = df.join(wanted, df[code_col] == wanted["_code"], "left_semi")
    return (df.select(F.col(code_col).alias("iata_code"),
                      F.col("name"),
                      F.col("municipality"),
                      remainder_after_first_dash(F.col(region_col)).alias("state"),
                      F.col("iso_country")))


def read_tagged(spark: SparkSession, paths: str | Sequence[str], null_tokens: Iterable[str] = DEFAULT_NULL_TOKENS,
                source_col: str = "_source_file") -> tuple[DataFrame, dict[str, tuple[str, ...]]]:
    """Extracts with differing headers as ONE frame tagged by file name.

    A column holds values only on rows of files that have it.  Returns the
    frame and each file's header (by file name; files of equal names in
    different folders go by their paths) for drift reports.
    """
    files = list_files(spark, paths)
    headers = file_headers(spark, files)
    return _read_csv(spark, files, headers, None, null_tokens, source_col), headers
