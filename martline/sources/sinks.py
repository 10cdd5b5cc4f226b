"""Sinks (K1-K4): table writes, multi-output writes from one cleaned frame,
publishing by manifest, and per-step metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martline.sources.versions import Checksum, checksum


#: The partition column of tables laid out by month; dates of the table itself stay a column.
MONTH = "part_month"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] = (), by_month: str | None = None, gather: bool = True) -> None:
    """K1: full rewrite of one table.

    ``by_month`` lays the table out by month of a date column
    (``part_month=yyyy-MM``); :func:`read_table` turns a date range into a
    filter on it.  Rows are gathered by partition before the write, so a
    partition is a few files rather than one per task; Spark splits a month
    that holds much of the table.  ``gather=False`` leaves that out for rows
    that come month by month already.  Rows are not globally sorted (a sort would
    be a full shuffle); CSV export is ``fmt='csv'`` with a header.
    """
    out = df
    parts = list(partition_by)
    if by_month:
        out = out.withColumn(MONTH, F.date_format(by_month, "yyyy-MM"))
        parts = [MONTH] + parts
    if parts and gather:
        out = out.hint("rebalance", *parts)
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)


def read_table(spark: SparkSession, path: str, date_col: str = "date", start: str | None = None, end: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A written table without its partition column, between two dates (inclusive) if given.

    The date range becomes a filter on the month folders, so other months are
    not listed or read, and a filter on the dates themselves.
    """
    df = spark.read.option("recursiveFileLookup", "false").format(fmt).load(path)
    month = F.col(MONTH).cast("string") if MONTH in df.columns else None
    if start is not None:
        df = df.where(F.col(date_col) >= F.lit(start).cast("date"))
        if month is not None:
            df = df.where(month >= F.lit(start[:7]))
    if end is not None:
        df = df.where(F.col(date_col) <= F.lit(end).cast("date"))
        if month is not None:
            df = df.where(month <= F.lit(end[:7]))
    return df.drop(MONTH)


def write_outputs(clean: DataFrame, source_name: str, outputs: Mapping[str, Callable[[DataFrame], DataFrame]], base: str,
                  fmt: str = "parquet", by_month: str | None = None, steps: list[Step] | None = None, row_by_row: Sequence[str] = ()) -> dict[str, str]:
    """K2: several tables from one cleaned frame with a single scan of the source.

    The cleaned frame itself is written first, as table ``source_name``, and
    the other tables are built from what was written: nothing is held on the
    executors, and a lost one costs only its part of one write.  With
    ``steps``, the metrics of every table are added there.  Outputs named in
    ``row_by_row`` change no row's month: their rows are read month by month
    and written as they come, without another shuffle.
    """
    spark = clean.sparkSession
    paths = {name: f"{base.rstrip('/')}/{name}" for name in (source_name, *outputs)}
    made = [] if steps is None else steps
    first = Step(source_name, by_month)
    write_table(first.out(clean), paths[source_name], fmt=fmt, by_month=by_month)
    made.append(first)
    for name, build in outputs.items():
        step = Step(name, by_month)
        write_table(step.out(build(step.into(read_table(spark, paths[source_name], fmt=fmt)))), paths[name], fmt=fmt, by_month=by_month,
                    gather=name not in row_by_row)
        made.append(step)
    return paths


def publish(spark: SparkSession, manifest: Sequence[tuple[str, str]], fmt: str = "parquet") -> dict[str, Checksum]:
    """K3: re-lay out curated tables: read each source path, write it to its destination.

    A copy whose rows are not those of its source raises (compared by an
    order-independent checksum, which is returned per destination).
    """
    found = {}
    for src, dest in manifest:
        source = read_table(spark, src, fmt=fmt)
        write_table(source, dest, fmt=fmt)
        found[dest] = checksum(read_table(spark, dest, fmt=fmt))
        if found[dest] != checksum(source):
            raise ValueError(f"{dest} is not a copy of {src}")
    return found


def observe_step(df: DataFrame, name: str, date_col: str | None = None) -> tuple[DataFrame, Observation]:
    """K4: attach row-count (and date-range) metrics, filled in by the next action.

    Metrics are accumulated by the tasks that already process the rows; no
    extra job is run.
    """
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")]
    if date_col:
        exprs += [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    return df.observe(obs, *exprs), obs


class Step:
    """K4: rows in, rows out, date range and actions of one step, gathered while its rows are written."""

    def __init__(self, name: str, date_col: str | None = None, actions: str = ""):
        self.name, self.date_col, self.actions = name, date_col, actions
        self._in: list[Observation] = []
        self._out: Observation | None = None

    def into(self, df: DataFrame) -> DataFrame:
        """An input of the step, its rows counted as they are read."""
        df, seen = observe_step(df, f"{self.name} in {len(self._in)}")
        self._in.append(seen)
        return df

    def out(self, df: DataFrame) -> DataFrame:
        """The step's result, counted as it is written."""
        df, self._out = observe_step(df, self.name, self.date_col if self.date_col in df.columns else None)
        return df

    def row(self) -> tuple:
        """(step, rows_in, rows, min_date, max_date, actions), once the result is written; rows_in is null where no input was counted."""
        said = self._out.get
        dates = [None if (d := said.get(k)) is None else str(d)[:10] for k in ("min_date", "max_date")]
        return self.name, sum(int(o.get["rows"]) for o in self._in) if self._in else None, int(said["rows"]), *dates, self.actions


STEP_SCHEMA = "step string, rows_in bigint, rows bigint, min_date string, max_date string, actions string"


def step_metrics(spark: SparkSession, steps: Sequence[Step]) -> DataFrame:
    """One row per step."""
    return spark.createDataFrame([s.row() for s in steps], STEP_SCHEMA)


def export_sorted(df: DataFrame, path: str, sort_cols: Sequence[str], descending: Sequence[str] = (),
                  fmt: str = "csv") -> None:
    """O1/O2: export with the reference's row order (ascending, nulls last;
    listed columns descending).  The global sort is a range-partitioned
    shuffle and is paid only on export; warehouse tables are written unsorted."""
    order = [F.col(c).desc_nulls_last() if c in set(descending) else F.col(c).asc_nulls_last() for c in sort_cols]
    write_table(df.orderBy(*order), path, fmt=fmt)
