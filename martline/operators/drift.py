"""Schema-drift resolution.

Each extract may rename, add or omit columns.  Rules are data: a list of
``(source_pattern, action, from_col, to_col)`` with action ``rename`` or
``drop``; a pattern matches when it is a substring of the lower-cased
source name.  After the per-source rules, every extract is aligned to the
target column list (missing -> typed NULL, extra -> dropped) and all are
unioned by name.  Everything is metadata work on the driver plus one
``Union`` node in the plan; no data moves through Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The three known drift patterns of the paid-social extracts.
PAID_DRIFT_RULES = (
    ("instagram_part3", "rename", "spend_usd", "spend"),
    ("instagram_part3", "drop", "spend_currency", None),
    ("pinterest_part1", "rename", "link_clicks", "clicks"),
    ("tiktok_part2", "rename", "views", "video_views"),
)

# The 17 target columns of fact_paid_social_daily, in order.
PAID_TARGET = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("channel", T.StringType()),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("dma_name", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("spend", T.DecimalType(38, 2)),
    T.StructField("impressions", T.LongType()),
    T.StructField("clicks", T.LongType()),
    T.StructField("video_views", T.LongType()),
    T.StructField("video_25pct", T.LongType()),
    T.StructField("video_50pct", T.LongType()),
    T.StructField("video_75pct", T.LongType()),
    T.StructField("video_completes", T.LongType()),
    T.StructField("optimization_goal", T.StringType()),
    T.StructField("age_target", T.StringType()),
    T.StructField("audience_segment", T.StringType()),
])


def apply_rules(df: DataFrame, source: str, rules: Sequence[tuple]) -> DataFrame:
    """Rename or drop by rule when the rule's pattern matches ``source``."""
    name = source.lower()
    for pattern, action, frm, to in rules:
        if pattern.lower() not in name or frm not in df.columns:
            continue
        if action == "rename":
            df = df.withColumnRenamed(frm, to)
        elif action == "drop":
            df = df.drop(frm)
        else:
            raise ValueError(f"unknown drift action {action!r}")
    return df


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Missing columns as typed NULL, extra dropped, target order and types."""
    cols = []
    for f in target.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def resolve_drift(dfs_by_source: Mapping[str, DataFrame], rules: Sequence[tuple],
                  target: T.StructType, source_col: str | None = None) -> DataFrame:
    """Drift-resolving union of named extracts."""
    out = None
    for source in sorted(dfs_by_source):
        df = conform(apply_rules(dfs_by_source[source], source, rules), target)
        if source_col:
            df = df.withColumn(source_col, F.lit(source))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def resolve_drift_tagged(df: DataFrame, source_col: str, rules: Sequence[tuple],
                         target: T.StructType) -> DataFrame:
    """T1/U2 on a single tagged frame (the by-name union of all extracts).

    When extracts are read in one scan (files grouped by header, tagged by
    ``_metadata.file_name``), the rules become column expressions: a rename
    rule fills its target column from the source column on the rows of the
    matching extracts (a matching extract that already has the target name
    keeps its value); drop rules and extra columns fall away in the final
    projection.  One projection, no per-extract branches in the plan.
    """
    src = F.lower(F.col(source_col))
    cols = {f.name: (F.col(f.name) if f.name in df.columns else F.lit(None)) for f in target.fields}
    for pattern, action, frm, to in rules:
        if action != "rename" or frm not in df.columns or to not in cols:
            continue
        cols[to] = F.when(src.contains(pattern.lower()), F.coalesce(F.col(frm), cols[to])).otherwise(cols[to])
    return df.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in target.fields])


def first_present(df: DataFrame, candidates: Sequence[str], alias: str):
    """The first of ``candidates`` that exists in ``df`` (schema check on the driver)."""
    for c in candidates:
        if c in df.columns:
            return F.col(c).alias(alias)
    return F.lit(None).alias(alias)
