"""Join operators.

Broadcast policy: only fixed-size constant tables (dimension constants,
mapping tables, nation/region) are hinted with ``broadcast`` directly.  Any
table whose size grows with the data goes through :func:`sized_join`, which
reads the optimizer's size estimate and broadcasts only below a threshold;
above it the join is left to Spark (sort-merge, AQE may still convert at
runtime from real shuffle statistics).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.operators.containment import contained, whole_words
from martline.operators.intervals import overlapping


# 64 MiB: well under executor memory at any realistic cluster size.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job is run)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - plan API not reachable (e.g. Connect)
        return None


def sized_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
               limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Join, broadcasting ``right`` only when its estimated size is under ``limit_bytes``."""
    size = estimated_bytes(right)
    if size is not None and size <= limit_bytes:
        right = F.broadcast(right)
    return left.join(right, on, how)


def spine_join(spine: DataFrame, rollups: Sequence[DataFrame], key: str = "date",
               fill_zero: bool = True, fill_cols: Sequence[str] | None = None) -> DataFrame:
    """Left-join pre-aggregated rollups (≤1 row per key) onto a spine."""
    out = spine
    for r in rollups:
        out = out.join(r, key, "left")
    if fill_zero:
        numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
        cols = fill_cols or [c for c, t in out.dtypes
                             if c != key and (t in numeric or t.startswith("decimal"))
                             and c not in spine.columns]
        out = out.na.fill(0, subset=list(cols))
    return out


def lookup_first(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str,
                 order_cols: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Left join to the first lookup row per key (null when none).

    The value columns are appended to the ordering so ties resolve the same
    way on every run (and on recomputation after a lost executor).
    """
    order = F.struct(*[F.col(o) for o in order_cols], *[F.col(v) for v in value_cols])
    first = (lookup.groupBy(right_key)
             .agg(F.min_by(F.struct(*[F.col(v) for v in value_cols]), order).alias("_first"))
             .select(right_key, *[F.col("_first." + v).alias(v) for v in value_cols]))
    first = first.withColumnRenamed(right_key, "_lk")
    out = sized_join(df, first, F.col(left_key) == F.col("_lk"), "left")
    return out.drop("_lk")


def bridge_join(fact: DataFrame, bridge: DataFrame, fact_col: str, list_col: str,
                out_cols: Sequence[str], sep: str = ", ", null_as: str | None = None) -> DataFrame:
    """Many-to-one join of a fact value to a bridge row whose list column contains it.

    The bridge's comma-separated list is normalised with ``explode(split)``
    into (element -> bridge row), then equi-joined.  Unmatched fact rows keep
    null bridge columns.  ``null_as`` maps a NULL fact value to a literal
    (the 'None' campaign, trap Z2).
    """
    ex = (bridge.filter(F.col(list_col).isNotNull())
          .select(F.explode(F.split(F.col(list_col), sep)).alias("_elem"), *out_cols))
    key = F.col(fact_col) if null_as is None else F.coalesce(F.col(fact_col), F.lit(null_as))
    f = fact.withColumn("_bkey", key)
    # a constant bridge is broadcast, one that grows with the data only under the size bound
    return sized_join(f, ex, f["_bkey"] == ex["_elem"], "left").drop("_bkey", "_elem")


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, object]]) -> DataFrame:
    """Left-join a fact to each dimension in turn.

    ``dims`` holds ``(dimension, on)`` pairs; ``on`` is a list of shared key
    columns or a function ``(fact_so_far, dimension) -> Column`` for keys that
    need an expression (for example a case-insensitive channel name).  Each
    join goes through :func:`sized_join`, so a dimension is broadcast only
    under the size bound.
    """
    out = fact
    for dim, on in dims:
        out = sized_join(out, dim, on(out, dim) if callable(on) else on, "left")
    return out


def null_safe_full_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on ``keys`` where NULL keys match each other (pandas merge
    semantics, trap Z20); the key columns are coalesced from both sides."""
    ak = a.select(*[F.col(k).alias("_a_" + k) for k in keys], *[c for c in a.columns if c not in keys])
    bk = b.select(*[F.col(k).alias("_b_" + k) for k in keys], *[c for c in b.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col("_a_" + k).eqNullSafe(F.col("_b_" + k))
        cond = c if cond is None else cond & c
    j = ak.join(bk, cond, "full_outer")
    rest = [c for c in j.columns if not c.startswith(("_a_", "_b_"))]
    return j.select(*[F.coalesce(F.col("_a_" + k), F.col("_b_" + k)).alias(k) for k in keys], *rest)


def drill_across(a: DataFrame, b: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Two facts already aggregated to a shared grain, full outer join on it."""
    return null_safe_full_join(a, b, keys) if null_safe else a.join(b, list(keys), "full_outer")


def substring_pairs(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """Distinct value pairs where one contains the other (case-insensitive), not equal.

    Each value is looked up under its rarest q-gram among the other side's
    (``operators.containment``), so texts of any length and lists of any size
    may be compared.
    """
    x = a.select(F.col(a_col).alias("left_value"))
    y = b.select(F.col(b_col).alias("right_value"))
    wider = contained(x, "left_value", y, "right_value").select(F.col("text").alias("left_value"), F.col("term").alias("right_value"))
    inside = contained(y, "right_value", x, "left_value").select(F.col("term").alias("left_value"), F.col("text").alias("right_value"))
    return wider.unionByName(inside).distinct().filter(F.lower("left_value") != F.lower("right_value"))


def term_matches(texts: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """Match distinct texts against a terms table ``(kind, term, mode)`` of any size.

    ``mode='word'``: whole words, case-sensitive; otherwise containment in any
    case.  Texts and terms meet in an inverted index (``operators.containment``).
    """
    word = F.col("mode") == "word"
    exact = whole_words(texts, text_col, terms.where(word), "term").withColumn("_word", F.lit(True))
    part = contained(texts, text_col, terms.where(~word | F.col("mode").isNull()), "term").withColumn("_word", F.lit(False))
    listed = terms.select("kind", F.col("term").alias("_term"), F.coalesce(word, F.lit(False)).alias("_mode"))
    found = exact.unionByName(part)
    return found.join(listed, (F.col("term") == F.col("_term")) & (F.col("_word") == F.col("_mode"))).select("text", "kind", "term")


def interval_pairs(ranges: DataFrame, id_col: str, start_col: str, end_col: str, within: Sequence[str] = ()) -> DataFrame:
    """Pairs i<j of date or timestamp ranges that overlap (inside the same ``within`` group), with the overlap window.

    Ranges meet in a hierarchy of cells (``operators.intervals``), whatever
    their length; ranges that never meet are never compared.
    """
    met = overlapping(ranges, id_col, start_col, end_col, within)
    return met.select(*within, F.col("id_a").alias("file_a"), F.col("id_b").alias("file_b"),
                      F.greatest("start_a", "start_b").alias("overlap_start"), F.least("end_a", "end_b").alias("overlap_end"))
