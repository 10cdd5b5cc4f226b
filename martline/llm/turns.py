"""Conversations as ordered runs of rows.

A conversation of ordinary size is dealt by its id and read whole by one
task.  One of more than ``max_rows`` rows or ``max_bytes`` of text is dealt by
range of (id, order) instead, so it spreads over tasks, and comes in pieces of
at most these sizes (a single longer text is a piece of its own).  Pieces are
in order of (``part``, ``piece``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.session import ensure_checkpoint_dir

MAX_ROWS = 2_000
MAX_BYTES = 8 << 20


def long_conversations(rows: DataFrame, conv: str, text: str, max_rows: int, max_bytes: int) -> DataFrame | None:
    """The ids (as ``_c``) of conversations over either size, written; None if there are none."""
    ensure_checkpoint_dir(rows.sparkSession)
    sizes = rows.groupBy(F.col(conv).alias("_c")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b"))
    found = sizes.where((F.col("n") > max_rows) | (F.col("b") > max_bytes)).select("_c").checkpoint()
    return found if found.head(1) else None


def deal(rows: DataFrame, conv: str, order: Sequence[str], text: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, DataFrame | None]:
    """(ordinary, long) rows, each partition sorted by conversation and order (nulls first)."""
    by = [F.col(c).asc_nulls_first() for c in (conv, *order)]
    long = long_conversations(rows, conv, text, max_rows, max_bytes)
    if long is None:
        return rows.repartition(conv).sortWithinPartitions(*by), None
    match = F.col(conv).eqNullSafe(F.col("_c"))
    ordinary = rows.join(long, match, "left_anti").repartition(conv).sortWithinPartitions(*by)
    spread = rows.join(long, match, "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    by.append(F.col("_tie"))  # equal rows may lie in several partitions
    return ordinary, spread.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")


def runs(batches: Iterator[pa.RecordBatch], text_at: int, max_rows: int | None = None, max_bytes: int | None = None) -> Iterator[tuple[int, int, list[tuple]]]:
    """(part, piece, rows) of each conversation of a sorted partition, the id first in a row; cut only where sizes are given."""
    part = TaskContext.get().partitionId()
    held: list[tuple] = []
    piece = size = 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            length = len(row[text_at] or "")
            if held and row[0] != held[0][0]:
                yield part, piece, held
                held, piece, size = [], 0, 0
            elif held and max_rows is not None and (len(held) >= max_rows or size + length > max_bytes):
                yield part, piece, held
                held, piece, size = [], piece + 1, 0
            held.append(row)
            size += length
    if held:
        yield part, piece, held
