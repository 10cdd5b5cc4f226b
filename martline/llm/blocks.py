"""Text columns as numpy arrays.

The operators of this package run numpy inside Spark tasks.  A text column
arrives as Arrow batches; the helpers here view its UTF-8 bytes as one
``uint8`` array plus row offsets, cut into blocks of bounded size, and find
words, lines and their 64-bit hashes with whole-array operations.

White space is ``[\\x20\\x09-\\x0D]`` everywhere; upper case means ``A-Z``.
A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 17

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the 64 output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), base, dtype=U64)
        steps[0] = 1
        table = _powers[base] = np.multiply.accumulate(steps)
    return table[:n]


class SpanHasher:
    """64-bit hashes of any spans of ``data``; equal bytes give equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(_BYTE_VALUE[data] * _power_table(_BASE, n), out=self._sums[1:])
        self._inverse = _power_table(_BASE_INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mix64(value + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=kind, count=n + 1, offset=column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of rows of about ``max_bytes``.

    A longer text is a block of its own: operators that hold figures for every
    byte of a block need a multiple of the longest text.
    """
    data, off = text_arrays(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def break_spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and counts per row of the maximal runs of ``inside`` that do not cross a row's end."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edge[:n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edge[1:]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and counts per row of the words ``[^\\x20\\x09-\\x0D]+``."""
    return break_spans(~SPACE[data], off)


def row_sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def replace_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (an input column of such a name is replaced)."""
    wanted = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in wanted])


def unused(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, for a column in between."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: Column, mod: int) -> Column:
    """``crc32(doc_id as text) mod`` ``mod``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % mod


def hash_share(seed: str, *keys: Column) -> Column:
    """A uniform number in [0, 1) that depends on the keys alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def bounded_sample(docs: DataFrame, label: Column, value: Column, per_label: int | dict, max_labels: int = 256, seed: str = "sample") -> list[tuple]:
    """About ``per_label`` distinct values of every label (or of each as a dict says), as ``(label, value)`` on the driver.

    Values are chosen by their own hash, and equal ones count once: the share
    kept of each label follows from its (approximate) number of distinct
    values, so the result holds about ``1.1 * per_label * max_labels`` pairs at
    most, for any input, however often rows or ids repeat.  Labels beyond the
    ``max_labels`` most frequent are not learnable.  The pairs come sorted, so
    that a refit sees the same sequence.
    """
    rows = docs.select(label.alias("label"), value.alias("value")).where("label IS NOT NULL AND value IS NOT NULL")
    seen = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("value"), 0.02).alias("distinct"))
    counts = seen.orderBy(F.desc("n"), "label").limit(max_labels).collect()
    if not counts:
        return []
    share = F.lit(0.0)
    for r in counts:
        wanted = per_label.get(r["label"], 0) if isinstance(per_label, dict) else per_label
        share = F.when(F.col("label") == F.lit(r["label"]), F.lit(min(1.0, 1.1 * wanted / max(1, r["distinct"])))).otherwise(share)
    picked = rows.where(hash_share(seed, F.col("value")) < share).distinct().collect()
    return sorted([(r["label"], r["value"]) for r in picked], key=lambda r: (str(r[0]), str(r[1])))
