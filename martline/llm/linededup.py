"""Removal of lines that many documents share.

Texts are split at ``\\n``; a line's key is the line without white space
``[\\x20\\x09-\\x0D]`` at its ends and with ``A-Z`` in lower case.  Keys are
hashed to 128 bits, the distinct keys of each document exploded and counted
(Spark combines them before the shuffle, so a line of every document costs
one row per task), and lines whose key is in too many documents are dropped
everywhere.  The rest of each text is put together in order.

A row is a document.  Cases: a null or empty text is one empty line; keys of
fewer than ``min_chars`` code points are never dropped; a text that loses all
lines is empty; repeated rows count as documents each; a very long text is
held by its task with 16 bytes for each line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.blocks import replace_columns, unused
from martline.session import ensure_checkpoint_dir

#: Frequent keys are broadcast up to this size (16 bytes each); beyond it, texts are joined with their lines to drop.
BROADCAST_BYTES = 32 << 20


def line_keys(text: bytes) -> list[bytes]:
    # bytes.strip() strips exactly [\x20\x09-\x0D], bytes.lower() changes A-Z only
    return [line.strip() for line in text.lower().split(b"\n")]


def _hashes(text: bytes, min_chars: int) -> list[bytes | None]:
    """128-bit hash of each line's key; None for keys too short to be dropped."""
    digest = xxhash.xxh3_128_digest
    if min_chars <= 1:
        return [digest(k) if k else None for k in line_keys(text)]
    return [digest(k) if len(k.decode()) >= min_chars else None for k in line_keys(text)]


def _halves(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    pairs = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
    return pa.array(pairs[:, 0]), pa.array(pairs[:, 1])


def _distinct_keys(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(h1, h2, docs): how many texts of a batch have each key."""
    for batch in batches:
        count: dict[bytes, int] = {}
        for text in batch.column(0).to_pylist():
            for h in {h for h in _hashes(text.encode(), min_chars) if h is not None} if text else ():
                count[h] = count.get(h, 0) + 1
        if count:
            h1, h2 = _halves(list(count))
            yield pa.RecordBatch.from_arrays([h1, h2, pa.array(list(count.values()), pa.int64())], ["h1", "h2", "docs"])


def frequent_keys(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """(h1, h2) of the keys found in at least ``min_docs`` documents."""
    keys = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(lambda it: _distinct_keys(it, min_chars), "h1 bigint, h2 bigint, docs bigint")
    return keys.groupBy("h1", "h2").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("h1", "h2")


_FIELDS = [("kept_text", "string"), ("n_lines", "bigint"), ("n_dropped", "bigint")]


def _rebuild(text: str | None, drop, min_chars: int) -> tuple[str, int, int]:
    """The text without the lines whose hash is in ``drop``, its number of lines and of dropped lines."""
    if not text:
        return "", 1, 0
    lines = text.split("\n")
    kept = [line for line, h in zip(lines, _hashes(text.encode(), min_chars)) if h is None or h not in drop]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text",
                        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` plus ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped``.

    The frequent keys are written to the checkpoint folder and counted.  Up to
    ``broadcast_bytes`` of them go to the executors and texts stay where they
    are; beyond that, the lines to drop are found by a join on the hash and
    brought to the texts by a join on the text's hash.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    frequent = frequent_keys(docs, min_docs, min_chars, text).checkpoint()
    rest = replace_columns(docs, *[n for n, _ in _FIELDS])
    if 16 * frequent.count() <= broadcast_bytes:
        return _with_broadcast(rest, frequent, min_chars, text)
    return _with_joins(rest, frequent, min_chars, text)


def _with_broadcast(docs: DataFrame, frequent: DataFrame, min_chars: int, text: str) -> DataFrame:
    pairs = np.array([tuple(r) for r in frequent.collect()], dtype=">i8").reshape(-1, 2)
    shared = docs.sparkSession.sparkContext.broadcast(pairs.tobytes())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        raw = shared.value
        drop = {raw[i:i + 16] for i in range(0, len(raw), 16)}
        for column in batches:
            yield _struct([_rebuild(t, drop, min_chars) for t in column.to_pylist()])

    return _with_fields(docs, F.arrow_udf(run, _schema(), F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`")))


def _with_joins(docs: DataFrame, frequent: DataFrame, min_chars: int, text: str) -> DataFrame:
    """Which lines of a text go depends on the text alone, so equal texts share their list."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2, digests = [], [], []
            for x in {x for x in batch.column(0).to_pylist() if x}:
                raw = x.encode()
                found = {h for h in _hashes(raw, min_chars) if h is not None}
                mark = xxhash.xxh3_128_digest(raw)
                t1 += [mark] * len(found)
                digests += found
            if digests:
                yield pa.RecordBatch.from_arrays([*_halves(t1), *_halves(digests)], ["t1", "t2", "h1", "h2"])

    def mark(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.StructArray.from_arrays([*_halves([xxhash.xxh3_128_digest((t or "").encode()) for t in column.to_pylist()])], ["t1", "t2"])

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drops in batches:
            rows = zip(texts.to_pylist(), drops.to_pylist())
            yield _struct([_rebuild(t, {np.array([d["h1"], d["h2"]], dtype=">i8").tobytes() for d in ds or ()}, min_chars) for t, ds in rows])

    lines = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(explode, "t1 bigint, t2 bigint, h1 bigint, h2 bigint").distinct()
    drops = (lines.join(frequent, ["h1", "h2"], "left_semi").groupBy("t1", "t2")
             .agg(F.collect_list(F.struct("h1", "h2")).alias("drops")).select(F.struct("t1", "t2").alias("of"), "drops"))
    # names that the documents don't have
    place, of, gone = unused("place", docs), unused("of", docs), unused("drops", docs)
    marked = docs.withColumn(place, F.arrow_udf(mark, "t1 bigint, t2 bigint", F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`")))
    joined = marked.join(drops.toDF(of, gone), (F.col(place).t1 == F.col(of).t1) & (F.col(place).t2 == F.col(of).t2), "left").drop(place, of)
    return _with_fields(joined, F.arrow_udf(run, _schema(), F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`"), F.col(gone)), gone)


def _schema() -> str:
    return ", ".join(f"{n} {t}" for n, t in _FIELDS)


def _struct(rows: list[tuple[str, int, int]]) -> pa.Array:
    texts, lines, dropped = zip(*rows) if rows else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], [n for n, _ in _FIELDS])


def _with_fields(docs: DataFrame, struct, *drop: str) -> DataFrame:
    out = unused("out", docs)
    kept = [c for c in docs.columns if c not in drop]
    return docs.withColumn(out, struct).select(*[F.col(f"`{c}`") for c in kept], *[F.col(out)[n].alias(n) for n, _ in _FIELDS])
