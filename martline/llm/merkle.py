"""Merkle manifest of a dataset, its trees stored in van Emde Boas layout.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a group (a
source), ascending by key, are the lowest level of a tree in which every
``fanout`` consecutive nodes have their hash as parent (the last run of a
level may be shorter, down to one node).  The groups' subroots, ordered by
group, are the leaves of one more tree, whose root stands for the dataset.

A tree is cut into blocks: aligned subtrees over ``fanout ** levels`` leaves.
A block's root is a leaf of a block one layer up, and so on until one block is
left.  Inside a block the nodes lie in van Emde Boas order: the subtree is
split at half its height, its top part is stored first and then its bottom
parts one after another, each split again.  Only a level's last run can be
short, so all bottom parts but the last are full and a node's place follows
from its level and index by arithmetic alone (``node_places``); building a
block writes nodes by these places and a proof reads its siblings by them.

No group is gathered in a task: leaves are numbered by range partitions and
counts, a task holds one block at a time, and a path goes down from the root
block by block, one row for each.

Cases: null fields count as ``-``; null keys come first, ties of the key are
ordered by the leaf's digest; equal rows are leaves each; the null group comes
first; a very long text is hashed by the JVM as any other; an empty table has
no rows and no root.  Columns that are not asked for may have any names.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from martline.llm.numbering import numbered
from martline.session import ensure_checkpoint_dir

FANOUT = 16
#: Levels of hashing inside a block: 16 ** 3 leaves.
LEVELS = 3

PATH = "array<struct<before:string,after:string>>"


# -- addresses ---------------------------------------------------------------

def widths(n: int, height: int, fanout: int = FANOUT) -> list[int]:
    """Nodes of each level, leaves first, of a subtree over ``n`` leaves with ``height`` levels of hashing."""
    out = [n]
    for _ in range(height):
        out.append(-(-out[-1] // fanout))
    return out


def node_places(level: int, index: np.ndarray, n: int, height: int, fanout: int = FANOUT) -> np.ndarray:
    """Places of the nodes ``index`` of ``level`` (0: leaves) in a subtree of ``height`` levels of hashing over ``n`` leaves."""
    if height == 0:
        return np.zeros(len(index), dtype=np.int64)
    rows = height + 1
    top = rows // 2
    bottom = rows - top  # levels below the cut
    above = -(-n // fanout ** bottom)  # lowest nodes of the top part
    if level >= bottom:
        return node_places(level - bottom, index, above, top - 1, fanout)
    part_leaves = fanout ** (bottom - 1)
    part = index // fanout ** (bottom - 1 - level)
    inside = index - part * fanout ** (bottom - 1 - level)
    start = sum(widths(above, top - 1, fanout)) + part * sum(widths(part_leaves, bottom - 1, fanout))
    last = (n - 1) // part_leaves
    out = np.empty(len(index), dtype=np.int64)
    full = part < last
    out[full] = node_places(level, inside[full], part_leaves, bottom - 1, fanout)
    out[~full] = node_places(level, inside[~full], n - last * part_leaves, bottom - 1, fanout)
    return start + out


@functools.lru_cache(maxsize=64)
def _layout(n: int, height: int, fanout: int) -> tuple[np.ndarray, ...]:
    return tuple(node_places(level, np.arange(w), n, height, fanout) for level, w in enumerate(widths(n, height, fanout)))


def height_of(n: int, fanout: int = FANOUT) -> int:
    """Levels of hashing until one node is left."""
    h = 0
    while fanout ** h < n:
        h += 1
    return h


# -- blocks ------------------------------------------------------------------

def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def build_block(digests: np.ndarray, height: int, fanout: int = FANOUT) -> np.ndarray:
    """The nodes (rows of 32 bytes) of a block over leaf ``digests``, by place."""
    n = len(digests)
    places = _layout(n, height, fanout)
    nodes = np.empty((sum(map(len, places)), 32), dtype=np.uint8)
    nodes[places[0]] = digests
    for level in range(1, height + 1):
        text = nodes[places[level - 1]].tobytes().hex()
        step = 64 * fanout
        hashed = b"".join(hashlib.sha256(text[i:i + step].encode()).digest() for i in range(0, len(text), step))
        nodes[places[level]] = np.frombuffer(hashed, np.uint8).reshape(-1, 32)
    return nodes


def siblings(nodes: np.ndarray, n: int, height: int, index: int, fanout: int = FANOUT) -> list[tuple[str, str]]:
    """Hex digests before and after node ``index`` in its run, of each level below the block's root."""
    out = []
    width = n
    for level in range(height):
        lo = index - index % fanout
        run = nodes[node_places(level, np.arange(lo, min(lo + fanout, width)), n, height, fanout)].tobytes().hex()
        out.append((run[:64 * (index - lo)], run[64 * (index - lo + 1):]))
        index, width = index // fanout, -(-width // fanout)
    return out


def fold(leaf: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its path lead to."""
    for before, after in path:
        leaf = _sha(before + leaf + after)
    return leaf


def _all_siblings(nodes: np.ndarray, n: int, height: int, fanout: int) -> list[list[tuple[str, str]]]:
    """``siblings`` of every leaf of a block; a level's nodes are read once."""
    per_level = []
    for places in _layout(n, height, fanout)[:height]:
        text = nodes[places].tobytes().hex()
        level = []
        for i in range(len(places)):
            lo = 64 * (i - i % fanout)
            level.append((text[lo:64 * i], text[64 * (i + 1):lo + 64 * fanout]))
        per_level.append(level)
    return [[level[i // fanout ** k] for k, level in enumerate(per_level)] for i in range(n)]


# -- rows to blocks ----------------------------------------------------------

def _block_schema(key: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("grp", T.StringType()), T.StructField("block", T.LongType()), T.StructField("total", T.LongType()),
        T.StructField("n", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("nodes", T.BinaryType()),
        T.StructField("root", T.BinaryType()), T.StructField("keys", T.ArrayType(key)), T.StructField("claims", T.ArrayType(T.BinaryType()))])


def _blocks(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Blocks of the rows (grp, rank, total, digest, key, claim)."""
    size = fanout ** levels
    key_type = rows.schema["key"].dataType
    schema = _block_schema(key_type)
    placed = rows.select("grp", F.floor(F.col("rank") / size).alias("block"), "total", "rank", "digest", "key", "claim")
    dealt = placed.repartition("grp", "block").sortWithinPartitions("grp", "block", "rank")

    def finish(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        column = lambda name: table.column(name).combine_chunks()
        n, total = table.num_rows, column("total")[0].as_py()
        height = levels if total > size else height_of(total, fanout)
        digests = np.frombuffer(b"".join(column("digest").to_pylist()), np.uint8).reshape(n, 32)
        nodes = build_block(digests, height, fanout)
        offsets = pa.array([0, n], pa.int32())
        keys, claims = column("key"), column("claim")
        return pa.RecordBatch.from_arrays([
            column("grp").slice(0, 1), column("block").slice(0, 1), column("total").slice(0, 1), pa.array([n], pa.int32()), pa.array([height], pa.int32()),
            pa.array([nodes.tobytes()], pa.binary()), pa.array([nodes[0].tobytes()], pa.binary()),
            pa.ListArray.from_arrays(offsets, keys), pa.ListArray.from_arrays(offsets, claims)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # ranks of a block are consecutive: its first row is the one whose rank the block size divides
            starts = np.flatnonzero(np.asarray(batch.column(3)) % size == 0)
            cuts = [0, *starts.tolist(), batch.num_rows]
            for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                if i and held:
                    yield finish(held)
                    held = []
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield finish(held)

    return dealt.mapInArrow(run, schema)


@dataclass
class Manifest:
    """The written blocks: ``layers[k]`` of the groups' trees and ``top[k]`` of the tree over subroots, from the leaves up."""

    layers: list[DataFrame]
    top: list[DataFrame]
    fanout: int
    levels: int

    @property
    def root(self) -> str | None:
        """Hex digest of the dataset; None for an empty one."""
        row = self.top[-1].select("root").first()
        return None if row is None else row[0].hex()


def field(value: Column) -> Column:
    """A field as a leaf takes it: ``-`` for null, else its length in UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*fields: Column) -> Column:
    """Hex digest of a row's fields."""
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def build(rows: DataFrame, group: Column, key: Column, leaf: Column, claim: Column | None = None, path: str | None = None,
          fanout: int = FANOUT, levels: int = LEVELS) -> Manifest:
    """Write the manifest of ``rows`` with hex digest ``leaf`` (``claim``: another digest to hold against the manifest later).

    The blocks go to ``path``, by default a folder under the checkpoint
    folder; only digests and keys are shuffled, never the rows.
    """
    spark = rows.sparkSession
    base = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/manifest-{uuid.uuid4().hex}"
    claim = F.lit(None).cast("string") if claim is None else claim
    hashed = rows.select(group.alias("grp"), key.alias("key"), F.unhex(leaf).alias("digest"), F.unhex(claim).alias("claim"))
    hashed.write.parquet(f"{base}/leaves")
    leaves = numbered(spark.read.schema(hashed.schema).parquet(f"{base}/leaves"), "grp", ["key", "digest"], base)
    layers = _layers(leaves, f"{base}/groups", fanout, levels)
    subroots = None
    for layer in layers:
        tops = layer.where(F.col("total") <= fanout ** levels).select("grp", F.col("root").alias("digest"))
        subroots = tops if subroots is None else subroots.unionByName(tops)
    ordered = numbered(subroots.select(F.lit(None).cast("string").alias("tree"), F.col("grp").alias("key"), "digest"), "tree", ["key"], base)
    ordered = ordered.select(F.col("tree").alias("grp"), "key", "digest", F.lit(None).cast("binary").alias("claim"), "rank", "total")
    return Manifest(layers, _layers(ordered, f"{base}/top", fanout, levels), fanout, levels)


def _layers(rows: DataFrame, path: str, fanout: int, levels: int) -> list[DataFrame]:
    """Written layers of blocks, until every tree has come to one block."""
    spark, size = rows.sparkSession, fanout ** levels
    out: list[DataFrame] = []
    while True:
        made = _blocks(rows, fanout, levels)
        made.write.parquet(f"{path}/layer={len(out)}")
        written = spark.read.schema(made.schema).parquet(f"{path}/layer={len(out)}")
        out.append(written)
        more = written.where(F.col("total") > size)
        if not more.head(1):
            return out
        rows = more.select("grp", F.col("block").alias("rank"), F.ceil(F.col("total") / size).alias("total"), F.col("root").alias("digest"),
                           F.col("block").alias("key"), F.lit(None).cast("binary").alias("claim"))


def _descend(blocks: DataFrame, emit: Callable, schema: str, fanout: int) -> DataFrame:
    """The columns that ``emit`` makes of each block that carries the ``path`` above its root.

    ``emit`` is given the block's row, its leaves' digests as one text, the
    siblings inside the block of each leaf and the path above.
    """
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
                above = [(p["before"], p["after"]) for p in row["path"]]
                inside = _all_siblings(nodes, row["n"], row["height"], fanout)
                digests = nodes[_layout(row["n"], row["height"], fanout)[0]].tobytes().hex()
                rows = emit(row, digests, inside, above)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, arrow)], schema=arrow)

    return blocks.mapInArrow(run, schema)


def _paths(inside: list, above: list) -> list[list[dict]]:
    return [[{"before": b, "after": a} for b, a in (*steps, *above)] for steps in inside]


def _child_paths(row: dict, digests: str, inside: list, above: list, size: int) -> list:
    n = row["n"]
    first = row["block"] * size
    return [[row["grp"]] * n, list(range(first, first + n)), [row["subroot"]] * n, [row["dataset"]] * n, _paths(inside, above)]


def _subroot_paths(row: dict, digests: str, inside: list, above: list) -> list:
    n = row["n"]
    return [row["keys"], [digests[64 * i:64 * i + 64] for i in range(n)], [row["dataset"]] * n, _paths(inside, above)]


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: grp, key, leaf, claim, subroot, root, ``path`` (siblings before and after, level by level up to the root)."""
    key = manifest.layers[0].schema["keys"].dataType.elementType.simpleString()

    def emit(row: dict, digests: str, inside: list, above: list) -> list:
        n = row["n"]
        return [[row["grp"]] * n, row["keys"], [digests[64 * i:64 * i + 64] for i in range(n)], [c and c.hex() for c in row["claims"]],
                [row["subroot"]] * n, [row["dataset"]] * n, _paths(inside, above)]

    return _descend(_with_paths(manifest), emit, f"grp string, key {key}, leaf string, claim string, subroot string, root string, path {PATH}", manifest.fanout)


def verified(manifest: Manifest) -> DataFrame:
    """One row per leaf: grp, key, leaf, subroot, root, ``proof_sha256`` (of its path's digests), ``folded_root`` and ``verified``.

    The claimed digest, or the leaf's own where there is none, is folded along
    the stored path; paths are consumed where they are made.
    """
    key = manifest.layers[0].schema["keys"].dataType.elementType.simpleString()

    def emit(row: dict, digests: str, inside: list, above: list) -> list:
        n, upper = row["n"], "".join(b + a for b, a in above)
        leaf = [digests[64 * i:64 * i + 64] for i in range(n)]
        proof = [_sha("".join([b + a for b, a in steps]) + upper) for steps in inside]
        folded = [fold(fold(c.hex() if c is not None else x, steps), above) for c, x, steps in zip(row["claims"], leaf, inside)]
        return [[row["grp"]] * n, row["keys"], leaf, [row["subroot"]] * n, [row["dataset"]] * n, proof, folded, [f == row["dataset"] for f in folded]]

    return _descend(_with_paths(manifest), emit, f"grp string, key {key}, leaf string, subroot string, root string, proof_sha256 string, "
                    "folded_root string, verified boolean", manifest.fanout)


def _with_paths(manifest: Manifest) -> DataFrame:
    """The blocks over rows, each with its group's subroot, the dataset's root and the path above the block's root."""
    size = manifest.fanout ** manifest.levels
    child_schema = f"g string, rank bigint, subroot string, dataset string, path {PATH}"
    descend_child = lambda blocks: _descend(blocks, lambda *a: _child_paths(*a, size), child_schema, manifest.fanout)
    hexed = F.lower(F.hex("root"))
    empty = F.array().cast(PATH)

    def carried(blocks: DataFrame, above: DataFrame | None) -> DataFrame:
        """Blocks below other blocks, with the path that their parent's block found."""
        a = above.withColumnRenamed("rank", "_rank")
        return blocks.join(a, blocks["grp"].eqNullSafe(F.col("g")) & (F.col("block") == F.col("_rank"))).drop("g", "_rank")

    at = manifest.top[-1].withColumn("subroot", F.lit(None).cast("string")).withColumn("dataset", hexed).withColumn("path", empty)
    for lower in reversed(manifest.top[:-1]):
        at = carried(lower, descend_child(at))
    kind = manifest.top[0].schema["keys"].dataType.elementType.simpleString()
    groups = _descend(at, _subroot_paths, f"g {kind}, subroot string, dataset string, path {PATH}", manifest.fanout)
    children = None
    for layer in reversed(manifest.layers):
        whole = layer.where(F.col("total") <= size)
        at = whole.join(groups, whole["grp"].eqNullSafe(F.col("g"))).drop("g")
        if children is not None:
            at = at.unionByName(carried(layer.where(F.col("total") > size), children))
        children = descend_child(at)
    return at
