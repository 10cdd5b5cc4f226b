"""SimHash near-duplicate groups with bit-sliced comparison.

A text's fingerprint has a 1 in each bit that is set in over half of the
hashes (XXH64, seed 42) of its word shingles.  Fingerprints within a few bits
of each other are linked; a group is what can be reached over links.

Candidates: the 64 bits are cut into ``m`` blocks.  Two fingerprints that
differ in ``r`` bits agree in at least ``m - r`` whole blocks, so each is
filed under every choice of ``m - r`` blocks and only fingerprints under the
same choice and bits are compared.  Distinct fingerprints are filed once,
however many documents have them.

Comparison: the members of a file are stored vertically, one 64-bit word for
each bit position and 64 members.  A query is compared with 64 members at a
time: the differing lanes of each plane are added to carry-save counters (two
count bits and a sticky overflow), and a word is abandoned as soon as all its
lanes have overflowed.  A file hands on a star for each of its linked sets,
never its pairs.

A file with over ``limit`` members is not compared; its members are filed
anew under more blocks, hence under longer keys, until files are small.  At
the last level a file shares so many bits that its size is bounded
(``2 ** free bits``).

Cases: a null text is empty; a text without words has fingerprint zero,
linked like any other; fewer words than a shingle are one shingle.  Repeated
rows and equal texts fall in one group.  A group whose ids are all null has a
null id.  An empty table gives no rows.  A very long text is hashed whole by
its task, which holds some tens of bytes for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.blocks import LOWER, SPACE, U64, blocks, replace_columns, unused, word_spans
from martline.session import ensure_checkpoint_dir

SEED = 42
LEVELS = (5, 8, 12)
LIMIT = 4096


def simhash_block(data: np.ndarray, off: np.ndarray, shingle: int = 3) -> np.ndarray:
    """Fingerprints (uint64) of the texts of a block."""
    n = len(off) - 1
    low = LOWER[data]
    starts, ends, counts = word_spans(low, off)
    lengths = ends - starts
    # all words of the block, one space after each
    word_bytes = low[~SPACE[low]]
    norm = np.full(len(word_bytes) + len(lengths), 0x20, np.uint8)
    norm[np.arange(len(word_bytes)) + np.repeat(np.arange(len(lengths)), lengths)] = word_bytes
    text = norm.tobytes()
    begin = np.cumsum(lengths) - lengths + np.arange(len(lengths))
    end = begin + lengths
    first = np.cumsum(counts) - counts
    n_shingles = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(n), n_shingles)
    at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    last = at + np.minimum(counts[row], shingle) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(text[a:b], SEED) for a, b in zip(begin[at].tolist(), end[last].tolist())], dtype="<u8")
    out = np.zeros(n, dtype="<u8")
    some = np.flatnonzero(n_shingles)
    if len(some):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (np.cumsum(n_shingles) - n_shingles)[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > n_shingles[some][:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out.astype(U64)


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` plus the fingerprint as a signed long."""
    kept = replace_columns(docs, name)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = np.zeros(len(column), U64)
            for lo, hi, data, off in blocks(column, 1 << 18):
                out[lo:hi] = simhash_block(data, off, shingle)
            yield pa.array(out.view(np.int64))

    return kept.withColumn(name, F.arrow_udf(run, "bigint", F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`")))


def hex_fingerprint(column) -> F.Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def block_masks(m: int, radius: int) -> list[int]:
    """The bit masks of all choices of ``m - radius`` of ``m`` blocks."""
    edges = [round(i * 64 / m) for i in range(m + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, m - radius)]


def vertical(members: np.ndarray) -> np.ndarray:
    """Bit planes: (64, words); lane ``j`` of word ``w`` of plane ``b`` is bit ``b`` of member ``64 * w + j``."""
    words = -(-len(members) // 64)
    padded = np.zeros(words * 64, dtype="<u8")
    padded[:len(members)] = members
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")).view("<u8").astype(U64)


def near_lanes(queries: np.ndarray, planes: np.ndarray, word: np.ndarray, radius: int = 3, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of a query and a word of members: the lanes within ``radius`` bits.

    Returns the indices of the pairs with such lanes, and the lanes as bits.
    Counters count to ``radius`` in binary and overflow for good beyond.
    """
    alive = np.arange(len(queries))
    n_bits = max(1, int(radius).bit_length())
    start = (1 << n_bits) - 1 - radius  # counters start so that radius + 1 differences overflow them
    full = U64(0xFFFFFFFFFFFFFFFF)
    counters = [np.full(len(queries), full if start >> i & 1 else U64(0)) for i in range(n_bits)]
    over = np.zeros(len(queries), U64)
    for plane in range(64):
        flip = (queries >> U64(plane) & U64(1)) * full
        carry = planes[plane][word] ^ flip
        for c in counters:
            carried = c & carry
            c ^= carry
            carry = carried
        over |= carry
        if plane % step == step - 1:
            kept = over != full
            if not kept.all():
                alive, queries, word, over = alive[kept], queries[kept], word[kept], over[kept]
                counters = [c[kept] for c in counters]
                if not len(alive):
                    break
    return alive, ~over


def linked_sets(members: np.ndarray, group: np.ndarray, radius: int = 3, pairs_at_once: int = 1 << 18) -> np.ndarray:
    """For members sorted by group, the index of the first member of each one's linked set within its group."""
    n = len(members)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(first, n))
    words = -(-size // 64)
    # members laid out so that each group begins with a new word
    word_start = np.cumsum(words) - words
    g = np.repeat(np.arange(len(first)), size)
    lane = word_start[g] * 64 + np.arange(n) - first[g]
    laid = np.zeros(int(words.sum()) * 64, U64)
    laid[lane] = members
    member_at = np.full(len(laid), -1, np.int64)
    member_at[lane] = np.arange(n)
    planes = vertical(laid)
    parent = np.arange(n)
    todo = words[g]
    bounds = np.concatenate([[0], np.cumsum(todo)])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + pairs_at_once, side="right")) - 1)
        q = np.repeat(np.arange(lo, hi), todo[lo:hi])
        w = word_start[g[q]] + np.arange(len(q)) - np.repeat(bounds[lo:hi] - bounds[lo], todo[lo:hi])
        at, lanes = near_lanes(members[q], planes, w, radius)
        bits = np.unpackbits(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        pair, bit = np.nonzero(bits)
        a, b = q[at[pair]], member_at[w[at[pair]] * 64 + bit]
        real = (b >= 0) & (a < b)
        unite(parent, a[real], b[real])
        lo = hi
    return parent


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the sets of ``a[i]`` and ``b[i]``; ``parent`` ends fully compressed, roots are the smallest members."""
    while True:
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def _compare_files(batches: Iterator[pa.RecordBatch], radius: int, limit: int | None, at_once: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Rows (choice, key, fp) sorted by file; out: stars (a, b), and with b null the members of files over the limit."""
    choice, key, fp = (np.zeros(0, np.int64) for _ in range(3))
    spilling: tuple | None = None  # the file over the limit whose members are being handed on
    for batch in (*batches, None):
        last = batch is None
        if not last:
            new = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("choice", "key", "fp")]
            choice, key, fp = (np.concatenate([x, y]) for x, y in zip((choice, key, fp), new))
            if spilling is not None:
                mine = (choice == spilling[0]) & (key == spilling[1])
                if mine.any():
                    yield _stars(fp[mine], None)
                    choice, key, fp = choice[~mine], key[~mine], fp[~mine]
                if len(fp):
                    spilling = None
            if len(fp) < at_once:
                continue
        if not len(fp):
            continue
        new_file = np.concatenate([[True], (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])])
        first = np.flatnonzero(new_file)
        size = np.diff(np.append(first, len(fp)))
        done = len(fp) if last else int(first[-1])
        if limit is not None and not last and len(fp) - done > limit:
            spilling, done = (choice[-1], key[-1]), len(fp)
        small = np.repeat((size > 1) & ((size <= limit) if limit is not None else True), size)[:done]
        if limit is not None:
            big = np.repeat(size > limit, size)[:done]
            if big.any():
                yield _stars(fp[:done][big], None)
        if small.any():
            group = np.cumsum(new_file)[:done][small]
            members = fp[:done][small]
            root = linked_sets(members.view(U64), group, radius)
            linked = root != np.arange(len(root))
            if linked.any():
                yield _stars(members[linked], members[root[linked]])
        choice, key, fp = choice[done:], key[done:], fp[done:]


def _stars(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())], ["a", "b"])


def fingerprint_links(prints: DataFrame, radius: int = 3, levels: tuple[int, ...] = LEVELS, limit: int = LIMIT) -> DataFrame:
    """Stars (a, b) over distinct fingerprints ``fp``: what they connect is what links of at most ``radius`` bits connect."""
    left, found = prints.select("fp"), None
    for i, m in enumerate(levels):
        final = i == len(levels) - 1
        masks = F.array(*[F.lit(x - (1 << 64) if x >> 63 else x).cast("bigint") for x in block_masks(m, radius)])
        filed = left.select("fp", F.posexplode(masks).alias("choice", "mask")).select("choice", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        most = None if final else limit
        out = (filed.repartition("choice", "key").sortWithinPartitions("choice", "key")
               .mapInArrow(lambda it, most=most: _compare_files(it, radius, most), "a bigint, b bigint").checkpoint())
        stars = out.where("b IS NOT NULL")
        found = stars if found is None else found.union(stars)
        left = out.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
        if final or not left.head(1):
            break
    return found


def connected(stars: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node reachable.

    Alternates large stars and small stars: each node sends its larger, then
    its smaller neighbours the smallest one it knows, until nothing changes.
    Only a count and a checksum of the edges reach the driver.
    """
    edges = stars.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct().checkpoint()
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "m"))).first()
        if tuple(state) == before or not state[0]:
            return edges.select(F.col("v").alias("node"), F.col("m").alias("root"))
        before = tuple(state)
        both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).union(edges.select(F.col("m").alias("u"), F.col("v").alias("w")))
        low = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("low"))
        large = both.join(low, "u").where("w > u").select(F.col("w").alias("v"), F.col("low").alias("m")).where("v <> m").distinct()
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        joined = large.join(low, "v")
        small = joined.select("m", "low").where("m <> low").union(joined.select("v", "low")).toDF("v", "m").distinct()
        edges = small.checkpoint()


def near_duplicate_groups(docs: DataFrame, radius: int = 3, shingle: int = 3, text: str = "text", key: str = "doc_id",
                          levels: tuple[int, ...] = LEVELS, limit: int = LIMIT) -> DataFrame:
    """One row per document: key, ``text_hash``, ``fp``, ``root`` (a fingerprint, the same for the whole group) and ``component_id``.

    ``component_id`` is the smallest key of the group.  Keys, hashes and
    fingerprints are written once to the checkpoint folder; the texts are read
    once and not shuffled.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    prints = with_fingerprints(rows, shingle=shingle).select("key", F.xxhash64("text").alias("text_hash"), "fp").checkpoint()
    classes = prints.groupBy("fp").agg(F.min("key").alias("least"))
    roots = connected(fingerprint_links(classes, radius, levels, limit))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")).checkpoint()
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(groups, "root")
    return prints.join(by_fp, "fp").select(F.col("key").alias(key), "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, radius: int = 3, shingle: int = 3, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the smallest key (then text hash, then least other columns) stays."""
    groups = near_duplicate_groups(docs, radius, shingle, text, key, **options)
    best = groups.groupBy("root").agg(F.min(F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("key"), "text_hash")).alias("b"))
    k, h, mine, order = (unused(n, docs) for n in ("stay_key", "stay_hash", "text_hash", "nth"))
    stay = best.select(F.col("b.key").alias(k), F.col("b.text_hash").alias(h))
    found = docs.withColumn(mine, F.xxhash64(F.col(f"`{text}`"))).join(stay, F.col(f"`{key}`").eqNullSafe(F.col(k)) & (F.col(mine) == F.col(h)))
    # rows of one document share key and hash, and with them their place: of those the least stays, other columns compared as JSON
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]))
    one = found.groupBy(k, h).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), rest).alias(order))
    return one.select(*[F.col(order)[c].alias(c) for c in docs.columns])
