"""Document fingerprints by SpotSigs.

A spot signature is an anchor, a common word, followed by a chain of content
words: the next ``chain`` words, ``distance`` apart, that are not common words
themselves.  In a stretch without common words (a list, a table, another
language) every word that is more than ``gap`` words from the last anchor is
an anchor itself, so that such text has signatures too.  The set of a
document's signatures is its fingerprint; likeness is the Jaccard coefficient
of two sets.

Texts without any signature (no anchor with a full chain after it) fall back
to one signature of their whole word sequence, so that equal texts have equal
fingerprints and different ones differ; a text without words has the empty
set.  Two empty sets are alike (1), an empty and another set are not (0).

Sets of lengths ``a <= b`` can only reach likeness ``t`` if ``a >= t * b``.
The similarity join partitions sets by length so that a set meets only its own
and the next partition, looks there for sets that share one of its tuples of
rare signatures, and compares only sets whose lengths can reach ``t``: first by
sketches in the files of these tuples, then, in groups of what passes, by the
sets themselves.

Cases: a null text is empty; repeated rows are one set; a very long text is
signed whole, in about 40 bytes for each of its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.blocks import LOWER, SpanHasher, U64, blocks, break_spans, hash_share, mix64, replace_columns, text_arrays
from martline.llm.simhash import connected

#: Anchors: common words of English, German, French and Spanish (fixed values).
COMMON_WORDS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were which will with you "
    "als am auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für hat ich im ist mit nach nicht noch nur sich sie sind so über um und von vor war wie wird zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou où par pas plus pour qu que qui sa se ses son sur un une vous "
    "al algo como con del el ella en entre era es esta este ha hasta las lo los más me mi muy no nos o para pero por porque se sin sobre son su sus también una y ya"
).split()
CHAIN = 2
DISTANCE = 1
GAP = 6
#: Sets of a slice, two of which a task compares, and sets in shared files up to which their list is broadcast.
SLICE = 4096
BROADCAST_NODES = 1 << 20
#: Pairs whose sketches are compared at once.
PAIRS = 1 << 17

#: Word characters: ASCII letters and digits and every byte beyond ASCII; punctuation does not count.
_WORD = np.zeros(256, dtype=bool)
_WORD[0x80:] = True
for _lo, _hi in (("a", "z"), ("A", "Z"), ("0", "9")):
    _WORD[ord(_lo):ord(_hi) + 1] = True


def _word_hashes(words: list[str]) -> np.ndarray:
    data, off = text_arrays(pa.array(words, pa.string()))
    return SpanHasher(data)(off[:-1], off[1:])


class Signer:
    """Signature sets of the texts of a block."""

    def __init__(self, common: tuple[str, ...] | list[str] = COMMON_WORDS, chain: int = CHAIN, distance: int = DISTANCE, gap: int = GAP):
        self.chain, self.distance, self.gap = chain, distance, gap
        self.common = np.sort(_word_hashes(sorted({w.lower() for w in common})))

    def sets(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures (32 bits each, distinct and ascending in each text) and their offsets."""
        n = len(off) - 1
        low = LOWER[data]
        starts, ends, counts = break_spans(_WORD[data], off)
        h = SpanHasher(low)(starts, ends)
        row = np.repeat(np.arange(n), counts)
        where = np.minimum(np.searchsorted(self.common, h), len(self.common) - 1)
        anchor = self.common[where] == h
        # words since the last common word or the text's start
        at = np.arange(len(h))
        begins = np.zeros(len(h), dtype=bool)
        begins[(np.cumsum(counts) - counts)[counts > 0]] = True
        since = at - np.maximum.accumulate(np.where(anchor | begins, at, 0)) if len(h) else at
        # content words in order; an anchor's chain starts at the first content word after it
        content = np.flatnonzero(~anchor)
        spots = np.flatnonzero(anchor | (since > self.gap))
        first = np.cumsum(~anchor)[spots]
        last = first + (self.chain - 1) * self.distance
        whole = last < len(content)
        spots, first = spots[whole], first[whole]
        whole = row[content[first + (self.chain - 1) * self.distance]] == row[spots] if len(spots) else np.zeros(0, bool)
        spots, first = spots[whole], first[whole]
        sig = mix64(h[spots])
        for j in range(self.chain):
            sig = mix64(sig ^ h[content[first + j * self.distance]])
        rows = row[spots]
        # texts with words but no signature: one of the whole sequence
        lone = np.flatnonzero((counts > 0) & (np.bincount(rows, minlength=n) == 0))
        if len(lone):
            at = np.cumsum(counts) - counts
            extra = np.array([self._sequence(h[at[i]:at[i] + counts[i]]) for i in lone], dtype=U64)
            sig, rows = np.concatenate([sig, extra]), np.concatenate([rows, lone])
        key = np.unique((rows.astype(U64) << U64(32)) | (sig >> U64(32)))
        found = np.searchsorted(key, np.arange(n + 1, dtype=U64) << U64(32))
        return key.astype(np.uint32), found

    @staticmethod
    def _sequence(h: np.ndarray) -> int:
        return int.from_bytes(hashlib.blake2b(h.astype("<u8").tobytes(), digest_size=8).digest(), "little")


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Likeness of two ascending sets; 0 if it is below ``least``, decided from the lengths where they suffice."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    found = common / (len(a) + len(b) - common)
    return found if found >= least else 0.0


def encode_set(members: np.ndarray) -> str:
    """A fingerprint as text: eight hex digits for every signature, ascending."""
    return members.astype(">u4").tobytes().hex()


def decode_set(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint or ""), dtype=">u4").astype(np.uint32)


def fingerprints(docs: DataFrame, text: str = "text", fingerprint: str = "fingerprint", **options) -> DataFrame:
    """``docs`` plus the fingerprint of each whole text (a null text is empty)."""
    kept = replace_columns(docs, fingerprint)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        signer = Signer(**options)
        for column in batches:
            out: list[str] = []
            for _, _, data, off in blocks(column):
                sig, at = signer.sets(data, off)
                out += [encode_set(sig[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.array(out, pa.string())

    return kept.withColumn(fingerprint, F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`")))


def set_digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.astype("<u4").tobytes(), digest_size=16).digest()


def _node(digest: bytes) -> int:
    """48 bits of a digest; sets that share them are compared in vain, never lost."""
    return int.from_bytes(digest[:6], "little")


class LengthFiles:
    """Under which keys a set is filed so that any two sets with a likeness of at least ``t`` share one.

    Sets in one length partition or neighbouring ones are all that can be
    alike: the bounds grow by ``1 / t``.  Sets of lengths ``a`` and ``b`` that
    reach ``t`` differ in at most ``d = (a + b) (1 - t) / (1 + t)`` members, so
    when the members of a partition's sets are dealt to ``k`` buckets, at least
    ``k - d`` buckets hold the same.  A key is a bucket with its content (a
    tuple of members).  In any common order of keys the first ``d + 1`` of both
    sets then have one in common; keys with many rare members come first.
    ``frequent`` members only bear on that order, never on the result.
    """

    def __init__(self, threshold: float, frequent: np.ndarray):
        self.t, self.frequent, self.known = threshold, np.sort(frequent.astype(np.uint32)), {}

    def _part(self, n: int) -> int:
        return int(math.log(n) / math.log(1 / self.t) + 1e-9)

    def _apart(self, total: int) -> int:
        return int(total * (1 - self.t) / (1 + self.t) + 1e-9)

    def _plan(self, n: int) -> list[tuple[int, int, int]]:
        """(partition, its buckets, keys to file) of a set of ``n`` members."""
        if n not in self.known:
            longest, out = int(n / self.t + 1e-9), []
            for part in range(self._part(n), self._part(longest) + 1):
                most = int((1 / self.t) ** (part + 1)) + 2
                while self._part(most) > part:
                    most -= 1
                apart = self._apart(n + min(longest, most))
                if apart:  # else only equal sets are alike
                    out.append((part, (self._apart(2 * most) + 1) * 6 // 5 + 1, apart + 1))
            self.known[n] = out
        return self.known[n]

    def keys(self, members: np.ndarray) -> np.ndarray:
        out = [np.zeros(0, U64)]
        if len(members):
            wide = mix64(members.astype(U64) + U64(1))
            rare = np.ones(len(members))
            if len(self.frequent):
                rare[self.frequent[np.minimum(np.searchsorted(self.frequent, members), len(self.frequent) - 1)] == members] = 0
            for part, k, take in self._plan(len(members)):
                bucket = ((wide >> U64(20)) % U64(k)).astype(np.int64)
                content = np.zeros(k, U64)
                np.add.at(content, bucket, wide)
                key = mix64(content + mix64(np.arange(k, dtype=U64) + U64(part << 40)))
                out.append(key[np.lexsort((key, -np.bincount(bucket, rare, k)))[:take]])
        return np.concatenate(out)


def _frequent_members(rows: DataFrame, sample_docs: int = 2000, least: int = 4, **options) -> np.ndarray:
    """Members of at least ``least`` of about ``sample_docs`` sets; of a set at most 4,096 members are looked at."""
    n = rows.count()
    picked = rows.where(hash_share("spots", F.coalesce(F.col("key").cast("string"), F.lit(""))) < min(1.0, sample_docs / max(n, 1))).limit(2 * sample_docs)
    found = fingerprints(picked, **options).select(F.substring("fingerprint", 1, 8 * 4096)).collect()
    if not found:
        return np.zeros(0, np.uint32)
    members, counts = np.unique(np.concatenate([decode_set(r[0]) for r in found]), return_counts=True)
    return members[counts >= least]


def slices_of(members: Column) -> Column:
    """Slices of a group of so many sets: pairs of slices are compared in tasks of their own, of some hundred up to ``SLICE`` sets a side."""
    return F.greatest(F.ceil(members / SLICE), F.least(F.lit(14), F.ceil(members / 256))).cast("int")


def deal_pairs(rows: DataFrame, group: str, members: str, by: str) -> DataFrame:
    """``rows`` once for every pair of slices (i <= j) of their group that they belong to, with ``side`` 0 (slice i), 1 (slice j) or 2 (i = j)."""
    own = F.pmod(F.xxhash64(F.lit("slice"), by), slices_of(F.col(members))).cast("int")
    placed = rows.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), slices_of(F.col(members)) - 1)))
    return (placed.withColumn("i", F.least("own", "with")).withColumn("j", F.greatest("own", "with"))
            .withColumn("side", F.when(F.col("own") == F.col("with"), 2).when(F.col("own") < F.col("with"), 0).otherwise(1)).drop("own", "with", members))


def similar_groups(rows: DataFrame, threshold: float, **options) -> tuple[DataFrame, DataFrame]:
    """(digest, node, members) of the sets of (key, text) that share a file with another, and (node, root) of those that may be alike.

    1. Sets are filed by ``LengthFiles``; a task hands on its keys as packed
       bytes, and of the files only those with several sets are kept.
    2. In each such file, sets are compared by length and by parity sketch: the
       bits in which two sketches differ are at most the members in which the
       sets differ, so a pair over the bound is dropped for certain.  Sets that
       only share a file, or a template, part here; what is left is handed on
       as stars, which are joined to groups.

    Large files are compared by pairs of slices, each pair in a task that holds
    the two slices and nothing else; pairs of sets are never written.
    """
    spark = rows.sparkSession
    files = LengthFiles(threshold, _frequent_members(rows, **options))
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(**options)
        for batch in batches:
            keys, nodes, seen = [np.zeros(0, U64)], [np.zeros(0, U64)], set()
            for _, _, data, off in blocks(batch.column(0)):
                sig, at = signer.sets(data, off)
                for a, b in zip(at[:-1], at[1:]):
                    node = _node(set_digest(sig[a:b]))
                    if node not in seen:
                        seen.add(node)
                        keys.append(files.keys(sig[a:b]))
                        nodes.append(np.full(len(keys[-1]), node, U64))
            key, node = np.concatenate(keys), np.concatenate(nodes)
            bucket = ((key >> U64(48)) * U64(buckets) >> U64(16)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            packed = np.empty((len(key), 12), np.uint8)
            packed[:, :6] = key[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]
            packed[:, 6:] = node[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            kind, first = np.unique(bucket[order], return_index=True)
            ends = np.append(first[1:], len(key))
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array([packed[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())],
                                             ["bucket", "filed"])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, node, m) of the files with more than one set."""
        packed = np.frombuffer(b"".join(x for batch in batches for x in batch.column("filed").to_pylist()), np.uint8).reshape(-1, 12)
        packed = np.unique(packed.view("V12").ravel()).view(np.uint8).reshape(-1, 12)
        wide = np.zeros((2, len(packed), 8), np.uint8)
        wide[0, :, :6], wide[1, :, :6] = packed[:, :6], packed[:, 6:]
        key, node = wide.view("<u8")[..., 0].astype(np.int64)
        order = np.argsort(key, kind="stable")
        _, at, m = np.unique(key[order], return_inverse=True, return_counts=True)
        key, node, m = key[order], node[order], m[at]
        for lo in range(0, len(key), 1 << 16):
            kept = lo + np.flatnonzero(m[lo:lo + (1 << 16)] > 1)
            yield pa.RecordBatch.from_arrays([pa.array(key[kept]), pa.array(node[kept]), pa.array(m[kept])], ["key", "node", "m"])

    filed = rows.select("text").mapInArrow(file, "bucket int, filed binary").repartition("bucket")
    shared = filed.mapInArrow(several, "key bigint, node bigint, m bigint").checkpoint()
    wanted = shared.select("node").distinct().checkpoint()

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(**options)
        for batch in batches:
            for _, _, data, off in blocks(batch.column(0)):
                sig, at = signer.sets(data, off)
                found = [sig[a:b] for a, b in zip(at[:-1], at[1:])]
                digests = [set_digest(x) for x in found]
                yield pa.RecordBatch.from_arrays([pa.array([_node(d) for d in digests], pa.int64()), pa.array(digests, pa.binary()),
                                                  pa.array([x.astype("<u4").tobytes() for x in found], pa.binary())], ["node", "digest", "members"])

    few = wanted.count() <= BROADCAST_NODES
    sets = rows.select("text").mapInArrow(members, "node bigint, digest binary, members binary").join(F.broadcast(wanted) if few else wanted, "node")
    sets = sets.groupBy("digest").agg(F.first("node").alias("node"), F.first("members").alias("members")).checkpoint()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x, "<u4") for x in batch.column("members").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([len(x) for x in found], pa.int32()), pa.array([parity_sketch(x) for x in found], pa.binary())],
                                             ["node", "n", "sketch"])

    # sets that share a node are told apart in the last step; here each stands for the node
    sketches = sets.select("node", "members").mapInArrow(sketch, "node bigint, n int, sketch binary")
    in_files = deal_pairs(shared.join(sketches, "node"), "key", "m", "node")
    dealt = in_files.select("key", "i", "j", "side", "node", "n", "sketch").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    roots = connected(dealt.mapInArrow(lambda it: _sketch_stars(it, threshold), "a bigint, b bigint"))
    return sets, roots.union(roots.select(F.col("root").alias("node"), "root")).distinct().checkpoint()


def similar_classes(rows: DataFrame, threshold: float, **options) -> DataFrame:
    """(digest, links) of the sets of (key, text) that reach ``threshold`` with any other: the number of such distinct sets.

    The sets of each group of ``similar_groups`` are compared exactly, longest
    first, so that a block of sets meets only those whose lengths can reach
    the threshold; large groups by pairs of slices.
    """
    sets, roots = similar_groups(rows, threshold, **options)
    gathered = sets.join(roots, "node")
    sizes = gathered.groupBy("root").agg(F.count("*").alias("m"))
    # sets of one node that nothing else resembles may still resemble each other
    same = sets.join(roots, "node", "left_anti").withColumn("root", F.col("node"))
    twins = same.groupBy("root").agg(F.count("*").alias("m")).where("m > 1")
    together = gathered.select("root", "digest", "members").join(sizes, "root").unionByName(same.select("root", "digest", "members").join(twins, "root"))
    pairs = deal_pairs(together, "root", "m", "digest")

    def compare(group: pa.Table) -> pa.Table:
        digests = group.column("digest").to_pylist()
        side = np.asarray(group.column("side").combine_chunks().to_numpy(zero_copy_only=False))
        found = [np.frombuffer(x, "<u4") for x in group.column("members").to_pylist()]
        links = count_links(found, np.ones(len(found), dtype=bool), threshold) if (side == 2).all() else count_across(found, side == 0, threshold)
        at = np.flatnonzero(links > 0)
        return pa.table({"digest": pa.array([digests[i] for i in at], pa.binary()), "links": pa.array(links[at], pa.int64())})

    counted = pairs.select("root", "i", "j", "side", "digest", "members").groupBy("root", "i", "j").applyInArrow(compare, "digest binary, links bigint")
    return counted.groupBy("digest").agg(F.sum("links").alias("links"))


def parity_sketch(members: np.ndarray) -> bytes:
    """Bits that say whether an odd number of members fall on each; over one bit for each member, a power of two of words."""
    words = 1
    while 48 * words < len(members):
        words *= 2
    bits = np.bincount((mix64(members.astype(U64) + U64(7)) & U64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketches: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Words of each sketch, and for every number of words the sketches of at least as many, folded to it."""
    words = np.array([len(x) // 8 for x in sketches])
    out, at = {}, int(words.max(initial=1))
    while at:
        level = np.zeros((len(sketches), at), U64)
        if 2 * at in out:
            level = out[2 * at][:, :at] ^ out[2 * at][:, at:]
        own = np.flatnonzero(words == at)
        if len(own):
            level[own] = np.frombuffer(b"".join(sketches[i] for i in own), "<u8").reshape(-1, at)
        out[at] = level
        at //= 2
    return words, out


def _passing(a: np.ndarray, b: np.ndarray, n: np.ndarray, words: np.ndarray, folded: dict[int, np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of rows may reach the threshold, by length and sketch."""
    low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
    passing = low >= threshold * high - 1e-9
    apart = ((n[a] + n[b]) * (1 - threshold) / (1 + threshold) + 1e-9).astype(np.int64)
    width = np.minimum(words[a], words[b])
    for w, level in folded.items():
        at = np.flatnonzero(passing & (width == w))
        for lo in range(0, len(at), PAIRS):
            some = at[lo:lo + PAIRS]
            differ = np.bitwise_count(level[a[some]] ^ level[b[some]]).sum(axis=1, dtype=np.int64)
            passing[some] = differ <= apart[some]
    return passing


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node reachable from each of ``n`` nodes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        if (before == root).all():
            break
    return root


def _sketch_stars(batches: Iterator[pa.RecordBatch], threshold: float, rows_at_once: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Stars over the sets that pairs passing in their files connect; rows come sorted by file and pair of slices."""
    held: list[pa.RecordBatch] = []
    size = 0

    def stars(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        key, i, j, side, node, n = (table.column(c).to_numpy() for c in ("key", "i", "j", "side", "node", "n"))
        words, folded = _folded(table.column("sketch").to_pylist())
        ends = np.flatnonzero(np.r_[(key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), True]) + 1
        starts = np.r_[0, ends[:-1]]
        nodes, at = np.unique(node, return_inverse=True)
        left, right = [], []

        def keep(a: np.ndarray, b: np.ndarray) -> None:
            good = _passing(a, b, n, words, folded, threshold) & (at[a] != at[b])
            left.append(at[a[good]])
            right.append(at[b[good]])

        split = side[starts] != 2
        m = ends - starts
        for count in np.unique(m[~split]):
            some = starts[~split & (m == count)]
            x, y = np.triu_indices(count, 1)
            step = max(1, PAIRS // max(1, len(x)))
            for lo in range(0, len(some), step):
                base = some[lo:lo + step, None]
                keep((base + x).ravel(), (base + y).ravel())
        for lo, hi in zip(starts[split], ends[split]):
            x, y = lo + np.flatnonzero(side[lo:hi] == 0), lo + np.flatnonzero(side[lo:hi] == 1)
            step = max(1, PAIRS // max(1, len(y)))
            for k in range(0, len(x), step):
                keep(np.repeat(x[k:k + step], len(y)), np.tile(y, len(x[k:k + step])))
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        root = _components(len(nodes), a, b)
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[root[linked]])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows_at_once:
            continue
        # the last file may go on in the next batch
        table = pa.Table.from_batches(held).combine_chunks()
        ident = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")])
        cut = int(np.flatnonzero((ident != ident[:, -1:]).any(axis=0))[-1] + 1) if (ident != ident[:, -1:]).any() else 0
        if cut:
            yield stars(table.slice(0, cut).to_batches())
            held = table.slice(cut).to_batches()
            size = table.num_rows - cut
    if held:
        yield stars(held)


def count_links(sets: list[np.ndarray], own: np.ndarray, threshold: float, block: int = 512, columns: int = 8192) -> np.ndarray:
    """For each of the distinct ``sets`` that is ``own``: with how many others its likeness reaches ``threshold``."""
    n = np.array([len(x) for x in sets], dtype=np.int64)
    order = np.argsort(-n, kind="stable")
    links = np.zeros(len(sets), np.int64)
    mine = order[own[order]]
    for lo in range(0, len(mine), block):
        query = mine[lo:lo + block]
        longest, shortest = n[query[0]], n[query[-1]]
        others = order[(n[order] >= threshold * shortest - 1e-9) & (threshold * n[order] <= longest + 1e-9)]
        for at in range(0, len(others), block):
            other = others[at:at + block]
            alike = (_likeness(sets, n, query, other, columns) >= threshold) & (query[:, None] != other[None, :])
            links[query] += alike.sum(axis=1)
    return links


def count_across(sets: list[np.ndarray], left: np.ndarray, threshold: float, block: int = 512, columns: int = 8192) -> np.ndarray:
    """For each of the distinct ``sets``: with how many of the other side (``left`` or not) its likeness reaches ``threshold``."""
    n = np.array([len(x) for x in sets], dtype=np.int64)
    order = np.argsort(-n, kind="stable")
    links = np.zeros(len(sets), np.int64)
    mine, rest = order[left[order]], order[~left[order]]
    for lo in range(0, len(mine), block):
        query = mine[lo:lo + block]
        longest, shortest = n[query[0]], n[query[-1]]
        others = rest[(n[rest] >= threshold * shortest - 1e-9) & (threshold * n[rest] <= longest + 1e-9)]
        for at in range(0, len(others), block):
            other = others[at:at + block]
            alike = _likeness(sets, n, query, other, columns) >= threshold
            links[query] += alike.sum(axis=1)
            links[other] += alike.sum(axis=0)
    return links


def _likeness(sets: list[np.ndarray], n: np.ndarray, query: np.ndarray, other: np.ndarray, columns: int) -> np.ndarray:
    known = np.unique(np.concatenate([sets[i] for i in query]))
    common = np.zeros((len(query), len(other)), np.float32)
    for c in range(0, len(known), columns):
        common += _dense(sets, query, known[c:c + columns]) @ _dense(sets, other, known[c:c + columns]).T
    return common / np.maximum(n[query][:, None] + n[other][None, :] - common.astype(np.float64), 1)


def _dense(sets: list[np.ndarray], which: np.ndarray, known: np.ndarray) -> np.ndarray:
    out = np.zeros((len(which), len(known)), np.float32)
    row = np.repeat(np.arange(len(which)), [len(sets[i]) for i in which])
    members = np.concatenate([sets[i] for i in which])
    at = np.minimum(np.searchsorted(known, members), len(known) - 1)
    there = known[at] == members
    out[row[there], at[there]] = 1
    return out


def classified(rows: DataFrame, threshold: float, **options) -> tuple[DataFrame, DataFrame]:
    """For (key, text): the keys with their sets' digests, and (digest, class_id, links) of every distinct set; both are checkpointed."""
    from martline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(rows.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        signer = Signer(**options)
        for column in batches:
            out: list[bytes] = []
            for _, _, data, off in blocks(column):
                sig, at = signer.sets(data, off)
                out += [set_digest(sig[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.array(out, pa.binary())

    prints = rows.select("key", F.arrow_udf(run, "binary", F.ArrowUDFType.SCALAR_ITER)("text").alias("digest")).checkpoint()
    classes = prints.groupBy("digest").agg(F.min("key").alias("class_id")).join(similar_classes(rows, threshold, **options), "digest", "left")
    return prints, classes.select("digest", "class_id", F.coalesce("links", F.lit(0).cast("bigint")).alias("links")).checkpoint()


def near_duplicates(docs: DataFrame, threshold: float = 0.8, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row per document: key, ``class_id`` and ``links``.

    ``class_id`` is the smallest key with the same fingerprint; ``links`` the
    number of other classes whose sets have a likeness of at least
    ``threshold``.  Rows with a null key are left out.  Texts without words
    form one class without links.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where("key IS NOT NULL")
    prints, classes = classified(rows, threshold, **options)
    return prints.join(classes, "digest").select(F.col("key").alias(key), "class_id", "links")


def edited_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", ranges: int | None = None, threshold: float | None = None, **options) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likenesses.

    The edited form of a text replaces its last ``floor(n_chars / 3)`` code
    points by the first as many (or all) of the next document in descending
    order of ``key``; after the last document comes the first.  Returns
    key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited
    and near_next.

    Texts are dealt once, compressed, by ranges of the key whose bounds are quantiles of
    the keys, and sorted within ranges.  The document that follows a range's
    last is the bound itself, so bounds are sent to both ranges.  Rows with
    equal keys follow each other by the hash of their texts; null keys come last.

    With a ``threshold``, ``class_id`` and ``links`` follow as in
    ``near_duplicates``, over all rows (a class of null keys only has a null
    id).  They are dealt to the ranges with the texts, ahead of them.
    """
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    top, bounds = rows.agg(F.max("key"), F.percentile_approx("key", shares, 100 * ranges)).first()
    bounds = np.array(sorted(set(bounds or [])), dtype=np.int64)

    def ranges_of(column: pa.Array) -> list[pa.Array]:
        """The range of a key, the range it also ends as the document after that range's last (-1: none), and whether it is the top."""
        known = column.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        part = np.searchsorted(bounds, known, side="left")
        null = np.asarray(column.is_null())
        part[null] = 0
        also = np.where(np.isin(known, bounds), part + 1, -1)
        also[null] = -1
        if top is not None:
            wrap = np.where((known == top) & ~null, 0, -1)
        else:
            wrap = np.zeros(len(known), np.int64)
        return [pa.array(x.astype(np.int32)) for x in (part, also, wrap)]

    def deal(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield ranges_of(column)[0]

    def pack(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        squeeze = zstandard.ZstdCompressor(level=6)
        for keys, texts in batches:
            some = [pa.array([squeeze.compress(x.encode()) for x in texts.slice(lo, 200).to_pylist()], pa.binary()) for lo in range(0, len(texts), 200)]
            yield pa.StructArray.from_arrays([*ranges_of(keys), pa.concat_arrays(some) if some else pa.array([], pa.binary())], ["part", "also", "wrap", "text"])

    dealing = F.arrow_udf(deal, "int", F.ArrowUDFType.SCALAR_ITER)
    packing = F.arrow_udf(pack, "part int, also int, wrap int, text binary", F.ArrowUDFType.SCALAR_ITER)
    dealt = rows.select("key", F.xxhash64("text").alias("tie"), packing("key", "text").alias("d")).withColumn("text", F.col("d.text"))
    # a key past the largest bound may be the top and a bound's follower at once: up to three roles
    roles = F.filter(F.array(F.struct(F.col("d.part").alias("part"), F.lit(0).alias("guard")), F.struct(F.col("d.also").alias("part"), F.lit(1).alias("guard")),
                             F.struct(F.col("d.wrap").alias("part"), F.lit(2).alias("guard"))), lambda r: r["part"] >= 0)
    placed = dealt.select("key", "text", "tie", F.explode(roles).alias("r")).select("key", "text", "tie", "r.part", "r.guard")
    names = ["key", "text", "part", "guard"]
    if threshold is not None:
        prints, classes = classified(rows, threshold, **options)
        where = prints.select("digest", dealing("key").alias("part")).distinct()
        ahead = where.join(classes, "digest").select(F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("binary").alias("text"), "part",
                                                     F.lit(-1).alias("guard"), "digest", "class_id", "links")
        placed = placed.unionByName(ahead, allowMissingColumns=True)
        names += ["digest", "class_id", "links"]
    ordered = (placed.repartition("part")
               .sortWithinPartitions("part", "guard", F.col("key").desc_nulls_last(), "tie").select(*names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _edit_ranges(batches, Signer(**options), threshold is not None)

    schema = ("key bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
              + ", class_id bigint, links bigint" * (threshold is not None))
    return ordered.mapInArrow(run, schema).withColumnRenamed("key", key)


def _edit_ranges(batches: Iterator[pa.RecordBatch], signer: Signer, classified: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range; in each, the classes of its sets (if ``classified``), its documents and then the documents that may follow its last.

    The last document of a range is held back until its follower is seen: the
    first guard of the range.  Guards of kind 2 (wrapping round to the first
    document) only stand in where there is no other.
    """
    schema = pa.schema([("key", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                        *([("class_id", pa.int64()), ("links", pa.int64())] if classified else [])])
    held: tuple | None = None
    classes: dict | None = {} if classified else None
    of = None  # the range of these classes
    unpack = zstandard.ZstdDecompressor().decompress
    # texts are unpacked some hundred at a time
    for batch in (b.slice(lo, 200) for b in batches for lo in range(0, b.num_rows, 200)):
        keys, parts, guards = batch.column("key").to_pylist(), batch.column("part").to_numpy(), batch.column("guard").to_numpy()
        texts = pa.array([None if x is None else unpack(x).decode() for x in batch.column("text").to_pylist()], pa.large_string())
        if classified:
            digests, ids, links = (batch.column(c).to_pylist() for c in ("digest", "class_id", "links"))
        for lo, hi, _, _ in blocks(texts, 1 << 18):
            cur = texts.slice(lo, hi - lo).to_pylist()
            todo: list[tuple] = []
            for i, t in enumerate(cur):
                if guards[lo + i] < 0:
                    if parts[lo + i] != of:
                        if todo:  # they still need the classes of their range
                            yield _edited_rows(todo, signer, schema, classes)
                        todo, of = [], parts[lo + i]
                        classes.clear()
                    classes[digests[lo + i]] = (ids[lo + i], links[lo + i])
                    continue
                at = (parts[lo + i], guards[lo + i], keys[lo + i], t)
                if held is not None and held[0] == at[0]:
                    todo.append((held[2], held[3], t))
                # of a range, only documents wait for a follower
                held = at if at[1] == 0 else None
            if todo:
                yield _edited_rows(todo, signer, schema, classes)


def _edited_rows(todo: list[tuple], signer: Signer, schema: pa.Schema, classes: dict | None = None) -> pa.RecordBatch:
    keys, own, following = zip(*todo)
    n = len(todo)
    lengths = [len(t) for t in own]
    edited = [t[:k - k // 3] + f[:k // 3] for t, f, k in zip(own, following, lengths)]
    data, off = text_arrays(pa.array([*own, *edited, *following], pa.large_string()))
    sig, at = signer.sets(data, off)
    sets = [sig[a:b] for a, b in zip(at[:-1], at[1:])]
    found = [] if classes is None else [pa.array(x, pa.int64()) for x in zip(*[classes[set_digest(s)] for s in sets[:n]])]
    return pa.RecordBatch.from_arrays([
        pa.array(keys, pa.int64()), pa.array(lengths, pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array([encode_set(s) for s in sets[:n]], pa.string()), pa.array([encode_set(s) for s in sets[n:2 * n]], pa.string()),
        pa.array([jaccard(a, b) for a, b in zip(sets[:n], sets[n:2 * n])], pa.float64()),
        pa.array([jaccard(a, b) for a, b in zip(sets[:n], sets[2 * n:])], pa.float64()), *found], schema=schema)
