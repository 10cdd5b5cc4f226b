import collections
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from martline.llm import simhash
from martline.llm.blocks import U64, blocks


def brute_fingerprint(text):
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius=3):
    """fingerprint -> smallest fingerprint reachable."""
    left, root = set(prints), {}
    while left:
        start = min(left)
        todo, found = [start], {start}
        while todo:
            x = todo.pop()
            near = {y for y in left - found if (x ^ y).bit_count() <= radius}
            found |= near
            todo += near
        for x in found:
            root[x] = start
        left -= found
    return root


def check(docs, **options):
    rows = simhash.near_duplicate_groups(docs, **options).collect()
    assert len(rows) == docs.count()
    want = {r.doc_id: None for r in rows}
    text = collections.defaultdict(set)
    for r in docs.select("doc_id", "text").collect():
        text[r.doc_id].add(brute_fingerprint(r.text))
    root = brute_components({f for s in text.values() for f in s})
    least = {}
    for key, fs in text.items():
        for f in fs:
            if key is not None:
                least[root[f]] = min(least.get(root[f], key), key)
    for r in rows:
        f = r.fp % (1 << 64)
        assert f in text[r.doc_id]
        assert r.component_id == least.get(root[f])
    assert want.keys() == text.keys()


def test_groups_match_brute_force(docs_small, awkward):
    check(docs_small)
    check(awkward)


def test_hex_and_order(docs_small):
    rows = docs_small.limit(50).select("text")
    got = simhash.with_fingerprints(rows).withColumn("h", simhash.hex_fingerprint("fp")).collect()
    assert all(int(r.h, 16) == brute_fingerprint(r.text) and len(r.h) == 16 for r in got)
    assert int(simhash.simhash_block(np.zeros(0, np.uint8), np.array([0, 0]))[0]) == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 7])
def test_lanes_equal_distances(radius):
    rng = np.random.default_rng(radius)
    members = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
    members[100:] = members[:100]
    for i in range(100, 200):
        for b in rng.choice(64, rng.integers(0, 9), replace=False):
            members[i] ^= U64(1) << U64(b)
    planes = simhash.vertical(members)
    q, w = np.repeat(np.arange(200), 4), np.tile(np.arange(4), 200)
    at, lanes = simhash.near_lanes(members[q], planes, w, radius)
    found = {(int(q[a]), int(w[a] * 64 + b)) for a, x in zip(at, lanes) for b in range(64) if int(x) >> b & 1 and w[a] * 64 + b < 200}
    want = {(i, j) for i in range(200) for j in range(200) if int(members[i] ^ members[j]).bit_count() <= radius}
    assert found == want


def linked(spark, prints, **options):
    docs = spark.createDataFrame([(int(x) - (1 << 64) if int(x) >> 63 else int(x),) for x in prints], "fp bigint")
    return simhash.fingerprint_links(docs, **options)


def test_hot_files_take_finer_blocks(spark):
    """A third of all fingerprints in one neighbourhood: files go over the limit at the first levels."""
    rng = np.random.default_rng(9)
    centre = int(rng.integers(0, 1 << 63))
    prints = {centre}
    while len(prints) < 300:
        x = centre
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            x ^= 1 << int(b)
        prints.add(x)
    prints |= {int(x) for x in rng.integers(0, 1 << 63, 600)}
    want = brute_components(prints)
    for limit in (4096, 16, 3):
        roots = {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.connected(linked(spark, prints, limit=limit)).collect()}
        groups, mine = collections.defaultdict(set), collections.defaultdict(set)
        for x in prints:
            groups[want[x]].add(x)
            mine[roots.get(x, x)].add(x)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_connected_on_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 7), (1000, 900), (900, 1000), (901, 900)]
    got = {r.node: r.root for r in simhash.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(101, 161)} == {100} and {got[i] for i in range(501, 540)} == {500}
    assert got[1000] == got[901] == 900 and 7 not in got


def test_streamed_files_do_not_depend_on_batches():
    rng = np.random.default_rng(4)
    key = np.sort(rng.integers(0, 40, 2000))
    fp = np.where(rng.random(2000) < 0.5, key * 1_000_003, rng.integers(0, 1 << 40, 2000))
    whole = None
    for size in (2000, 7, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array(np.zeros(len(k), np.int32)), pa.array(k), pa.array(f)], ["choice", "key", "fp"])
                   for k, f in ((key[i:i + size], fp[i:i + size]) for i in range(0, 2000, size))]
        for limit in (None, 30):
            out = {(a, b) for r in simhash._compare_files(iter(batches), 3, limit, at_once=64) for a, b in zip(r["a"].to_pylist(), r["b"].to_pylist())}
            if limit is None:
                whole = out if whole is None else whole
                assert {x for x in out} == whole
            else:
                big = {int(f) for k in range(40) if (key == k).sum() > 30 for f in fp[key == k]}
                assert {a for a, b in out if b is None} == big


def test_keep_one(docs_small, awkward, nothing):
    for docs in (docs_small, awkward):
        groups = simhash.near_duplicate_groups(docs).collect()
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert len(rows) == len({r.root for r in groups})
        ids = {r.root: r.component_id for r in groups}
        assert collections.Counter(r.doc_id for r in rows) == collections.Counter(ids.values())
    assert simhash.keep_one(nothing).collect() == []
    assert simhash.near_duplicate_groups(nothing).select(F.col("fp")).collect() == []
    assert [d for _, _, d, _ in blocks(pa.array([], pa.string()))] == []
