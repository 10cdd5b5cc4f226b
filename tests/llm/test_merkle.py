import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martline.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows, fanout=16):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified), level by level in plain Python."""
    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                lo = p - p % fanout
                paths[i].append(("".join(nodes[lo:p]), "".join(nodes[p + 1:lo + fanout])))
                at[i] = p // fanout
            nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        return nodes[0], paths

    groups, trees = {}, []
    for r in rows:
        leaf = sha("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, r.text))))
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf, r))
    for g in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        leaves = sorted(groups[g], key=lambda x: x[:3])
        trees.append((leaves, *tree([x[2] for x in leaves])))
    if not trees:
        return []
    root, tops = tree([t[1] for t in trees])
    out = []
    for (leaves, subroot, paths), top in zip(trees, tops):
        for (_, _, leaf, r), path in zip(leaves, paths):
            folded = leaf
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                low = r.text and "".join(c.lower() if c.isascii() else c for c in r.text)
                folded = sha("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, low))))
            for before, after in path + top:
                folded = sha(before + folded + after)
            out.append((r.doc_id, leaf, subroot, root, sha("".join(b + a for b, a in path + top)), folded, folded == root))
    return sorted(out, key=str)


def run(spark, docs, monkeypatch, **kw):
    monkeypatch.setattr(queries, "documents", lambda *a: docs)
    build = merkle.build
    monkeypatch.setattr(merkle, "build", lambda *a: build(*a, **kw))
    return sorted(map(tuple, queries.op11_merkle_manifest(spark, "").collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_query_equals_brute_force(spark, awkward, docs_small, nothing, monkeypatch, levels):
    for docs in (awkward, docs_small, nothing):
        got = run(spark, docs, monkeypatch, levels=levels)
        assert got == brute(docs.collect())
        monkeypatch.undo()


def test_one_hot_group_and_many_groups(spark, monkeypatch):
    rows = spark.range(700).selectExpr("id AS doc_id", "CASE WHEN id < 600 THEN 'hot' ELSE cast(id AS string) END AS source", "'en' AS lang",
                                       "id AS n_chars", "concat('Text ', id % 7) AS text")
    docs = rows.unionByName(rows.where("doc_id < 40").withColumn("doc_id", F.lit(5).cast("bigint")).withColumn("n_chars", F.lit(1).cast("bigint")))
    assert run(spark, docs, monkeypatch, levels=1) == brute(docs.collect())


def test_addresses_are_a_permutation_by_aligned_subtrees():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 300, 4095, 4096, 70_000):
        for height in {merkle.height_of(n), merkle.height_of(n) + 1}:
            places = merkle._layout(n, height, 16)
            assert sorted(np.concatenate(places)) == list(range(sum(merkle.widths(n, height))))
            assert places[-1][0] == 0
    # three levels of hashing are four of nodes, split two and two: the root, its 16 children, then whole subtrees of 17
    top, mid, low = (merkle._layout(4096, 3, 16)[k] for k in (2, 1, 0))
    assert list(top) == list(range(1, 17)) and list(mid[:3]) == [17, 34, 51] and list(low[:17]) == [*range(18, 34), 35]


def test_siblings_lead_to_the_root():
    rng = np.random.default_rng(1)
    for n in (1, 16, 17, 300, 4096):
        digests = rng.integers(0, 256, (n, 32), dtype=np.uint8)
        height = merkle.height_of(n)
        nodes = merkle.build_block(digests, height)
        every = merkle._all_siblings(nodes, n, height, 16)
        for i in {0, n // 2, n - 1}:
            path = merkle.siblings(nodes, n, height, i)
            assert path == every[i]
            assert merkle.fold(digests[i].tobytes().hex(), path) == nodes[0].tobytes().hex()


def test_proof_rows_and_root(spark, docs_small):
    leaf = merkle.leaf_digest(*map(F.col, ("doc_id", "text")))
    manifest = merkle.build(docs_small, F.col("source"), F.col("doc_id"), leaf, levels=1)
    for r in merkle.proofs(manifest).collect():
        assert merkle.fold(r.leaf, [(p.before, p.after) for p in r.path]) == r.root == manifest.root
    assert merkle.build(docs_small.limit(0), F.col("source"), F.col("doc_id"), leaf).root is None
