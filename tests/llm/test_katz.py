"""The model against a dictionary-based Katz model."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martline.llm import katz

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, train):
    """(n_tokens, n_known, N, base, score) of every text, and the sums of the model's distributions."""
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) for t in texts]
    end, begin = ("end",), ("begin",)
    c, pairs = Counter(), Counter()
    for t, learn in zip(tokens, train):
        if learn:
            c.update(t + [end])
            pairs.update(zip([begin, *t], t + [end]))
    n, v = sum(c.values()), len(c)
    counts = lambda x: np.array([Counter(x.values())[r] for r in range(1, katz.MAX_DISCOUNTED + 2)])
    d1, d2 = katz.good_turing(counts(c)), katz.good_turing(counts(pairs))
    cut = lambda d, r: d[r] * r if r < len(d) else r
    freed = sum(r - cut(d1, r) for r in c.values() if r <= katz.MAX_DISCOUNTED)
    total = n + (0 if freed else 1)
    unknown = (freed or 1) / total if n else 1.0
    p1 = lambda w: cut(d1, c[w]) / total if c[w] else unknown
    after = defaultdict(list)
    for (a, b), r in pairs.items():
        after[a].append((b, r))
    weight = {}
    for a, seen in after.items():
        s, left = sum(r for _, r in seen), sum(r - cut(d2, r) for _, r in seen if r <= katz.MAX_DISCOUNTED)
        s, left = (s, left) if left else (s + 1, 1)
        weight[a] = s, left / s / (1 - sum(p1(b) for b, _ in seen))

    def p(a, b):
        if a not in weight:
            return p1(b)
        return cut(d2, pairs[a, b]) / weight[a][0] if pairs[a, b] else weight[a][1] * p1(b)

    sums = [sum(p(a, b) for b in c) + weight[a][1] * unknown for a in list(weight)[:5]]
    out = []
    for t in tokens:
        s = t + [end]
        out.append((len(s), sum(c[w] > 0 for w in s), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in s), sum(math.log10(p(a, b)) for a, b in zip([begin, *t], s))))
    return out, sums


@pytest.mark.parametrize("chunk_bytes,range_tokens", [(1 << 23, 1 << 20), (20_000, 3_000)])
def test_scores(docs_small, chunk_bytes, range_tokens):
    mod = F.crc32(F.col("doc_id").cast("string")) % 7
    got = sorted(katz.katz_scores(docs_small, mod != 2, mod == 2, chunk_bytes=chunk_bytes, range_tokens=range_tokens).collect(), key=lambda r: r.doc_id)
    text = {r.doc_id: r.text for r in docs_small.collect()}
    train = [zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for r in got]
    want, sums = brute([text[r.doc_id] for r in got], train)
    assert all(abs(s - 1) < 1e-9 for s in sums)
    for r, t, w in zip(got, train, want):
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (*w[:3], not t)
        assert r.base_score == pytest.approx(w[3], rel=1e-9) and r.score == pytest.approx(w[4], rel=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_frequent_followers_only(spark):
    docs = spark.createDataFrame([(i, "a b " * 30) for i in range(9)], "doc_id bigint, text string")
    got = katz.katz_scores(docs, F.col("doc_id") != 3, F.col("doc_id") == 3).collect()
    want, sums = brute(["a b " * 30] * 9, [i != 3 for i in range(9)])
    assert all(abs(s - 1) < 1e-9 for s in sums)
    assert {round(r.score, 9) for r in got} == {round(want[0][4], 9)}


def test_cases(awkward, nothing):
    got = katz.katz_scores(awkward, F.col("doc_id") != 5, F.col("doc_id") == 5).collect()
    assert len(got) == awkward.count()
    text = [r for r in awkward.select("doc_id", "text").collect()]
    want, _ = brute([r.text for r in text], [r.doc_id is not None and r.doc_id != 5 for r in text])
    assert sorted(round(r.score, 6) for r in got) == sorted(round(w[4], 6) for w in want)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    nobody = katz.katz_scores(awkward, F.lit(False), F.lit(True)).collect()
    assert {(r.score, r.base_score, r.train_tokens, r.n_known) for r in nobody} == {(0.0, 0.0, 0, 0)}
    assert katz.katz_scores(nothing, F.lit(True), F.lit(False)).collect() == []


def test_packing():
    rng = np.random.default_rng(1)
    for keys in (np.zeros(0, np.uint64), np.array([7], np.uint64), np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64)),
                 np.array([1, 2, (1 << 64) - 1], np.uint64)):
        if len(keys):
            assert (katz.unpack_keys(katz.pack_keys(keys)) == keys).all()
        counts = rng.integers(0, 600, len(keys))
        got, rest = katz.unpack_counts(katz.pack_counts(counts) + b"xyz")
        assert (got == counts).all() and rest == b"xyz"
    codes = rng.integers(0, 1 << 20, 5000)
    assert (katz.unpack_codes(katz.pack_codes(codes), 5000) == codes).all()
    assert len(katz.unpack_codes(katz.pack_codes(codes[:0]), 0)) == 0


def test_no_table_is_left_in_the_catalog(spark, docs_small):
    from pyspark.sql import functions as F
    before = {t.name for t in spark.catalog.listTables()}
    assert katz.katz_scores(docs_small, F.lit(True), F.lit(False)).count() == docs_small.count()
    assert {t.name for t in spark.catalog.listTables()} == before
