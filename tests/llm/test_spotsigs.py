import hashlib

import numpy as np
import pyarrow as pa

from martline.llm import spotsigs
from martline.llm.blocks import blocks


def expected(docs):
    """Brute force over (key, text): the edited text of every row."""
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    out = {}
    for i, (key, text) in enumerate(order):
        following, k = order[(i + 1) % len(order)][1] or "", len(text or "") // 3
        text = text or ""
        out[key] = (len(text), hashlib.sha256((text[:len(text) - k] + following[:k]).encode()).hexdigest(), text, following)
    return out


def test_edits_and_likeness(docs_small):
    rows = docs_small.select("doc_id", "text").collect()
    want = expected([(r.doc_id, r.text) for r in rows])
    for ranges in (1, 7, 400):
        got = spotsigs.edited_fingerprints(docs_small, ranges=ranges).collect()
        assert len(got) == len(want) == len({r.doc_id for r in got})
        prints = {r.doc_id: r.fingerprint for r in got}
        by_text = {}
        for r in got:
            n, sha, text, following = want[r.doc_id]
            assert (r.n_chars, r.edited_sha256) == (n, sha)
            assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
            a, b = spotsigs.decode_set(r.fingerprint), spotsigs.decode_set(r.edited_fingerprint)
            union = len(set(a) | set(b))
            assert abs(r.near_edited - (len(set(a) & set(b)) / union if union else 1)) < 1e-12
        order = sorted(prints, reverse=True)
        for i, r in enumerate(sorted(got, key=lambda r: -r.doc_id)):
            a, b = (set(spotsigs.decode_set(prints[k])) for k in (order[i], order[(i + 1) % len(order)]))
            assert abs(r.near_next - (len(a & b) / len(a | b) if a | b else 1)) < 1e-12
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.9


def brute_set(text, signer):
    import re
    words = [w.lower().encode() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w).encode()
             for w in re.findall(r"[A-Za-z0-9\u0080-\U0010FFFF]+", text)]
    common = {w.lower().encode() for w in spotsigs.COMMON_WORDS}
    chains, last = set(), 0
    for i, w in enumerate(words):
        rest = [x for x in words[i + 1:] if x not in common]
        last = i if w in common else last
        if (w in common or i - last > signer.gap) and len(rest) >= signer.chain:
            chains.add((w, *rest[:signer.chain]))
    return chains


def test_signatures_follow_anchors(docs_small):
    signer = spotsigs.Signer()
    texts = [r.text for r in docs_small.limit(60).collect()] + [
        "the", "cat", "the cat", "the big cat", "The, BIG cat! the the big cat", "", "a1 | a2 | a3 a4 a5 a6 a7 a8 a9 a10", "xyz " * 40]
    for _, _, data, off in blocks(pa.array(texts)):
        sig, at = signer.sets(data, off)
        break
    for t, a, b in zip(texts, at[:-1], at[1:]):
        want = len(brute_set(t, signer))
        assert b - a == (want if want else min(1, len(t.split())))


def test_join_matches_all_pairs(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(60):
        base = " ".join(f"the {' '.join(rng.choice(words, 2))}" for _ in range(rng.integers(3, 25)))
        docs.append((3 * i, base))
        docs.append((3 * i + 1, base + " the new tail"))
        if i % 4 == 0:
            docs.append((3 * i + 2, base))
    docs += [(1000, ""), (1001, None), (1002, "!!")]
    got = {r.doc_id: r for r in spotsigs.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    signer = spotsigs.Signer()
    sets = {}
    for key, t in docs:
        for _, _, data, off in blocks(pa.array([t or ""])):
            sig, at = signer.sets(data, off)
            sets[key] = frozenset(sig.tolist())
    first = {}
    for key, s in sorted(sets.items()):
        first.setdefault(s, key)
    for key, s in sets.items():
        links = sum(1 for o in first if o != s and o and s and len(o & s) >= 0.8 * len(o | s))
        assert (got[key].class_id, got[key].links) == (first[s], links)


def test_cases(awkward, nothing):
    got = spotsigs.edited_fingerprints(awkward).collect()
    assert len(got) == awkward.count()
    same = {r.fingerprint for r in got if r.n_chars == 44}
    assert len(same) == 1
    assert all(r.fingerprint == "" for r in got if r.n_chars == 0)
    assert spotsigs.edited_fingerprints(nothing).collect() == []
    assert len(spotsigs.edited_fingerprints(awkward.where("doc_id = 3")).collect()) == 1
    assert len(spotsigs.edited_fingerprints(awkward.where("doc_id IS NULL")).collect()) == 2
    assert len(spotsigs.near_duplicates(awkward).collect()) == awkward.where("doc_id IS NOT NULL").count()
    assert spotsigs.near_duplicates(nothing).collect() == []


def test_query_links_equal_all_pairs(spark, docs_small):
    from martline.llm.queries import QUERIES
    got = QUERIES["op2_spotsigs"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == docs_small.count()
    first, sets = {}, {}
    for r in sorted(got, key=lambda r: r.doc_id):
        first.setdefault(r.fingerprint, r.doc_id)
        sets[r.fingerprint] = frozenset(spotsigs.decode_set(r.fingerprint).tolist())
    links = {a: sum(a != b and len(x & y) >= 0.8 * len(x | y) for b, y in sets.items() if y) if x else 0 for a, x in sets.items()}
    assert any(links.values())
    assert all((r.class_id, r.links) == (first[r.fingerprint], links[r.fingerprint]) for r in got)


def test_classes_of_awkward_rows(awkward, nothing):
    plain = {(r.doc_id, r.n_chars, r.fingerprint) for r in spotsigs.edited_fingerprints(awkward).collect()}
    for ranges in (1, 5):
        got = spotsigs.edited_fingerprints(awkward, ranges=ranges, threshold=0.8).collect()
        assert len(got) == awkward.count() and {(r.doc_id, r.n_chars, r.fingerprint) for r in got} == plain
        for r in got:
            keys = [x.doc_id for x in got if x.fingerprint == r.fingerprint and x.doc_id is not None]
            assert r.class_id == min(keys, default=None)
    assert spotsigs.edited_fingerprints(nothing, threshold=0.8).collect() == []


def test_files_share_a_key_whenever_sets_are_alike():
    rng = np.random.default_rng(5)
    for t in (0.6, 0.8, 0.9):
        files = spotsigs.LengthFiles(t, rng.integers(0, 50, 20))
        for _ in range(600):
            n = int(rng.integers(1, 120))
            pool = rng.permutation(400).astype(np.uint32)
            a, gone, more = pool[:n], int(rng.integers(0, n // 4 + 1)), int(rng.integers(0, n // 4 + 1))
            b = np.concatenate([a[gone:], pool[n:n + more]])
            if len(b) and gone + more and spotsigs.jaccard(np.sort(a), np.sort(b)) >= t:
                assert set(files.keys(np.sort(a)).tolist()) & set(files.keys(np.sort(b)).tolist())
    many = [np.sort(rng.permutation(60)[:50].astype(np.uint32)) for _ in range(70)]
    want = [sum(spotsigs.jaccard(x, y) >= 0.8 for j, y in enumerate(many) if j != i) for i, x in enumerate(many)]
    assert spotsigs.count_links(many, np.ones(70, bool), 0.8, block=16, columns=7).tolist() == want


def with_template(rng, n, share):
    """Documents of which a share of the signatures comes from one template, the rest from nowhere else."""
    template = [f"the t{i} u{i}" for i in range(int(100 * share))]
    return [(k, " ".join([*template, *(f"the {rng.integers(1 << 40):x} {rng.integers(1 << 40):x}" for _ in range(100 - len(template)))])) for k in range(n)]


def test_templates_make_no_groups(spark):
    rng = np.random.default_rng(9)
    for share in (0.5, 0.7):
        rows = spark.createDataFrame(with_template(rng, 700, share), "key bigint, text string").repartition(4)
        sets, roots = spotsigs.similar_groups(rows, 0.8)
        assert roots.count() == 0
        assert spotsigs.similar_classes(rows, 0.8).count() == 0


def test_large_files_and_groups_in_slices(spark, monkeypatch):
    """Many near copies, split into slices in files and in groups, have the links of all pairs."""
    rng = np.random.default_rng(10)
    base = [f"the {a} {b}" for a, b in zip(rng.permutation(10_000)[:80], rng.permutation(10_000)[:80])]
    docs = []
    for k in range(420):
        words = list(base)
        for at in rng.integers(0, 80, rng.integers(0, 12)):
            words[at] = f"the {rng.integers(1 << 40):x} x"
        docs.append((k, " ".join(words)))
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in spotsigs.near_duplicates(rows).collect()}
    signer, sets = spotsigs.Signer(), {}
    for key, t in docs:
        for _, _, data, off in blocks(pa.array([t])):
            sets[key] = frozenset(signer.sets(data, off)[0].tolist())
    first = {}
    for key, s in sorted(sets.items()):
        first.setdefault(s, key)
    want = {s: sum(1 for o in first if o != s and len(o & s) >= 0.8 * len(o | s)) for s in first}
    assert max(want.values()) > 200 and min(want.values()) < 10 + max(want.values())
    assert all((got[k].class_id, got[k].links) == (first[s], want[s]) for k, s in sets.items())


def test_sketches_never_part_sets_that_are_alike():
    rng = np.random.default_rng(11)
    for t in (0.6, 0.8):
        found = []
        for _ in range(150):
            pool = rng.integers(0, 1 << 32, 900, dtype=np.uint64).astype(np.uint32)
            n = int(rng.integers(1, 600))
            a, gone = pool[:n], int(rng.integers(0, n // 4 + 1))
            found += [np.unique(a), np.unique(np.concatenate([a[gone:], pool[n:n + int(rng.integers(0, n // 4 + 1))]]))]
        found = [x for x in found if len(x)]
        words, folded = spotsigs._folded([spotsigs.parity_sketch(x) for x in found])
        n = np.array([len(x) for x in found])
        a, b = np.triu_indices(len(found), 1)
        passing = spotsigs._passing(a, b, n, words, folded, t)
        alike = np.array([spotsigs.jaccard(found[i], found[j]) >= t for i, j in zip(a, b)])
        assert alike.any() and passing[alike].all() and passing[~alike].mean() < 0.01
