import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martline.llm import linededup, mixing, quality
from martline.llm.blocks import blocks

SPACES = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACES))


def brute_lines(texts, min_docs):
    seen = collections.Counter(k for t in texts for k in {key_of(x) for x in (t or "").split("\n")} if k)
    return ["\n".join(x for x in (t or "").split("\n") if not key_of(x) or seen[key_of(x)] < min_docs) for t in texts]


@pytest.mark.parametrize("broadcast_bytes", [1 << 25, 0])
def test_lines_both_ways(docs_small, awkward, broadcast_bytes):
    for docs, least in ((docs_small, 4), (awkward, 2)):
        rows = linededup.drop_frequent_lines(docs, min_docs=least, broadcast_bytes=broadcast_bytes).collect()
        texts = [r.text for r in rows]
        want = brute_lines(texts, least)
        assert len(rows) == docs.count()
        for r, w in zip(rows, want):
            assert r.kept_text == w and r.n_lines == len((r.text or "").split("\n"))
        assert any(r.n_dropped for r in rows)


def test_lines_empty_and_unicode(spark, nothing):
    assert linededup.drop_frequent_lines(nothing).collect() == []
    docs = spark.createDataFrame([(i, "Ärger\n x\n X\t\nx\u0085") for i in range(3)], "doc_id bigint, text string")
    assert {r.n_dropped for r in linededup.drop_frequent_lines(docs, min_docs=3).collect()} == {4}


def brute_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    marked = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked)


def test_base_counts(docs_small, awkward):
    for docs in (docs_small, awkward):
        rows = quality.quality_report(docs, quality.default_rules()).collect()
        assert len(rows) == docs.count()
        for r in rows:
            n, *rest = brute_counts(r.text or "")
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
            assert r.base_failed == (n < 50 or 100 * rest[-1] > 50 * n)
            assert not (r.kept and r.base_failed) and r.kept == (not r.base_failed and r.failed_rule is None)


def test_verdict_does_not_depend_on_order(docs_small):
    rules = quality.default_rules()
    for _, _, data, off in blocks(pa.array([r.text for r in docs_small.collect()])):
        forward = quality.first_failure(quality.Texts(data, off), rules) >= 0
        backward = quality.first_failure(quality.Texts(data, off), rules[::-1]) >= 0
        alone = np.any([r.fails(quality.Texts(data, off)) for r in rules], axis=0)
        assert (forward == backward).all() and (forward == alone).all()


def test_rules_are_ordered_by_rejections_per_cost():
    rules = [quality.Rule(n, None) for n in "abcd"]
    order = quality.order_rules(rules, [("a", 1.0, 0.1), ("b", 0.5, 0.1), ("c", 1.0, 0.0), ("d", 0.1, 0.0)])
    assert [r.name for r in order] == ["b", "a", "d", "c"]


def test_cascade_cases(awkward, nothing, docs_small):
    rules = quality.plan_cascade(awkward)
    assert sorted(r.name for r in rules) == sorted(r.name for r in quality.default_rules())
    assert quality.apply_cascade(awkward, rules).count() == awkward.count()
    assert quality.plan_cascade(nothing) and quality.quality_report(nothing, rules).collect() == []


def fill(sizes, weights, share, most):
    """Water-filling by the book."""
    total, target, free = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        w = sum(weights[i] for i in free)
        over = {i for i in free if total * weights[i] / w >= most * sizes[i]}
        if not over:
            for i in free:
                target[i] = total * weights[i] / w
            break
        for i in over:
            target[i] = most * sizes[i]
            total -= target[i]
        free -= over
    return target


@pytest.mark.parametrize("share,most", [(1.5, 2.0), (0.3, 2.0), (2.0, 2.0), (1.0, 1.0), (3.0, 4.0)])
def test_targets(spark, share, most):
    sizes = [("a", 100), ("b", 5), ("c", 900), ("d", 50), ("e", 0), (None, 333), ("z", 20)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, size bigint"), share=share, max_epochs=most).collect()}
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    want = fill([s for _, s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], share, most)
    for (name, _), w in zip(order, want):
        assert got[name] == pytest.approx(w, abs=1e-9)


def test_mix_takes_what_the_plan_says(docs_small, awkward):
    for docs in (docs_small, awkward):
        plan = mixing.take_plan(docs)
        rows = plan.collect()
        assert len(rows) == docs.count()
        taken = collections.Counter()
        for r in rows:
            assert 0 <= r.whole * r.size + r.part <= 2 * r.size
            taken[r.source] += r.whole * r.size + r.part
        for r in rows:
            assert abs(taken[r.source] - r.target) <= 2
        mixed = mixing.mix(docs)
        assert mixed.columns == docs.columns
        # documents are taken whole: the one in which a round ends once more if half of it or more is wanted
        copies = collections.Counter({(r.source, r.size): 0 for r in rows})
        for r in rows:
            copies[r.source, r.size] += r.whole + (r.part > 0 and 2 * r.part >= r.size)
        made = collections.Counter((m.source, len(re.findall(r"[^\x20\x09-\x0D]+", m.text or ""))) for m in mixed.collect())
        assert made == +copies
        assert {m.text for m in mixed.collect()} <= {m.text for m in docs.collect()}
        again = mixing.take_plan(docs.repartition(5)).collect()
        assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_mix_of_nothing(nothing):
    assert mixing.take_plan(nothing).collect() == [] and mixing.mix(nothing).collect() == []


def test_hot_source_is_not_ordered_whole(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id % 7 + 1 AS int))").alias("text"),
                                    F.expr("if(id % 3 = 0, 'hot', concat('s', id % 11))").alias("source"))
    rows = mixing.take_plan(docs).collect()
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += r.whole * r.size + r.part
    assert all(taken[r.source] == int(r.target) for r in rows)


def test_many_rows_of_one_id_are_told_apart_by_text(spark):
    docs = spark.range(400).selectExpr("CAST(NULL AS bigint) AS doc_id", "concat('one two three ', id) AS text", "CASE WHEN id < 300 THEN 'a' ELSE 'b' END AS source")
    rows = mixing.take_plan(docs, share=0.4).collect()
    assert sum(0 < r.part < r.size for r in rows) <= 2
    words = sum(4 for _ in mixing.mix(docs, share=0.4).collect())
    assert abs(words - 0.4 * 1600) <= 4


def test_sources_beyond_number_are_weighed_in_order(spark):
    """Sources with a long common prefix, numbered over several partitions."""
    names = [None if i == 77 else f"https://example.org/a/long/common/prefix/{i:05d}" for i in range(900)]
    sizes = spark.createDataFrame([(n, 10) for n in names], "source string, size bigint").repartition(7)
    got = {r.source: r.target for r in mixing.source_targets(sizes, weights=(3, 1, 2), share=0.5).collect()}
    order = sorted(names, key=lambda s: (s is None, s or ""))
    for i, n in enumerate(order):
        assert got[n] == pytest.approx(0.5 * 9000 * (3, 1, 2)[i % 3] / 1800)
    plan = mixing.source_targets(sizes)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_names_in_between_are_not_taken_from_the_input(spark, awkward):
    """Columns that are called like an operator's own in-between columns come through unchanged."""
    from martline.llm import bpe, langid, simhash, toxicity
    from martline.llm.queries import BPE_VOCABULARY
    mine = ["__out", "__mark", "__key", "__hash2", "__letter", "__drops", "out", "far", "mark", "letter", "stay_key", "nth"]
    model = langid.fit(awkward)
    scores = toxicity.fit(awkward, spark.createDataFrame([(1, 1), (3, 0)], "doc_id bigint, toxic int"))
    for made in (langid.predict(awkward, model), linededup.drop_frequent_lines(awkward), linededup.drop_frequent_lines(awkward, broadcast_bytes=0),
                 bpe.round_trip(awkward, BPE_VOCABULARY), bpe.round_trip(awkward, BPE_VOCABULARY, long_chars=1000), bpe.encode(awkward, BPE_VOCABULARY, long_chars=1000),
                 quality.quality_report(awkward, quality.default_rules()), quality.apply_cascade(awkward, quality.default_rules()), mixing.mix(awkward),
                 toxicity.predict(awkward, scores), simhash.keep_one(awkward)):
        for r in made.select(*mine).distinct().collect():
            assert set(r) == {"kept as it is"}


def test_rows_of_one_id_and_text_keep_the_least_of_the_rest(spark):
    from martline.llm import simhash
    rows = [(1, "a b c d e", None, x) for x in ("z", "b", "m")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    for parts in (1, 3):
        assert [r.source for r in simhash.keep_one(docs.repartition(parts)).collect()] == ["b"]


def test_sample_is_bounded_however_ids_repeat(spark):
    from martline.llm.blocks import bounded_sample
    rows = spark.range(100_000).selectExpr("CAST(1 AS bigint) AS doc_id", "CASE WHEN id % 4 = 0 THEN 'de' ELSE 'en' END AS lang", "concat('text ', id % 50000) AS text")
    same = rows.withColumn("text", F.lit("always the same"))
    found = collections.Counter(label for label, _ in bounded_sample(rows, F.col("lang"), F.col("text"), 800))
    assert all(700 <= n <= 1100 for n in found.values()) and len(found) == 2
    assert sorted(bounded_sample(same, F.col("lang"), F.col("text"), 800)) == [("de", "always the same"), ("en", "always the same")]
    assert bounded_sample(rows, F.col("lang"), F.col("text"), 800) == bounded_sample(rows.repartition(9), F.col("lang"), F.col("text"), 800)


def test_many_texts_of_one_labelled_id(spark):
    from martline.llm import toxicity
    docs = spark.range(20_000).selectExpr("CASE WHEN id < 19990 THEN 7 ELSE id END AS doc_id", "concat('text ', id) AS text")
    labels = spark.createDataFrame([(7, 1), (19995, 0), (19996, 0)], "doc_id bigint, toxic int")
    texts = docs.toDF("id", "text")
    pairs = toxicity._sampled_pairs(texts, labels.toDF("key", "label"), {0: 10, 1: 10})
    assert sorted(label for label, _ in pairs) == [0, 0, 1]


def test_long_text_takes_windows_a_few_at_a_time():
    import tracemalloc
    from martline.llm import langid
    model = langid.train([("a", b"the cat sat"), ("b", b"zzz 123")] * 3, filters=4, epochs=1)
    data = np.frombuffer(b"the cat sat on the mat " * 500_000, np.uint8)
    tracemalloc.start()
    langid.classify(model, data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 0.5 * len(data)
