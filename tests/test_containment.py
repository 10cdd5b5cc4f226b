"""Inverted-index matching against every pair."""

import random
import re

import pytest

from martline.operators import containment, joins

TEXTS = ["Always On 2024", "always", "on", "New York Nights in ATL", "newark", "ATLanta", "x(ATL)y", "a.b*c", "AXbYc", "", None, "L'été à Paris", "éATL", "日本のATL 日本", "aaaa", "a" * 300 + "needle" + "b" * 300,
         "GA", "GAZ GA_ GA-1", "ΑΒΓ", "İstanbul", "straße"]
TERMS = ["always on", "On", "new york", "ATL", "GA", "a.b*c", "aa", "needle", "n", "été", "日本", "ALWAYS ON 2024", "zzz", "", None, "(ATL)", "αβγ", "İ", "ß", "York Nights"]


def frames(spark, texts, terms):
    return (spark.createDataFrame([(t,) for t in texts] * 2, "v string").repartition(3), spark.createDataFrame([(t,) for t in terms], "w string"))


def java_lower(s):
    return s.lower()


@pytest.mark.parametrize("q", [1, 2, 4])
def test_contained_equals_all_pairs(spark, q):
    texts, terms = frames(spark, TEXTS, TERMS)
    got = sorted(tuple(r) for r in containment.contained(texts, "v", terms, "w", q=q).collect())
    assert got == sorted((t, w) for t in TEXTS if t for w in TERMS if w and java_lower(w) in java_lower(t))


def test_whole_words_equal_all_pairs(spark):
    texts, terms = frames(spark, TEXTS, TERMS)
    got = {tuple(r) for r in containment.whole_words(texts, "v", terms, "w").collect()}
    from martline.functions.text import word_match
    every = texts.distinct().crossJoin(terms).where("v <> '' AND w <> ''").where(word_match("v", "w"))
    assert got == {tuple(r) for r in every.collect()}
    assert ("New York Nights in ATL", "ATL") in got and ("ATLanta", "ATL") not in got and ("GAZ GA_ GA-1", "GA") in got


def test_many_terms_without_nested_loop(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=12)) for _ in range(300)]
    terms = [("k", " ".join(rng.choices(words, k=rng.randrange(1, 3))), rng.choice(["word", "substring"])) for _ in range(20_000)]
    t = spark.createDataFrame([(x,) for x in texts], "v string")
    found = joins.term_matches(t, "v", spark.createDataFrame(terms, "kind string, term string, mode string"))
    got = sorted(tuple(r) for r in found.collect())
    want = sorted((x, k, w) for x in set(texts) for k, w, mode in terms if (re.search(rf"\b{w}\b", x) if mode == "word" else w in x))
    assert got == want and len(got) > 500
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pairs_of_long_labels_both_ways(spark):
    a = ["Spring Sale " + "x" * 400, "sale", "Ω sale", None]
    b = ["SPRING SALE " + "X" * 400 + " extra", "Sale", "pring", "ω SALE!"]
    x, y = spark.createDataFrame([(v,) for v in a], "a string"), spark.createDataFrame([(v,) for v in b], "b string")
    got = sorted(tuple(r) for r in joins.substring_pairs(x, "a", y, "b").collect())
    low = str.lower
    assert got == sorted((v, w) for v in a if v for w in b if (low(w) in low(v) or low(v) in low(w)) and low(v) != low(w))
