"""The pipeline's stages against brute force, one after the other."""

import collections
import importlib
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martline.llm import langid, mixing
from tests.llm.test_bpe_secrets import digests
from tests.llm.test_lines_quality_mixing import brute_lines
from tests.llm.test_simhash import brute_components, brute_fingerprint

DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    state = {name: f for name, f in corpus_pipeline.STAGES}
    out = state["language_id"](spark, docs, DIR)
    rows = out.collect()
    assert out.columns == columns
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or ""))

    out = state["line_dedup"](spark, out, DIR)
    texts = brute_lines([r.text for r in rows], 10)
    want = {r.doc_id: t for r, t in zip(rows, texts)}
    rows = out.collect()
    assert out.columns == columns and {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)

    out = state["simhash_near_dedup"](spark, out, DIR)
    root = brute_components({brute_fingerprint(t) for t in want.values()})
    keep = {}
    for key, t in want.items():
        r = root[brute_fingerprint(t)]
        keep[r] = min(keep.get(r, key), key)
    rows = out.collect()
    assert out.columns == columns and {r.doc_id: r.text for r in rows} == {k: want[k] for k in keep.values()}

    mixed = state["mixing"](spark, out, DIR)
    plan = {r.doc_id: r for r in mixing.take_plan(out).collect()}
    taken = collections.Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == columns and taken == +collections.Counter({k: p.whole + (p.part > 0 and 2 * p.part >= p.size) for k, p in plan.items()})
    kept = {r.doc_id: r.text for r in out.collect()}
    assert all(kept[r.doc_id] == r.text for r in mixed.collect())

    final = state["bpe"](spark, mixed, DIR).collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in final) == \
        collections.Counter((r.doc_id, *digests(r.text)) for r in mixed.collect())


def test_run_equals_stage_by_stage(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
    assert collections.Counter(map(tuple, corpus_pipeline.run(spark, DIR).collect())) == collections.Counter(map(tuple, docs.collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_cases(spark, awkward, nothing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    base = ["doc_id", "text", "lang", "source", "n_chars", "score", "key", "kept_text", "Lang_Pred"]
    out = stage(spark, awkward.select(*base), DIR)
    assert name == "bpe" or out.columns == base
    out.collect()
    assert stage(spark, nothing.select(*base), DIR).collect() == []
    if name == "language_id":
        assert {r.text for r in out.collect()} == {r.text for r in awkward.collect() if r.text and any(c.isalpha() for c in r.text)}


def test_undetermined_documents_go(spark):
    docs = spark.createDataFrame([(1, "hello there", "en", "s", 11), (2, "123 456", "en", "s", 7), (3, None, "en", "s", None)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert [r.doc_id for r in corpus_pipeline.language_stage(spark, docs, DIR).collect()] == [1]
    assert langid.UNDETERMINED == "und"


def test_language_stage_fills_missing_languages(spark, monkeypatch):
    """The network's answer is the language of a document without one; without the model such rows stay without."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    some = docs.withColumn("lang", F.when(~lost, F.col("lang")))
    truth = {r.doc_id: r.lang for r in docs.where(lost).collect()}
    got = {r.doc_id: r.lang for r in corpus_pipeline.language_stage(spark, some, DIR).collect()}
    filled = [got[k] == v for k, v in truth.items() if k in got and v is not None]
    assert len(filled) > 50 and sum(filled) > 0.95 * len(filled) and None not in got.values()
    assert all(got[r.doc_id] == r.lang for r in some.where("lang IS NOT NULL").collect() if r.doc_id in got)
    monkeypatch.setattr(langid, "fit", lambda *a, **kw: None)
    without = corpus_pipeline.language_stage(spark, some, DIR).collect()
    assert {(r.doc_id, r.lang) for r in without} != set(got.items())


def test_nothing_else_imports_the_subpackage():
    code = "import sys, __spark_entry__, martline.registry, martline.catalog, martline.plans.rebuild; sys.exit(any(m.startswith('martline.llm') for m in sys.modules))"
    root = importlib.import_module("corpus_pipeline").__file__.rsplit("/", 1)[0]
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
