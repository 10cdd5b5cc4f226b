import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from martline.llm import langid, toxicity
from martline.llm.blocks import blocks
from martline.llm.queries import QUERIES

DIR = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"


def test_language_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = QUERIES["op1_language_id"](spark, DIR).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95


def test_network_equals_direct_convolution():
    model = langid.train([("a", b"the cat sat"), ("b", "über ß".encode()), ("c", b"zzz 123")] * 3, filters=4, epochs=2, window=16)
    text = "The über cat zzz and more text than one window".encode()
    best, prob = langid.classify(model, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    total = np.zeros(3)
    for lo in range(0, len(text), 16):
        part = text[lo:lo + 16]
        codes = [int(model.byte_class[b]) for b in text[lo:lo + 16 + 3]] + [0] * 19
        h = []
        for w, t in model.tables.items():
            r = np.array([sum(t[j][codes[i + j]] for j in range(w)) for i in range(16)])
            h += list(np.maximum(r.max(axis=0), 0))
        z = np.array(h) @ model.out[:-1] + model.out[-1]
        e = np.exp(z - z.max())
        total += e / e.sum() * len(part)
    total /= len(text)
    assert best[0] == total.argmax() and abs(prob[0] - total.max()) < 1e-5


def test_language_cases(awkward, nothing):
    model = langid.fit(awkward)
    rows = langid.predict(awkward, model).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("de", "en", "fr", "xx") and 0 < r.score <= 1
    assert len({(r.lang_pred, r.score) for r in rows if r.text and r.text.startswith("The cat")}) == 1
    assert langid.fit(nothing) is None
    assert langid.predict(nothing, model).collect() == []
    assert {r.lang_pred for r in langid.predict(awkward, None).collect()} == {"und"}


def test_toxicity_held_out(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = QUERIES["op8_toxicity"](spark, LARGER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    bad, good = [r.score for r in held if toxic[r.doc_id]], [r.score for r in held if not toxic[r.doc_id]]
    assert np.mean([b > g for b in bad for g in good]) > 0.93
    assert np.mean([g < 0.5 for g in good]) > 0.95 and np.mean([b >= 0.5 for b in bad]) > 0.8


def test_misspelling_shares_score():
    clean = ["a calm and quiet day by the river", "the meeting starts at noon", "bread and cheese for lunch"] * 20
    model = toxicity.train([(0, t) for t in clean] + [(1, t + " horrible") for t in clean], epochs=20)
    odds = []
    for _, _, data, off in blocks(pa.array(["the horribble day", "the quiet day"])):
        odds += list(model.log_odds(data, off))
    assert odds[0] > odds[1]


def test_log_odds_equal_mean_over_subwords():
    model = toxicity.train([(0, "good day"), (1, "bad day")] * 4, epochs=3)
    texts = ["Good bad, day!", "", "é ß日本", "a"]
    odds = []
    for _, _, data, off in blocks(pa.array(texts)):
        odds += list(model.log_odds(data, off))
    for t, got in zip(texts, odds):
        seen, share = toxicity._bag(t, model.sizes, model.bits)
        assert abs(got - (model.bias + float((model.weights[seen].astype(float) * share).sum()))) < 1e-5


def test_toxicity_cases(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (5, 0), (8, 0), (8, 1), (None, 1), (9, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(awkward, labels)
    rows = toxicity.predict(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    one_kind = toxicity.fit(awkward, labels.where("toxic = 0"))
    assert {r.predicted for r in toxicity.predict(awkward, one_kind).collect()} == {0}
    assert toxicity.predict(nothing, toxicity.fit(nothing, labels.limit(0))).select(F.col("predicted")).collect() == []


def test_long_text_is_scored_in_pieces(monkeypatch):
    import tracemalloc
    model = toxicity.train([(0, "good day"), (1, "bad day")] * 4, epochs=3)
    rng = np.random.default_rng(2)
    words = ["good", "bad", "day", "über", "horribly", "x" * 700, "a-b", "\n"]
    text = np.frombuffer(" ".join(rng.choice(words, 4000)).encode(), np.uint8)
    off = np.array([0, len(text)])
    whole = model.log_odds(text, off)
    for piece in (1, 5, 64, 1000):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        assert np.concatenate(list(toxicity._pieces(text))).tobytes() == text.tobytes()
        np.testing.assert_allclose(model.log_odds(text, off), whole, rtol=1e-9)
    monkeypatch.undo()
    long = np.tile(text, 30)
    tracemalloc.start()
    model.log_odds(long, np.array([0, len(long)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(long) > 8 * toxicity.PIECE and peak < 10 * len(long)
