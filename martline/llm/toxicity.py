"""Toxicity scores from a subword-bag classifier.

A text is a bag of subwords: the character n-grams of its words, word edges
included.  Each hashed subword has an embedding; the mean of a text's
embeddings goes through a linear softmax.  Embeddings and softmax are trained
together in numpy (AdaGrad) on a bounded sample of labelled texts.  A
misspelling shares most n-grams with the word it distorts, so it gets a score
near that word's.

The softmax is linear in the mean, so for prediction each subword's
contribution to the log odds is one number, looked up for every position of
the text.

Cases: an empty or null text, or one without a letter, scores by the bias
alone.  Without labels of both kinds every score is the share of toxic labels
(0 without any label).  Equal texts get equal scores.  A document with
contradicting labels is learned with each of them.  A very long text is
scored piece by piece, a word of any length at once.  Columns of the input
named like an added column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.blocks import LOWER, U64, blocks, bounded_sample, replace_columns, row_sums, text_arrays

SIZES = (4, 5, 6)
BUCKET_BITS = 18
#: A longer text is scored in pieces of about this many bytes.
PIECE = 1 << 18
#: Bound of the training sample: about this many documents with each label, none longer than MAX_TRAIN_CHARS.
DOCS_PER_LABEL = {0: 3000, 1: 1200}
MAX_TRAIN_CHARS = 20_000

#: Letters are lower-cased ASCII letters and every byte beyond ASCII; all else is a word edge (0).
_LETTER = np.zeros(256, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_LETTER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER = _LETTER[LOWER]


def subwords(data: np.ndarray, off: np.ndarray, sizes: tuple[int, ...] = SIZES, bits: int = BUCKET_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size, the bucket at every position and whether an n-gram starts there.

    An n-gram is ``size`` bytes of one word with its edges; it never crosses
    a word's or a text's end.
    """
    n = len(off) - 1
    # an edge before and after every text, so that n-grams at a text's ends see it
    padded = np.zeros(len(data) + n + 1, np.uint64)
    row = np.repeat(np.arange(n), np.diff(off))
    at = np.arange(len(data)) + row + 1
    padded[at] = _LETTER[data]
    letter = padded != 0
    for size in sizes:
        m = len(padded) - size + 1
        if m <= 0:
            continue
        code = padded[:m].copy()
        valid = letter[1:m + 1].copy()
        for j in range(1, size):
            code |= padded[j:j + m] << U64(8 * j)
            if 1 < j < size - 1:
                valid &= letter[j:j + m]
        bucket = (((code + U64(size)) * U64(0x9E3779B97F4A7C15)) >> U64(64 - bits)).astype(np.int64)
        yield bucket, valid


def text_starts(off: np.ndarray) -> np.ndarray:
    """Offsets of the texts in the padded bytes of ``subwords``."""
    return off + np.arange(len(off))


@dataclass
class SubwordModel:
    """``weights[bucket]``: the subword's share in the log odds; ``bias``: the log odds of an empty text."""

    weights: np.ndarray
    bias: float
    sizes: tuple[int, ...] = SIZES
    bits: int = BUCKET_BITS

    def log_odds(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        if len(off) == 2 and len(data) > PIECE:
            # subwords never cross a word's edge, so a long text is the sum of its pieces between words
            sums = [self._sums(piece, np.array([0, len(piece)])) for piece in _pieces(data)]
            total, count = (np.sum(x, axis=0) for x in zip(*sums))
        else:
            total, count = self._sums(data, off)
        return self.bias + total / np.maximum(count, 1)

    def _sums(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the subwords' shares and their number, of every text."""
        starts = text_starts(off)
        total, count = np.zeros(len(off) - 1), np.zeros(len(off) - 1)
        for bucket, valid in subwords(data, off, self.sizes, self.bits):
            part = np.where(valid, self.weights[bucket], np.float32(0))
            ends = np.minimum(starts, len(part))
            sums = np.concatenate([[0.0], np.cumsum(part, dtype=np.float64)])
            total += sums[ends[1:]] - sums[ends[:-1]]
            count += row_sums(valid, ends)
        return total, count


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of about ``PIECE`` bytes that end after a byte that is no letter (a longer word stays whole)."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and not len(edge := np.flatnonzero(_LETTER[data[end:end + PIECE]] == 0)):
            end += PIECE
        end = end + int(edge[0]) + 1 if end < len(data) else len(data)
        yield data[at:end]
        at = end


def train(samples: list[tuple[int, str]], dim: int = 8, sizes: tuple[int, ...] = SIZES, bits: int = BUCKET_BITS, epochs: int | None = None,
          batch: int = 32, rate: float = 0.5, label_weights: tuple[float, float] = (1.0, 1.0), seed: int = 11) -> SubwordModel:
    """Fit on (label, text) pairs; deterministic.  By default few samples are passed over more often: 40,000 texts in all, 8 to 60 epochs."""
    y = np.array([int(label) for label, _ in samples], dtype=np.int64)
    empty = np.zeros(1 << bits, np.float32)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return SubwordModel(empty, float(np.clip(np.log(share / (1 - share)) if 0 < share < 1 else (np.inf if share else -np.inf), -700, 700)), sizes, bits)
    bags = [_bag(text, sizes, bits) for _, text in samples]
    epochs = epochs or min(60, max(8, -(-40_000 // len(y))))
    rng = np.random.default_rng(seed)
    e = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    w, b = rng.normal(0, 0.5, (dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    ge, gw, gb = np.full(1 << bits, 1e-6, np.float32), np.full_like(w, 1e-6), np.full_like(b, 1e-6)
    weight = np.array(label_weights, np.float32)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            sizes_of = np.array([len(bags[i][0]) for i in part])
            ids = np.concatenate([bags[i][0] for i in part])
            share = np.concatenate([bags[i][1] for i in part])
            seen, local = np.unique(ids, return_inverse=True)
            row = np.repeat(np.arange(len(part)), sizes_of)
            # the batch as a dense (texts x seen subwords) matrix of shares
            x = np.zeros((len(part), len(seen)), np.float32)
            x[row, local] = share
            rows = e[seen]
            h = x @ rows
            z = h @ w + b
            z = np.exp(z - z.max(axis=1, keepdims=True))
            p = z / z.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p *= weight[y[part]][:, None] / len(part)
            grad = x.T @ (p @ w.T)
            dw, db = h.T @ p, p.sum(axis=0)
            ge[seen] += (grad * grad).mean(axis=1)
            e[seen] -= rate * grad / np.sqrt(ge[seen])[:, None]
            gw += dw * dw
            w -= rate * dw / np.sqrt(gw)
            gb += db * db
            b -= rate * db / np.sqrt(gb)
    return SubwordModel((e @ (w[:, 1] - w[:, 0])).astype(np.float32), float(b[1] - b[0]), sizes, bits)


def _bag(text: str, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct subwords of a text and their shares."""
    data, off = text_arrays(pa.array([text or ""]))
    ids = np.concatenate([np.zeros(0, np.int64), *[bucket[valid[:len(bucket)]] for bucket, valid in subwords(data, off, sizes, bits)]])
    seen, count = np.unique(ids, return_counts=True)
    return seen.astype(np.int32), (count / max(1, count.sum())).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", train_on: Column | None = None,
        docs_per_label: dict | int = DOCS_PER_LABEL, max_chars: int = MAX_TRAIN_CHARS, **options) -> SubwordModel:
    """Train on a bounded sample of the labelled documents, about ``docs_per_label`` with each label (so many thousand ids reach the executors by broadcast).

    Of an id with several texts the one with the smallest hash is learned.
    """
    rows = docs if train_on is None else docs.where(train_on)
    known = labels.where(F.col(f"`{label}`").isin(0, 1)).select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"))
    texts = rows.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).where(F.length("text") <= max_chars)
    pairs = _sampled_pairs(texts, known, docs_per_label)
    return train(pairs, **options)


def _sampled_pairs(texts: DataFrame, known: DataFrame, per_label: dict | int) -> list[tuple[int, str]]:
    """The ids are sampled first, from the small label table, so that only the sampled texts are read from the join."""
    picked = bounded_sample(known, F.col("label"), F.col("key"), per_label, max_labels=2, seed="toxicity")
    if not picked:
        return []
    spark = texts.sparkSession
    # some thousand ids: small by construction
    ids = spark.createDataFrame([(int(label), k) for label, k in picked], f"label int, key {dict(known.dtypes)['key']}")
    found = texts.join(F.broadcast(ids), F.col("id") == F.col("key")).groupBy("label", "id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t"))
    rows = found.select("label", "id", F.col("t.text").alias("text")).collect()
    rows.sort(key=lambda r: (r["id"], r["label"]))
    return [(r["label"], r["text"]) for r in rows]


def predict(docs: DataFrame, model: SubwordModel, text: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` plus the probability of label 1 over the whole text, and the label it implies at 0.5."""
    kept = replace_columns(docs, score, predicted)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            odds = np.zeros(len(column))
            for lo, hi, data, off in blocks(column, 1 << 17):
                odds[lo:hi] = model.log_odds(data, off)
            yield pa.array(1 / (1 + np.exp(-np.clip(odds, -700, 700))))

    guess = F.arrow_udf(run, "double", F.ArrowUDFType.SCALAR_ITER)
    return kept.withColumn(score, guess(F.col(f"`{text}`"))).withColumn(predicted, F.when(F.col(f"`{score}`") >= 0.5, 1).otherwise(0))
