"""Language identification with a byte convolutional network.

Filters of several widths slide over the bytes of fixed-length windows; the
maximum of each filter over the window, rectified, feeds a softmax.  The
network is trained in numpy on a bounded sample of labelled texts.  A
document's distribution is the mean of its windows' distributions weighted
by their length, so a whole text of any length is read in bounded memory.

The input of a filter is a one-hot byte class, so a filter of width ``w`` is
``w`` tables of ``classes x filters`` weights and its response a sum of table
rows.  For prediction, the tables of neighbouring positions are added up in
advance into tables over byte pairs.

Cases: a null text or one without any letter (``\\p{L}``) is ``und`` with
score 0.  At most ``max_languages`` languages, the most frequent ones, are
learned; texts of others get one of these.  A very long text takes about 40
bytes per window of 256 beyond its own bytes.  Without any labelled row every text is ``und``.  Equal texts get
equal predictions.  Ties go to the language that comes first by name.
Columns of the input named like an added column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.blocks import LOWER, blocks, bounded_sample, replace_columns, unused

UNDETERMINED = "und"
WIDTHS = (2, 3, 4)
WINDOW = 256
#: Bound of the training sample: about this many documents of a language, each with so many windows at most.
DOCS_PER_LANGUAGE = 800
WINDOWS_PER_DOC = 3
MAX_LANGUAGES = 256


@dataclass
class ByteCNN:
    """``tables[width]`` has shape (width, classes, filters); ``out`` maps pooled filters (and a constant) to languages."""

    languages: list[str]
    byte_class: np.ndarray
    tables: dict[int, np.ndarray]
    out: np.ndarray
    window: int = WINDOW
    _pairs: dict = field(default_factory=dict, repr=False)

    @property
    def classes(self) -> int:
        return next(iter(self.tables.values())).shape[1]

    def _pair(self, width: int, at: int) -> np.ndarray:
        if (width, at) not in self._pairs:
            t = self.tables[width]
            self._pairs[width, at] = (t[at][:, None, :] + t[at + 1][None, :, :]).reshape(-1, t.shape[2])
        return self._pairs[width, at]

    def __getstate__(self):
        return {**self.__dict__, "_pairs": {}}

    def responses(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """Filter responses, (window, texts, filters) for each width; ``codes`` is (window + max width - 1, texts)."""
        length = self.window
        pairs = codes[:-1].astype(np.int64) * self.classes + codes[1:]
        found = {}
        for width in self.tables:
            r = self._pair(width, 0).take(pairs[:length], axis=0)
            for at in range(2, width - 1, 2):
                r += self._pair(width, at).take(pairs[at:at + length], axis=0)
            if width % 2:
                r += self.tables[width][width - 1].take(codes[width - 1:width - 1 + length], axis=0)
            found[width] = r
        return found

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        pooled = [np.maximum.reduce(r, axis=0) for r in self.responses(codes).values()]
        h = np.maximum(np.concatenate(pooled, axis=1), 0)
        z = h @ self.out[:-1] + self.out[-1]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def window_places(off: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text of each window, its first byte and its length."""
    lengths = np.diff(off)
    n_windows = -(-lengths // window)
    row = np.repeat(np.arange(len(lengths)), n_windows)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)) * window
    return row, off[:-1][row] + start, np.minimum(window, lengths[row] - start)


def window_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray, byte_class: np.ndarray, length: int) -> np.ndarray:
    """Byte classes of ``length`` bytes from each start as columns (zero from ``end``, a text's end, on)."""
    at = start[None, :] + np.arange(length)[:, None]
    inside = at < end[None, :]
    codes = byte_class[data[np.where(inside, at, 0)]]
    codes[~inside] = 0
    return codes


def train(samples: list[tuple[str, bytes]], widths: tuple[int, ...] = WIDTHS, filters: int = 16, max_classes: int = 96,
          window: int = WINDOW, epochs: int = 8, batch: int = 64, rate: float = 0.02, seed: int = 7) -> ByteCNN | None:
    """Fit the network on (language, bytes of one window) pairs with Adam; deterministic."""
    if not samples:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in samples})
    y = np.array([languages.index(lang) for lang, _ in samples])
    data = LOWER[np.frombuffer(b"".join(s for _, s in samples), np.uint8)]
    off = np.concatenate([[0], np.cumsum([len(s) for _, s in samples])]).astype(np.int64)
    # the most frequent bytes get a class each, the rest share class 1; class 0 is padding
    counts = np.bincount(data, minlength=256)
    byte_class = np.ones(256, np.uint8)
    common = [b for b in np.argsort(-counts, kind="stable")[:max_classes - 2] if counts[b]]
    byte_class[common] = np.arange(2, 2 + len(common))
    byte_class = byte_class[LOWER]
    classes, widest = max_classes, max(widths)
    row, start, _ = window_places(off, window)
    codes = window_codes(data, start, off[1:][row], byte_class, window + widest - 1)
    y = y[row]
    k, n_out = filters, len(languages)
    net = ByteCNN(languages, byte_class,
                  {w: rng.normal(0, 0.3, (w, classes, k)).astype(np.float32) for w in widths},
                  np.concatenate([rng.normal(0, 0.3, (k * len(widths), n_out)), np.zeros((1, n_out))]).astype(np.float32), window)
    params = [*net.tables.values(), net.out]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = len(y) / (n_out * np.maximum(np.bincount(y, minlength=n_out), 1))
    step = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            c, t = codes[:, part], y[part]
            net._pairs.clear()
            found = net.responses(c)
            best = {w: r.argmax(axis=0) for w, r in found.items()}
            pooled = [np.take_along_axis(r, best[w][None], axis=0)[0] for w, r in found.items()]
            raw = np.concatenate(pooled, axis=1)
            h = np.maximum(raw, 0)
            z = h @ net.out[:-1] + net.out[-1]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            p = z / z.sum(axis=1, keepdims=True)
            p[np.arange(len(t)), t] -= 1
            p *= (weight[t] / len(t))[:, None]
            p = p.astype(np.float32)
            grads = []
            dh = (p @ net.out[:-1].T) * (raw > 0)
            for i, w in enumerate(widths):
                g = np.zeros_like(net.tables[w])
                d, where = dh[:, i * k:(i + 1) * k], best[w]
                for j in range(w):
                    byte = c[where + j, np.arange(len(t))[:, None]]
                    np.add.at(g[j], (byte, np.arange(k)[None, :]), d)
                grads.append(g)
            grads.append(np.concatenate([h.T @ p, p.sum(axis=0, keepdims=True)]) + 1e-4 * net.out)
            step += 1
            for q, g, a, b in zip(params, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                q -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    net._pairs.clear()
    return net


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", train_on: Column | None = None,
        docs_per_language: int = DOCS_PER_LANGUAGE, windows_per_doc: int = WINDOWS_PER_DOC, max_languages: int = MAX_LANGUAGES, **options) -> ByteCNN | None:
    """Train on a bounded sample: about ``docs_per_language`` distinct texts of every language, ``windows_per_doc`` windows each.

    ``train_on`` says which rows may be learned from (default: all).  Windows
    are cut on the executors at even distances, so only these bytes reach the
    driver.  The ``max_languages`` most frequent languages are learned.
    """
    rows = docs if train_on is None else docs.where(train_on)
    t, n = F.col(f"`{text}`"), F.length(F.col(f"`{text}`"))
    cuts = F.array(*[F.substring(t, (n * i / windows_per_doc).cast("int") + 1, F.lit(WINDOW)) for i in range(windows_per_doc)])
    kept = F.when(n > WINDOW, F.array_distinct(cuts)).otherwise(F.array(t))
    picked = bounded_sample(rows.where(t.rlike(r"\p{L}")), F.col(f"`{lang}`"), kept, docs_per_language, max_languages, seed="langid")
    samples = [(label, w.encode()[:WINDOW]) for label, ws in picked for w in ws if w]
    return train(samples, **options)


def predict(docs: DataFrame, model: ByteCNN | None, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` plus the predicted language and its probability; every byte of every text is read."""
    kept = replace_columns(docs, pred, score)
    t = F.col(f"`{text}`")
    if model is None:
        return kept.select("*", F.lit(UNDETERMINED).alias(pred), F.lit(0.0).alias(score))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            best, prob = np.zeros(len(column), np.int64), np.zeros(len(column))
            for lo, hi, data, off in blocks(column, 1 << 16):
                best[lo:hi], prob[lo:hi] = classify(model, data, off)
            yield pa.StructArray.from_arrays([pa.array(np.array(model.languages, dtype=object)[best], pa.string()), pa.array(prob)], ["pred", "score"])

    guess = F.arrow_udf(run, "pred string, score double", F.ArrowUDFType.SCALAR_ITER)
    has_letter = F.coalesce(t.rlike(r"\p{L}"), F.lit(False))
    letter, out = unused("letter", kept), unused("out", kept)
    scored = kept.withColumn(letter, has_letter).withColumn(out, guess(t))
    return scored.select(*[F.col(f"`{c}`") for c in kept.columns],
                         F.when(F.col(letter), F.col(out).pred).otherwise(UNDETERMINED).alias(pred),
                         F.when(F.col(letter), F.col(out).score).otherwise(0.0).alias(score))


def classify(model: ByteCNN, data: np.ndarray, off: np.ndarray, windows_at_once: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Language index and probability of every text of a block."""
    n = len(off) - 1
    if not len(data):
        return np.zeros(n, np.int64), np.zeros(n)
    row, start, used = window_places(off, model.window)
    total = np.zeros((n, len(model.languages)))
    for lo in range(0, len(row), windows_at_once):
        part = slice(lo, lo + windows_at_once)
        codes = window_codes(data, start[part], off[1:][row[part]], model.byte_class, model.window + max(model.tables) - 1)
        np.add.at(total, row[part], model.probabilities(codes) * used[part, None])
    total /= np.maximum(np.diff(off), 1)[:, None]
    best = total.argmax(axis=1)
    return best, np.minimum(1.0, total[np.arange(n), best])
