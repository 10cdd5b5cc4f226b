"""Quality rules as a short-circuit cascade.

A rule is a vectorised test over the features of texts, with the features it
needs.  Features have costs; a rule's cost is that of its features.  On a
bounded hash sample the cost and the rejection rate of every rule are
estimated, and the rules are ordered by rejections per cost.  Over the whole
table, the first rule tests all texts and each further one only those that
passed so far, so expensive features are computed for few texts.  The verdict
is the conjunction of all rules, hence the same in any order.

Cases: a null text has no words.  Rows are judged one by one, so repeated
rows get equal verdicts.  On an empty sample rules keep their given order.
A very long text is judged whole, in about 27 bytes for each of its own.
Columns of the input named like an added column are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.blocks import SPACE, SpanHasher, U64, blocks, break_spans, hash_share, replace_columns, row_sums, unused, word_spans

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_ALPHA = np.zeros(256, dtype=bool)
_ALPHA[0x80:] = True
_ALPHA[ord("A"):ord("Z") + 1] = _ALPHA[ord("a"):ord("z") + 1] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0"):ord("9") + 1] = True


class Texts:
    """Features of the texts of a block, each computed when first asked for."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off, self._known = data, off, {}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self._known:
            self._known[name] = getattr(self, "_" + name)()
        return self._known[name]

    def _words(self):
        return word_spans(self.data, self.off)

    def _hasher(self):
        return SpanHasher(self.data)

    def _word_rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), self["n_words"])

    def _n_words(self) -> np.ndarray:
        return self["words"][2]

    def _word_chars(self) -> np.ndarray:
        return row_sums(((self.data & 0xC0) != 0x80) & ~SPACE[self.data], self.off)

    def _n_symbols(self) -> np.ndarray:
        return row_sums(SYMBOLS[self.data], self.off)

    def _n_upper(self) -> np.ndarray:
        return row_sums(_UPPER[self.data], self.off)

    def _n_alpha(self) -> np.ndarray:
        return row_sums(_ALPHA[self.data], self.off)

    def _n_digits(self) -> np.ndarray:
        return row_sums(_DIGIT[self.data], self.off)

    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows and hashes of the lines that have a word, in order."""
        starts, ends, counts = break_spans(self.data != 0x0A, self.off)
        row = np.repeat(np.arange(len(self.off) - 1), counts)
        wordy = np.concatenate([[0], np.cumsum(~SPACE[self.data])])
        kept = wordy[ends] > wordy[starts]
        return row[kept], self["hasher"](starts[kept], ends[kept])

    def _n_lines(self) -> np.ndarray:
        return np.bincount(self["lines"][0], minlength=len(self.off) - 1)

    def _n_dup_lines(self) -> np.ndarray:
        row, h = self["lines"]
        return self["n_lines"] - _distinct_per_row(row, h, len(self.off) - 1)

    def _word_hashes(self) -> np.ndarray:
        starts, ends, _ = self["words"]
        return self["hasher"](starts, ends)

    def _n_distinct_words(self) -> np.ndarray:
        return _distinct_per_row(self["word_rows"], self["word_hashes"], len(self.off) - 1)

    def _n_repeat_words(self) -> np.ndarray:
        """Words in a 3-word window that occurs twice or more in the text, the first included."""
        h, row, n = self["word_hashes"], self["word_rows"], len(self.off) - 1
        if len(h) < 3:
            return np.zeros(n, np.int64)
        whole = np.flatnonzero(row[2:] == row[:-2])
        window = (h[whole] * U64(0xD6E8FEB86659FD93)) ^ _rotate(h[whole + 1] * U64(0x9E3779B97F4A7C15), 21) ^ _rotate(h[whole + 2] * U64(0xA0761D6478BD642F), 43)
        key = (window ^ _rotate(window, 29)) * U64(0xE7037ED1A0B428DB) + row[whole].astype(U64) * U64(0x8EBC6AF09C88C6E3)
        order = np.argsort(key)
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        again = np.zeros(len(whole), dtype=bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        marked = np.zeros(len(h), dtype=bool)
        at = whole[again]
        for j in range(3):
            marked[at + j] = True
        return np.bincount(row[marked], minlength=n)


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U64(by)) | (x >> U64(64 - by))


def _distinct_per_row(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    key = h + row.astype(U64) * U64(0x8EBC6AF09C88C6E3)
    order = np.argsort(key)
    if not len(order):
        return np.zeros(n, np.int64)
    ranked = key[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    return np.bincount(row[order[first]], minlength=n)


@dataclass(frozen=True)
class Rule:
    """``fails(texts)`` is true for the texts to reject."""

    name: str
    fails: Callable[[Texts], np.ndarray]


def _share(part: str, whole: str, most: float) -> Callable[[Texts], np.ndarray]:
    return lambda t: t[part] > most * np.maximum(t[whole], 1)


def default_rules() -> list[Rule]:
    """Rules against symbol noise, shouting, numbers, odd words, repeated lines and poor vocabulary."""
    return [
        Rule("poor_vocabulary", lambda t: (t["n_words"] >= 50) & (t["n_distinct_words"] < 0.1 * t["n_words"] ** 0.9)),
        Rule("duplicate_lines", _share("n_dup_lines", "n_lines", 0.5)),
        Rule("word_length", lambda t: (t["word_chars"] < 2 * t["n_words"]) | (t["word_chars"] > 15 * t["n_words"])),
        Rule("symbols", _share("n_symbols", "n_words", 0.25)),
        Rule("shouting", _share("n_upper", "n_alpha", 0.5)),
        Rule("digits", _share("n_digits", "word_chars", 0.3)),
        Rule("letters", lambda t: 2 * t["n_alpha"] < t["word_chars"]),
    ]


def measure_rules(texts: Sequence[str], rules: Sequence[Rule], rounds: int = 3, known: Sequence[str] = ()) -> list[tuple[str, float, float]]:
    """(name, seconds per text, share rejected) of every rule on a sample; features other than the ``known`` ones are computed afresh."""
    found = []
    parts = [(data, off) for _, _, data, off in blocks(pa.array(list(texts), pa.string()))]
    n = max(1, len(texts))
    for rule in rules:
        seconds, rejected = [], 0
        for _ in range(rounds):
            texts_of = [Texts(*p) for p in parts]
            for t in texts_of:
                for name in known:
                    t[name]
            began = time.perf_counter()
            rejected = sum(int(np.count_nonzero(rule.fails(t))) for t in texts_of)
            seconds.append(time.perf_counter() - began)
        found.append((rule.name, max(min(seconds), 1e-9) / n, rejected / n))
    return found


def order_rules(rules: Sequence[Rule], measured: Sequence[tuple[str, float, float]]) -> list[Rule]:
    """By rejections per cost, highest first; among equals the cheaper, then the given order."""
    rate = {name: (-rejected / cost, cost) for name, cost, rejected in measured}
    return sorted(rules, key=lambda r: rate.get(r.name, (0.0, 0.0)))


def plan_cascade(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", key: str = "doc_id", sample_rows: int = 300,
                 max_chars: int = 20_000) -> list[Rule]:
    """Order the rules by a hash sample of about ``sample_rows`` rows; only the order depends on it, no verdict.

    What the base counts of ``quality_report`` have computed costs a rule nothing.
    """
    rules = list(default_rules() if rules is None else rules)
    n = docs.count()
    share = min(1.0, 1.2 * sample_rows / max(n, 1))
    rows = docs.where(hash_share("quality", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))) < share)
    texts = sorted(r[0] or "" for r in rows.select(F.substring(F.col(f"`{text}`"), 1, max_chars)).limit(4 * sample_rows).collect())
    return order_rules(rules, measure_rules(texts, rules, known=BASE)) if texts else rules


def first_failure(texts: Texts, rules: Sequence[Rule]) -> np.ndarray:
    """Index of the first rule that rejects each text, -1 if none does; each rule sees only what passed so far."""
    verdict, at = np.full(len(texts.off) - 1, -1, np.int64), np.arange(len(texts.off) - 1)
    for i, rule in enumerate(rules):
        if not len(at):
            break
        failed = rule.fails(texts)
        verdict[at[failed]] = i
        if failed.any():
            at, texts = at[~failed], _narrow(texts, ~failed)
    return verdict


def _narrow(texts: Texts, kept: np.ndarray) -> Texts:
    """The texts that are kept, with their per-row features known so far."""
    lengths = np.diff(texts.off)
    out = Texts(texts.data[np.repeat(kept, lengths)], np.concatenate([[0], np.cumsum(lengths[kept])]))
    out._known = {k: v[kept] for k, v in texts._known.items() if k.startswith("n_") or k == "word_chars"}
    return out


def apply_cascade(docs: DataFrame, rules: Sequence[Rule], text: str = "text", kept: str = "kept", failed_rule: str = "failed_rule") -> DataFrame:
    """``docs`` plus whether all rules pass and the first rule that fails (null if none)."""
    rest = replace_columns(docs, kept, failed_rule)
    names = np.array([*[r.name for r in rules], None], dtype=object)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            verdict = np.zeros(len(column), np.int64)
            for lo, hi, data, off in blocks(column):
                verdict[lo:hi] = first_failure(Texts(data, off), rules)
            yield pa.array(names[verdict], pa.string())

    judged = rest.withColumn(failed_rule, F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`")))
    return judged.withColumn(kept, F.col(f"`{failed_rule}`").isNull())


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality_report(docs: DataFrame, rules: Sequence[Rule], text: str = "text", min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """``docs`` plus base counts, the base verdict and the cascade's verdict.

    The base rules (``min_words``, share of words in repeated 3-word windows)
    come first; the cascade runs only on texts that pass them.
    """
    rest = replace_columns(docs, *BASE, "base_failed", "kept", "failed_rule")
    names = np.array([*[r.name for r in rules], None, None], dtype=object)
    fields = [*[pa.field(c, pa.int64()) for c in BASE], pa.field("base_failed", pa.bool_()), pa.field("failed_rule", pa.string())]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            counts = np.zeros((len(BASE), len(column)), np.int64)
            failed, verdict = np.zeros(len(column), dtype=bool), np.zeros(len(column), np.int64)
            for lo, hi, data, off in blocks(column):
                t = Texts(data, off)
                for i, name in enumerate(BASE):
                    counts[i, lo:hi] = t[name]
                failed[lo:hi] = (t["n_words"] < min_words) | (100 * t["n_repeat_words"] > max_repeat_percent * t["n_words"])
                alive = ~failed[lo:hi]
                left = _narrow(t, alive)
                v = np.full(hi - lo, -2, np.int64)
                v[alive] = first_failure(left, rules)
                verdict[lo:hi] = v
            yield pa.StructArray.from_arrays([*[pa.array(c) for c in counts], pa.array(failed), pa.array(names[verdict], pa.string())], fields=fields)

    schema = ", ".join([*[f"{c} bigint" for c in BASE], "base_failed boolean", "failed_rule string"])
    out = unused("out", rest)
    judged = rest.withColumn(out, F.arrow_udf(run, schema, F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`")))
    return judged.select(*[F.col(f"`{c}`") for c in rest.columns], *[F.col(out)[c].alias(c) for c in [*BASE, "base_failed", "failed_rule"]],
                         (~F.col(out).base_failed & F.col(out).failed_rule.isNull()).alias("kept"))
