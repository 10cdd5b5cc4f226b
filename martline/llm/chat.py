"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole by a template: each turn stands between the
control strings of its role, and control strings inside texts (and the
vocabulary's special tokens) are escaped, which ``unescape`` takes back.  The
rendered text is encoded once, with the character offsets of every token.  The
spans of the assistant's texts and the spans of the tokens are both sorted, so
binary search finds the tokens of each turn; a token that reaches over a
turn's border counts with its part inside, which makes the text under the mask
exactly the assistant's.

Every turn begins with a control string after the line feed that ends the turn
before; the vocabulary's split pattern always cuts there, so the pieces of a
conversation too long for one task (``turns``) are encoded exactly as in the
whole.  Offsets follow from the tokens' lengths in bytes.

Cases: null texts are empty, null roles too; turns come by turn (nulls first),
then role and text; a null id is a conversation of its own; equal rows are
turns each; roles other than system, user and assistant are written out; an
empty table gives no rows.  A task holds one piece: at most ``max_rows`` turns
and ``max_bytes`` of text, or one longer text, about 100 bytes per token of
its tokens.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from martline.llm import bpe, turns

#: Control strings before and after a text, by role.
MARKS = {"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]\n"), "assistant": ("<s>", "</s>\n")}
#: Other roles: their name, then the text.
NAMED = ("[ROLE]", "[/ROLE]", "</s>\n")
CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]")


class Template:
    """Rendering and reading of turns; ``specials`` are the vocabulary's special tokens, escaped like control strings."""

    def __init__(self, specials: Sequence[str] = ()):
        strings = sorted({*CONTROLS, *specials}, key=len, reverse=True)
        self._unsafe = re.compile("|".join(["\\\\", *map(re.escape, strings)]))
        opening = "|".join(re.escape(m[0]) for m in MARKS.values())
        self._opening = re.compile(f"({opening}|{re.escape(NAMED[0])})")
        self._role = {m[0]: role for role, m in MARKS.items()}

    def escape(self, text: str) -> str:
        """``text`` with a backslash after the first character of every control string, and backslashes doubled."""
        return self._unsafe.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def render(self, rows: Sequence[tuple[str | None, str | None]]) -> tuple[str, list[tuple[str, int, int]]]:
        """The formatted text of (role, text) rows and each turn's (role, start, end) in it."""
        out, spans, at = [], [], 0
        for role, text in rows:
            before, after = MARKS.get(role) or (NAMED[0] + self.escape(role or "") + NAMED[1], NAMED[2])
            body = self.escape(text or "")
            start = at + len(before)
            spans.append((role or "", start, start + len(body)))
            out += (before, body, after)
            at = start + len(body) + len(after)
        return "".join(out), spans

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The (role, text) turns of a formatted text."""
        found, at = [], 0
        while at < len(formatted):
            opening = self._opening.match(formatted, at)
            if opening is None:
                raise ValueError(f"no turn begins at {at}")
            start = opening.end()
            if role := self._role.get(opening[0]):
                after = MARKS[role][1]
            else:
                end = formatted.index(NAMED[1], start)
                role, start, after = self.unescape(formatted[start:end]), end + len(NAMED[1]), NAMED[2]
            end = formatted.index(after, start)
            found.append((role, self.unescape(formatted[start:end])))
            at = end + len(after)
        return found


def special_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens", [])]


@functools.lru_cache(maxsize=2)
def _tools(path: str) -> tuple[bpe.ByteBPE, np.ndarray, Template]:
    """Encoder, bytes of each token, template."""
    encoder = bpe.load(path)
    return encoder, np.array([len(t) for t in encoder.tokens], dtype=np.int64), Template(special_tokens(path))


def encode(encoder: bpe.ByteBPE, lengths: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, starts and ends (code points) of the tokens of ``text``; a token of some bytes of a character has the character's span."""
    ids = np.array(encoder.encode_tree(text), dtype=np.int32)
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    if not text.isascii():
        place = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1
        starts, ends = place[starts], place[ends - 1] + 1
    return ids, starts, ends


def intersect(starts: np.ndarray, ends: np.ndarray, spans: Sequence[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens meet ``spans``, and the parts of the text that tokens and spans share, as sorted disjoint intervals.

    Tokens and spans are sorted; characters of several bytes may be covered by
    several tokens with equal offsets.
    """
    mask = np.zeros(len(starts), dtype=bool)
    shared: list[tuple[int, int]] = []
    if not spans or not len(starts):
        return mask, shared
    bounds = np.array(spans, dtype=np.int64)
    first = np.searchsorted(ends, bounds[:, 0], side="right")
    past = np.searchsorted(starts, bounds[:, 1], side="left")
    for (lo, hi), i, j in zip(spans, first, past):
        if hi <= lo or j <= i:
            continue
        mask[i:j] = True
        a, b = np.maximum(starts[i:j], lo), np.minimum(ends[i:j], hi)
        tops = np.maximum.accumulate(b)
        # a gap begins where a token starts after all before it have ended
        breaks = np.flatnonzero(a[1:] > tops[:-1]) + 1
        shared += [(int(a[x]), int(tops[y - 1])) for x, y in zip([0, *breaks], [*breaks, len(a)])]
    return mask, shared


_FIELDS = [("part", T.IntegerType()), ("piece", T.IntegerType()), ("n_turns", T.LongType()), ("formatted", T.StringType()),
           ("ids", T.ArrayType(T.IntegerType())), ("token_starts", T.ArrayType(T.IntegerType())), ("token_ends", T.ArrayType(T.IntegerType())),
           ("loss_mask", T.ArrayType(T.BooleanType())),
           ("loss_spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))]


def format_conversations(rows: DataFrame, path: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         learn: Sequence[str] = ("assistant",), max_rows: int = turns.MAX_ROWS, max_bytes: int = turns.MAX_BYTES) -> DataFrame:
    """One row per conversation (``whole``), or per piece of a long one in order of (``part``, ``piece``).

    Columns: the id, part, piece, n_turns, ``formatted``, the ids and offsets
    of its tokens (code points of ``formatted``), ``loss_mask`` (tokens that
    meet a text of the roles ``learn``), ``loss_spans`` (the text under it).
    """
    picked = rows.select(F.col(f"`{conv}`").alias("c"), F.col(f"`{turn}`").alias("t"), F.col(f"`{role}`").alias("r"), F.col(f"`{text}`").alias("x"))
    ordinary, long = turns.deal(picked, "c", ["t", "r", "x"], "x", max_rows, max_bytes)
    schema = T.StructType([T.StructField("c", picked.schema["c"].dataType), *[T.StructField(n, t) for n, t in _FIELDS]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch], cut: bool) -> Iterator[pa.RecordBatch]:
        encoder, lengths, template = _tools(path)
        held, size = [], 0
        for part, piece, found in turns.runs(batches, 3, *((max_rows, max_bytes) if cut else (None, None))):
            formatted, spans = template.render([(r[2], r[3]) for r in found])
            ids, starts, ends = encode(encoder, lengths, formatted)
            mask, shared = intersect(starts, ends, [(lo, hi) for name, lo, hi in spans if name in learn])
            held.append((found[0][0], part, piece, len(found), formatted, ids, starts.astype(np.int32), ends.astype(np.int32), mask,
                         [{"start": lo, "end": hi} for lo, hi in shared]))
            size += len(formatted)
            if size > 1 << 20:
                yield _batch(held, arrow)
                held, size = [], 0
        if held:
            yield _batch(held, arrow)

    done = ordinary.mapInArrow(lambda it: run(it, False), schema).withColumn("whole", F.lit(True))
    if long is not None:
        done = done.unionByName(long.mapInArrow(lambda it: run(it, True), schema).withColumn("whole", F.lit(False)))
    return done.withColumnRenamed("c", conv)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_back(formatted: DataFrame, path: str, conv: str = "conv_id") -> DataFrame:
    """Digests of the conversations as read from their formatted texts and loss spans alone.

    Per conversation: n_turns, turns_sha256 (role, line feed, text, line feed
    of each turn), loss_chars, loss_sha256 (the unescaped text under the mask)
    and formatted_chars.  Whole conversations are digested where they lie; the
    pieces of a long one are dealt by id and streamed in order.
    """
    schema = T.StructType([T.StructField("c", formatted.schema[conv].dataType), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = _tools(path)[2]
        state = None
        for batch in batches:
            out = []
            for c, text, spans in zip(*[batch.column(n).to_pylist() for n in ("c", "formatted", "loss_spans")]):
                if state is None or state[0] != c:
                    if state is not None:
                        out.append(_ended(state))
                    state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in template.read(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = template.unescape(text[span["start"]:span["end"]])
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            if out:
                yield _batch(out, arrow)
        if state is not None:
            yield _batch([_ended(state)], arrow)

    narrow = formatted.select(F.col(f"`{conv}`").alias("c"), "whole", "part", "piece", "formatted", "loss_spans")
    whole = narrow.where("whole").mapInArrow(run, schema)
    pieces = narrow.where("NOT whole").repartition("c").sortWithinPartitions("c", "part", "piece").mapInArrow(run, schema)
    return whole.unionByName(pieces).withColumnRenamed("c", conv)


def _ended(state: list) -> tuple:
    c, n, told, chars, learned, length = state
    return c, n, told.hexdigest(), chars, learned.hexdigest(), length
