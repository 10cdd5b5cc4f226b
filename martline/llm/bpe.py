"""BPE encoding and decoding with a published byte-level vocabulary.

Texts are encoded exactly as the vocabulary's library does: special-token
strings become their ids, the rest is split by the vocabulary's pattern into
pieces, and each piece is merged by rank.

Long text is encoded by tree concatenation.  It is cut into leaves that are
encoded in parallel, as rows of their own, and joined pairwise up a binary
tree.  At each join, a window of tokens on both sides is decoded and encoded
again; it grows until its first tokens are again those of the left half and
its last tokens those of the right half.  From there on both halves stand as
they are: every neighbouring pair of tokens occurs in an encoding, which is
what makes a token sequence the encoding of its text.

Cases: a null text is empty and has no tokens; texts are independent of each
other, so repeated rows get equal ids.  Columns of the input named like an
added column are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.blocks import replace_columns, unused
from martline.session import ensure_checkpoint_dir

#: The split pattern of byte-level BPE vocabularies (a fixed value of the file format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts over this many code points are cut into leaves of this size.
LEAF_CHARS = 32_768
#: Tokens that must agree on each side of a window, and the first window's size.
GUARD = 4
WINDOW = 16


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteBPE:
    """Encoder and decoder over one vocabulary file (``tokenizers`` JSON, byte-level BPE without normaliser)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if model["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"special tokens with options are not supported: {path}")
        ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merges]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            raise ValueError(f"ids do not follow the order of merges: {path}")
        self.special = special
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        size = max([*ranks.values(), *special.values()]) + 1
        tokens = [b""] * size
        for token, i in (*ranks.items(), *((t.encode(), i) for t, i in special.items())):
            tokens[i] = token
        self.tokens = tokens

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special="all")

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenation of the texts of two encodings."""
        if not left or not right:
            return left + right
        size = WINDOW
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            head, tail = left[a:], right[:b]
            new = self._encode_window(head, tail)
            if new is not None:
                ends = (a == 0 or new[:GUARD] == head[:GUARD]) and (b == len(right) or new[-GUARD:] == tail[-GUARD:])
                if ends and len(new) >= 2 * GUARD or (a == 0 and b == len(right)):
                    return left[:a] + new + right[b:]
            elif a == 0 and b == len(right):
                raise ValueError("the halves do not join to valid UTF-8")
            size *= 2

    def _encode_window(self, head: list[int], tail: list[int]) -> list[int] | None:
        try:
            return self.encode((self.decode_bytes(head) + self.decode_bytes(tail)).decode("utf-8"))
        except UnicodeDecodeError:
            return None  # the window cuts a character: grow it

    def join_all(self, parts: list[list[int]]) -> list[int]:
        """Join neighbours pairwise until one is left."""
        while len(parts) > 1:
            parts = [self.join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def encode_tree(self, text: str, leaf_chars: int = LEAF_CHARS) -> list[int]:
        """As ``encode``, by tree concatenation over leaves of the text."""
        return self.join_all([self.encode(t) for t in leaves(text, leaf_chars)])


def leaves(text: str, leaf_chars: int) -> list[str]:
    """The text cut at every ``leaf_chars`` code points."""
    return [text[i:i + leaf_chars] for i in range(0, len(text), leaf_chars)] if text else []


@functools.lru_cache(maxsize=4)
def load(path: str) -> ByteBPE:
    """One encoder per worker and vocabulary."""
    return ByteBPE(path)


def ids_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.array(ids, dtype="<u4").tobytes()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", long_chars: int = 1 << 20, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` plus the token ids (array of int).

    Texts of up to ``long_chars`` code points are encoded where they are (by
    the tree over their leaves if they have several).  The leaves of longer
    ones are encoded as rows of their own, over all executors, and joined
    again by a group per text.
    """
    kept = replace_columns(docs, ids)
    t = F.col(f"`{text}`")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for column in batches:
            yield pa.array([bpe.encode_tree(x, leaf_chars) if x and len(x) <= long_chars else [] for x in column.to_pylist()], pa.list_(pa.int32()))

    short = kept.withColumn(ids, F.arrow_udf(run, "array<int>", F.ArrowUDFType.SCALAR_ITER)(t))
    if not kept.where(F.length(t) > long_chars).head(1):
        return short
    far = long_ids(kept.where(F.length(t) > long_chars).select(t.alias("text")), path, leaf_chars)
    mark, of, found = unused("mark", short), unused("of", short), unused("far", short)
    marked = short.withColumn(mark, F.when(F.length(t) > long_chars, F.sha2(t, 256)))
    joined = marked.join(far.toDF(of, found), F.col(mark) == F.col(of), "left")
    return joined.select(*[F.col(f"`{c}`") for c in kept.columns], F.coalesce(F.col(found), F.col(f"`{ids}`")).alias(ids))


def long_ids(texts: DataFrame, path: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """(``of``, ``far``): the mark (SHA-256) and the ids of each distinct text, its leaves encoded in parallel."""
    ensure_checkpoint_dir(texts.sparkSession)
    cuts = F.expr(f"transform(sequence(0, cast((length(text) - 1) / {leaf_chars} AS int)), i -> substring(text, i * {leaf_chars} + 1, {leaf_chars}))")
    cut = texts.select(F.sha2("text", 256).alias("mark"), F.posexplode(cuts).alias("at", "leaf")).dropDuplicates(["mark", "at"]).repartition("mark", "at")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for column in batches:
            yield pa.array([bpe.encode(x) for x in column.to_pylist()], pa.list_(pa.int32()))

    encoded = cut.select("mark", "at", F.arrow_udf(run, "array<int>", F.ArrowUDFType.SCALAR_ITER)("leaf").alias("ids"))

    def join(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for column in batches:
            yield pa.array([bpe.join_all([p["ids"] for p in sorted(parts, key=lambda p: p["at"])]) for parts in column.to_pylist()], pa.list_(pa.int32()))

    parts = encoded.groupBy("mark").agg(F.collect_list(F.struct("at", "ids")).alias("parts"))
    return parts.select(F.col("mark").alias("of"), F.arrow_udf(join, "array<int>", F.ArrowUDFType.SCALAR_ITER)("parts").alias("far"))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` plus the decoded text; a null list decodes to the empty text."""
    kept = replace_columns(docs, text)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for column in batches:
            yield pa.array([bpe.decode(x or []) for x in column.to_pylist()], pa.string())

    return kept.withColumn(text, F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{ids}`")))


def round_trip(docs: DataFrame, path: str, text: str = "text", long_chars: int = 1 << 20, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` plus n_tokens, ids_sha256 and decoded_sha256 (of the decoded text), without carrying the ids along.

    Texts of up to ``long_chars`` are encoded, decoded and hashed in one pass;
    longer ones take the way of ``encode``.
    """
    fields = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = replace_columns(docs, *fields)
    t = F.col(f"`{text}`")
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def digest(bpe: ByteBPE, rows: list[list[int]]) -> pa.Array:
        raw = [bpe.decode_bytes(r) for r in rows]
        return pa.StructArray.from_arrays([
            pa.array([len(r) for r in rows], pa.int64()), pa.array([hashlib.sha256(ids_bytes(r)).hexdigest() for r in rows], pa.string()),
            pa.array([hashlib.sha256(x.decode("utf-8", errors="replace").encode()).hexdigest() for x in raw], pa.string())], fields)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for column in batches:
            out = []
            for lo in range(0, len(column), 200):
                out.append(digest(bpe, [bpe.encode_tree(x, leaf_chars) if x and len(x) <= long_chars else [] for x in column.slice(lo, 200).to_pylist()]))
            yield pa.concat_arrays(out) if out else digest(bpe, [])

    def run_far(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for column in batches:
            yield digest(bpe, column.to_pylist())

    near, mark, of, found = (unused(n, kept) for n in ("near", "mark", "of", "far"))
    done = kept.withColumn(near, F.arrow_udf(run, schema, F.ArrowUDFType.SCALAR_ITER)(t))
    columns = [F.col(f"`{c}`") for c in kept.columns]
    out = F.col(near)
    if kept.where(F.length(t) > long_chars).head(1):
        far = long_ids(kept.where(F.length(t) > long_chars).select(t.alias("text")), path, leaf_chars)
        far = far.select("of", F.arrow_udf(run_far, schema, F.ArrowUDFType.SCALAR_ITER)("far").alias("far")).toDF(of, found)
        done = done.withColumn(mark, F.when(F.length(t) > long_chars, F.sha2(t, 256))).join(far, F.col(mark) == F.col(of), "left")
        out = F.coalesce(F.col(found), F.col(near))
    return done.select(*columns, *[out[f].alias(f) for f in fields])
