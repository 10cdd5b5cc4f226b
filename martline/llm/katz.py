"""Language-model scores by a Katz backoff bigram model.

Tokens are the words of a text in lower case, then one end.  A bigram seen
``r`` times after its context has probability ``d(r) * r / c(context)``, with
Good-Turing discounts ``d`` for small ``r``; an unseen one backs off to the
unigram probability times the context's weight, which is chosen so that the
probabilities after each context sum to exactly one.  Unigrams are discounted
likewise; what that frees is the probability of an unknown token.

Everything is counted over the whole corpus and kept in partitioned tables:

``chunks``     the corpus as word codes, a few megabytes of text to a row,
               with the hash of each distinct word (bucketed by chunk);
``unigrams``   by ranges of word hashes: for each chunk, the corpus counts of
               its words;
``bigrams``    by ranges of bigram hashes: for each chunk, the corpus counts
               of its bigrams, and which of them it accounts for;
``backoffs``   by ranges of context hashes: for each chunk, the weights of its
               contexts.

A chunk asks each range once about its distinct words or bigrams and gets an
answer of the same length, so a word or bigram that is everywhere costs one
entry per chunk, and no join ever sees a row per token.  Scores are then
computed chunk by chunk, each token by the model's recursion: bigram, else
backoff to unigram, else unknown.

Words and bigrams are known by 64-bit hashes.  Cases: a null text is empty (one
token, the end); a very long text is a chunk of its own; a null id is neither learned from nor held out; repeated rows
are counted and scored each; without training rows every token is the unknown
token, with probability one; an empty table gives no rows.  A context whose
followers are all too frequent to be discounted counts one unseen occurrence
more, so that its weight is positive and its sum stays one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.blocks import LOWER, U64, SpanHasher, blocks, mix64, word_spans
from martline.session import ensure_checkpoint_dir

CHUNK_BYTES = 5 << 20
#: Tokens to a range of hashes, about.
RANGE_TOKENS = 1 << 20
#: Counts up to this are discounted.
MAX_DISCOUNTED = 5
END = int(mix64(np.array([0x656E64], U64))[0])
BEGIN = int(mix64(np.array([0x626567696E], U64))[0])


# --- packed arrays

def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences of six bytes, or of eight where one is too large."""
    steps = np.diff(keys, prepend=keys[:1])
    steps[0] = 0
    width = 6 if not len(steps) or int(steps.max()) < 1 << 48 else 8
    body = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + body.tobytes()


def unpack_keys(raw: bytes) -> np.ndarray:
    width = raw[0]
    steps = np.zeros(((len(raw) - 9) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=U64) + np.frombuffer(raw, "<u8", count=1, offset=1)[0]


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as single bytes; those of 255 and more stand behind with their places."""
    large = np.flatnonzero(counts >= 255)
    return (np.array([len(counts), len(large)], "<u8").tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes()
            + large.astype("<u4").tobytes() + counts[large].astype("<u8").tobytes())


def unpack_counts(raw: bytes) -> tuple[np.ndarray, bytes]:
    """The counts, and what follows them."""
    n, m = np.frombuffer(raw, "<u8", count=2).tolist()
    counts = np.frombuffer(raw, np.uint8, count=n, offset=16).astype(np.int64)
    at = 16 + n
    if m:
        counts[np.frombuffer(raw, "<u4", count=m, offset=at)] = np.frombuffer(raw, "<u8", count=m, offset=at + 4 * m)
    return counts, raw[at + 12 * m:]


def pack_codes(codes: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_codes(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw, max_output_size=max(1, 4 * n)), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view("<u4").astype(np.int64)


# --- the model

def good_turing(n: np.ndarray, most: int = MAX_DISCOUNTED) -> np.ndarray:
    """Katz's discounts ``d[1..most]`` from the counts of counts ``n[0] = n_1, ...`` (``d[0]`` is unused).

    The largest ``k <= most`` whose discounts all lie strictly between 0 and 1
    is taken; where there is none (too little data), half an occurrence is
    taken from every count up to ``most``.
    """
    n = np.asarray(n, dtype=np.float64)
    for k in range(most, 0, -1):
        if len(n) <= k or not (n[:k + 1] > 0).all():
            continue
        r = np.arange(1, k + 1)
        common = (k + 1) * n[k] / n[0]
        if common >= 1:
            continue
        d = ((r + 1) * n[1:k + 1] / (r * n[:k]) - common) / (1 - common)
        if ((d > 0) & (d < 1)).all():
            return np.concatenate([[1.0], d, np.ones(most - k)])
    return np.concatenate([[1.0], 1 - 0.5 / np.arange(1, most + 1)])


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """``d(r) * r`` for every count."""
    return counts * np.where(counts < len(d), d[np.minimum(counts, len(d) - 1)], 1.0)


class Unigrams:
    """Token probabilities from corpus counts; ``unknown`` is the probability of the unknown token."""

    def __init__(self, tokens: int, types: int, counts_of_counts):
        self.tokens, self.types = tokens, types
        self.d = good_turing(np.asarray(counts_of_counts))
        r = np.arange(1, MAX_DISCOUNTED + 1)
        freed = float((np.asarray(counts_of_counts[:MAX_DISCOUNTED]) * r * (1 - self.d[1:])).sum())
        # where no count is small enough to be discounted, one more, unknown token is counted
        self.total = tokens + (1 if tokens and not freed else 0)
        self.unknown = (freed or 1.0) / self.total if tokens else 1.0

    def probability(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, discounted(counts, self.d) / self.total, self.unknown)


def bigram_hash(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix64(mix64(context ^ U64(0xA0761D6478BD642F)) + token * U64(0x9E3779B97F4A7C15))


class Chunk:
    """One row of the chunk table, unpacked."""

    def __init__(self, row: dict):
        self.ids, self.held, self.train = row["ids"], row["held"], np.array(row["train"], dtype=bool)
        words = np.array(row["words"], dtype=np.int64)
        vocabulary = np.frombuffer(row["vocabulary"], "<u8")
        order = np.argsort(vocabulary)
        self.vocabulary = vocabulary[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        codes = place[unpack_codes(row["codes"], int(words.sum()))]
        # the end after each text's words, the beginning before them
        self.lengths = words + 1
        last = np.cumsum(self.lengths) - 1
        self.row = np.repeat(np.arange(len(words)), self.lengths)
        self.token, self.context = (np.empty(len(self.row), np.int64) for _ in range(2))
        inner = np.ones(len(self.row), dtype=bool)
        inner[last] = False
        self.token[inner], self.token[last] = codes, np.searchsorted(self.vocabulary, U64(END))
        first = last - words
        inner[:] = True
        inner[first] = False
        self.context[inner], self.context[first] = codes, np.searchsorted(self.vocabulary, U64(BEGIN))
        self._bigrams = None

    @property
    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct bigram hashes, ascending; a position of each; the bigram of each token."""
        if self._bigrams is None:
            h = bigram_hash(self.vocabulary[self.context], self.vocabulary[self.token])
            order = np.argsort(h)
            ranked = h[order]
            new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
            of = np.empty(len(h), np.int64)
            of[order] = np.cumsum(new) - 1
            self._bigrams = ranked[new], order[new], of
        return self._bigrams

    def training(self) -> np.ndarray:
        return self.train[self.row]


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


CHUNK_SCHEMA = "chunk bigint, ids array<bigint>, held array<boolean>, train array<boolean>, words array<int>, vocabulary binary, codes binary"
_CHUNK_ARROW = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("train", pa.list_(pa.bool_())),
                          ("words", pa.list_(pa.int32())), ("vocabulary", pa.binary()), ("codes", pa.binary())])


def _make_chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32
    hashes, words, ids, held, train, size = [], [], [], [], [], 0
    for batch in batches:
        text = batch.column("text")
        for lo, hi, data, off in blocks(text):
            starts, ends, counts = word_spans(data, off)
            hashes.append(SpanHasher(LOWER[data])(starts, ends))
            words += counts.tolist()
            for name, into in (("key", ids), ("held", held), ("train", train)):
                into += batch.column(name).slice(lo, hi - lo).to_pylist()
            size += len(data)
            if size >= chunk_bytes:
                yield _chunk(number, hashes, words, ids, held, train)
                number += 1
                hashes, words, ids, held, train, size = [], [], [], [], [], 0
    if ids:
        yield _chunk(number, hashes, words, ids, held, train)


def _chunk(number: int, hashes, words, ids, held, train) -> pa.RecordBatch:
    """Codes number the distinct words by frequency, so that most are small."""
    seen, code, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    extra = np.array([x for x in (END, BEGIN)], U64)
    vocabulary = np.concatenate([seen[order], extra])
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())), pa.array([train], pa.list_(pa.bool_())),
        pa.array([words], pa.list_(pa.int32())), pa.array([vocabulary.astype("<u8").tobytes()], pa.binary()), pa.array([pack_codes(rank[code])], pa.binary())],
        schema=_CHUNK_ARROW)


# --- questions to hash ranges and their answers

REQUEST_SCHEMA = "part int, chunk bigint, keys binary, data binary"
_REQUEST_ARROW = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("data", pa.binary())])
ANSWER_SCHEMA = "part int, chunk bigint, data binary, stats array<bigint>"
_ANSWER_ARROW = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary()), ("stats", pa.list_(pa.int64()))])


def _range_bounds(keys: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.array([0, len(keys)])
    return np.searchsorted(keys >> U64(64 - bits), np.arange((1 << bits) + 1, dtype=U64))


def _requests(chunk: int, keys: np.ndarray, bits: int, pack) -> pa.RecordBatch:
    """One row for each range that holds some of the ascending ``keys``; ``pack(lo, hi)`` makes their data."""
    bounds = _range_bounds(keys, bits)
    parts = np.flatnonzero(np.diff(bounds))
    return pa.RecordBatch.from_arrays([
        pa.array(parts, pa.int32()), pa.array(np.full(len(parts), chunk), pa.int64()),
        pa.array([pack_keys(keys[bounds[p]:bounds[p + 1]]) for p in parts], pa.binary()),
        pa.array([pack(int(bounds[p]), int(bounds[p + 1])) for p in parts], pa.binary())], schema=_REQUEST_ARROW)


def _merge_counts(table: pa.Table) -> pa.Table:
    """Total counts of a range's keys: an answer for each chunk, and a row of statistics.

    An answer has the total of each key asked about and, as bits, whether the
    chunk accounts for the key: the first chunk that has counted it does.
    Statistics: occurrences, keys, and keys counted once, twice and so on.
    """
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    part = rows[0]["part"]
    keys = [unpack_keys(r["keys"]) for r in rows]
    bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    counts = np.concatenate([unpack_counts(r["data"])[0] for r in rows])
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    total = np.bincount(of, weights=counts).astype(np.int64)
    counted = np.flatnonzero(counts)
    owner = np.full(len(total), len(keys))
    owner[of[counted[::-1]]] = counted[::-1]
    mine = owner[of] == np.arange(len(keys))
    data = [pack_counts(total[of[a:b]]) + np.packbits(mine[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
    few = np.bincount(np.minimum(total, MAX_DISCOUNTED + 2), minlength=MAX_DISCOUNTED + 3)[1:MAX_DISCOUNTED + 2]
    stats = [int(total.sum()), int(np.count_nonzero(total)), *few.tolist()]
    return pa.Table.from_arrays([
        pa.array([part] * (len(rows) + 1), pa.int32()), pa.array([*[r["chunk"] for r in rows], -1], pa.int64()),
        pa.array([*data, b""], pa.binary()), pa.array([*[None] * len(rows), stats], pa.list_(pa.int64()))], schema=_ANSWER_ARROW)


def _merge_backoffs(table: pa.Table) -> pa.Table:
    """Per context, from the sums of freed counts and of seen followers' unigram probabilities: weight times context count.

    The sign marks a context without freed counts, for which one unseen
    occurrence is counted.
    """
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    keys = [unpack_keys(r["keys"]) for r in rows]
    bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    seen, of = np.unique(np.concatenate(keys), return_inverse=True)
    sums = [_unpack_sums(r["data"], len(k)) for r, k in zip(rows, keys)]
    freed, followed = (np.bincount(of, weights=np.concatenate(x), minlength=len(seen)) for x in zip(*sums))
    weight = np.where(freed > 0, freed, -1.0) / np.maximum(1 - followed, 1e-300)
    data = [weight[of[a:b]].astype("<f8").tobytes() for a, b in zip(bounds, bounds[1:])]
    n = len(rows)
    return pa.Table.from_arrays([pa.array([r["part"] for r in rows], pa.int32()), pa.array([r["chunk"] for r in rows], pa.int64()),
                                 pa.array(data, pa.binary()), pa.array([None] * n, pa.list_(pa.int64()))], schema=_ANSWER_ARROW)


def _pack_sums(freed: np.ndarray, followed: np.ndarray) -> bytes:
    """Two sums for each key; keys with nothing to add take one bit."""
    some = (freed != 0) | (followed != 0)
    return np.packbits(some).tobytes() + freed[some].astype("<f8").tobytes() + followed[some].astype("<f8").tobytes()


def _unpack_sums(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    head = -(-n // 8)
    some = np.unpackbits(np.frombuffer(raw, np.uint8, count=head), count=n).astype(bool)
    values = np.frombuffer(raw, "<f8", offset=head).reshape(2, -1)
    out = np.zeros((2, n))
    out[:, some] = values
    return out[0], out[1]


def _ask_words(row: dict, bits: int) -> pa.RecordBatch:
    c = Chunk(row)
    counts = np.bincount(c.token, weights=c.training(), minlength=len(c.vocabulary)).astype(np.int64)
    return _requests(row["chunk"], c.vocabulary, bits, lambda a, b: pack_counts(counts[a:b]))


def _ask_bigrams(row: dict, bits: int) -> pa.RecordBatch:
    c = Chunk(row)
    keys, _, of = c.bigrams
    counts = np.bincount(of, weights=c.training(), minlength=len(keys)).astype(np.int64)
    return _requests(row["chunk"], keys, bits, lambda a, b: pack_counts(counts[a:b]))


def _answers(table: pa.Table) -> dict[str, list[bytes]]:
    """The answers to one chunk by table, each in order of the ranges, hence of the keys."""
    found: dict[str, list[bytes]] = {}
    for r in sorted(table.select(["kind", "part", "data"]).to_pylist(), key=lambda r: r["part"]):
        found.setdefault(r["kind"], []).append(r["data"])
    return found


def _counts(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts and accounting bits of all ranges."""
    counts, mine = [], []
    for raw in parts:
        c, rest = unpack_counts(raw)
        counts.append(c)
        mine.append(np.unpackbits(np.frombuffer(rest, np.uint8), count=len(c)).astype(bool))
    return np.concatenate(counts), np.concatenate(mine)


def _ask_backoffs(row: dict, answers: dict[str, list[bytes]], unigrams: Unigrams, d: np.ndarray, bits: int) -> pa.RecordBatch:
    c = Chunk(row)
    p1 = unigrams.probability(_counts(answers["unigrams"])[0])
    keys, at, _ = c.bigrams
    counts, mine = _counts(answers["bigrams"])
    context, token = c.context[at][mine], c.token[at][mine]
    n = len(c.vocabulary)
    freed = np.bincount(context, weights=counts[mine] - discounted(counts[mine], d), minlength=n)
    followed = np.bincount(context, weights=p1[token], minlength=n)
    return _requests(row["chunk"], c.vocabulary, bits, lambda a, b: _pack_sums(freed[a:b], followed[a:b]))


SCORE_SCHEMA = ("key bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def _score_chunk(row: dict, answers: dict[str, list[bytes]], unigrams: Unigrams, d: np.ndarray, train_docs: int) -> pa.Table:
    c = Chunk(row)
    n = len(c.ids)
    counts, _ = _counts(answers["unigrams"])
    p1 = unigrams.probability(counts)
    seen, _ = _counts(answers["bigrams"])
    weight = np.concatenate([np.frombuffer(x, "<f8") for x in answers["backoffs"]])
    followers = counts.copy()
    followers[np.searchsorted(c.vocabulary, U64(BEGIN))] = train_docs
    total = followers + (weight < 0)
    keys, at, of = c.bigrams
    context, token = c.context[at], c.token[at]
    with np.errstate(divide="ignore", invalid="ignore"):
        backed = np.where(followers[context] > 0, np.abs(weight[context]) / total[context], 1.0) * p1[token]
        p = np.where(seen > 0, discounted(seen, d) / total[context], backed)
    score = np.bincount(c.row, weights=np.log10(p)[of], minlength=n)
    base = np.log10((counts + 1) / (unigrams.tokens + unigrams.types + 1))
    return pa.Table.from_arrays([
        pa.array(c.ids, pa.int64()), pa.array(c.held, pa.bool_()), pa.array(c.lengths, pa.int64()),
        pa.array(np.bincount(c.row, weights=counts[c.token] > 0, minlength=n).astype(np.int64)), pa.array(np.full(n, unigrams.tokens), pa.int64()),
        pa.array(np.bincount(c.row, weights=base[c.token], minlength=n)), pa.array(score)],
        ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def katz_scores(docs: DataFrame, train_on: Column, held_out: Column, text: str = "text", key: str = "doc_id",
                chunk_bytes: int = CHUNK_BYTES, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Learns from the rows where ``train_on`` holds and scores all rows.  The
    scores are written to the checkpoint folder; the table of chunks, which is
    known to the catalog for its buckets, is forgotten there.
    """
    spark = docs.sparkSession
    name = f"katz_{uuid.uuid4().hex}"
    place = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    try:
        _write_scores(docs, train_on, held_out, text, key, chunk_bytes, range_tokens, name, place)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.schema(SCORE_SCHEMA).parquet(f"{place}/scores").withColumnRenamed("key", key)


def _write_scores(docs: DataFrame, train_on: Column, held_out: Column, text: str, key: str, chunk_bytes: int, range_tokens: int, name: str, place: str) -> None:
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held"), F.coalesce(train_on, F.lit(False)).alias("train"))
    made = rows.mapInArrow(lambda it: _make_chunks(it, chunk_bytes), CHUNK_SCHEMA)
    # bucketed by chunk: answers are brought to the chunks without moving these again
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made.write.bucketBy(buckets, "chunk").option("path", f"{place}/chunks").format("parquet").saveAsTable(name)
    chunks = spark.table(name)
    tokens, train_docs = chunks.agg(F.sum(F.expr("aggregate(words, 0L, (a, w) -> a + w + 1)")),
                                    F.sum(F.expr("cast(size(filter(train, t -> t)) AS bigint)"))).first()
    bits = max(0, int(np.ceil(np.log2(max(1, (tokens or 0) / range_tokens)))))

    def ask(question, source: DataFrame, merge, table: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in _rows(batch):
                    yield question(row, bits)
        requests = source.mapInArrow(run, REQUEST_SCHEMA)
        requests.groupBy("part").applyInArrow(merge, ANSWER_SCHEMA).write.parquet(f"{place}/{table}")
        return spark.read.parquet(f"{place}/{table}")

    def stats(answers: DataFrame) -> list[int]:
        cells = [F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(MAX_DISCOUNTED + 3)]
        return list(answers.where("chunk = -1").agg(*cells).first())

    word_answers = ask(_ask_words, chunks, _merge_counts, "unigrams")
    n_words, n_types, *word_counts = stats(word_answers)
    unigrams = Unigrams(n_words, n_types, word_counts)
    bigram_answers = ask(_ask_bigrams, chunks, _merge_counts, "bigrams")
    d = good_turing(np.array(stats(bigram_answers)[2:]))
    known = _tagged(word_answers, "unigrams").union(_tagged(bigram_answers, "bigrams"))

    def ask_backoffs(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _answers(right)
        return pa.Table.from_batches([_ask_backoffs(row, found, unigrams, d, bits) for row in _rows(left)], schema=_REQUEST_ARROW)

    requests = chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(ask_backoffs, REQUEST_SCHEMA)
    requests.groupBy("part").applyInArrow(_merge_backoffs, ANSWER_SCHEMA).write.parquet(f"{place}/backoffs")
    known = known.union(_tagged(spark.read.parquet(f"{place}/backoffs"), "backoffs"))
    train_docs = int(train_docs or 0)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _answers(right)
        return pa.concat_tables([_score_chunk(row, found, unigrams, d, train_docs) for row in _rows(left)])

    chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(score, SCORE_SCHEMA).write.parquet(f"{place}/scores")


def _tagged(answers: DataFrame, kind: str) -> DataFrame:
    return answers.where("chunk >= 0").select("chunk", F.lit(kind).alias("kind"), "part", "data")
