"""Repair of conversations to ``(system? (user assistant)+)?`` by lightest derivation.

A conversation's rows, by turn, are parsed with edits: keep a row (0), give it
the role user or assistant (1), delete it (2; a blank row or one seen before
must go), insert an empty user or assistant row (5).  A truncated row that
stays costs 5 more.  Among the cheapest repairs the one whose edits' initials
(D, I, K, R) read least is taken.

The parse is a weighted deduction over a hypergraph.  Items are
``prefix(i, q)``: the first i rows brought the grammar to state q, and axioms
``edit(i, e, symbol)``; the rule that joins a prefix with an edit of the next
row, or with an insertion, has two antecedents.  Weights are (cost, audit)
pairs; a conclusion's weight is the sum of its antecedents' costs and their
audits joined.  That function is superior (never below an antecedent) and
monotone: two weights of one item with equal costs never have audits of which
one begins the other, as the difference would be insertions, which cost.  So
Knuth's agenda holds: the lightest item popped is final, and the first
final goal is the answer.

A conversation too long for a task (``turns``) is parsed in pieces: the agenda
runs from each state at a piece's start, which gives items
``span(piece, q, q')``, and prefixes over pieces are joined with spans by the
same rule.  Rows seen in an earlier piece are found by a count per digest.

Cases: null ids are a conversation; null roles and texts are one space, so a
null text is blank; rows of one turn, or without turn (first), come by role
and text; equal rows beyond the first are duplicates; a role without a first
character can't be kept; very long texts are hashed, never joined; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from martline.llm import turns
from martline.session import ensure_checkpoint_dir

#: Costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: States: nothing yet, after system, after user, after assistant; what a role's initial leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
GOALS = (START, ASSISTANT)
ROLE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

Weight = tuple[int, str]
BLANK = " \t\n\x0b\x0c\r"


class Row:
    """What the agenda knows of a row: its role's initial and its fault."""

    __slots__ = ("initial", "fault")

    def __init__(self, role: str, fault: str | None):
        self.initial, self.fault = role[:1], fault

    def edits(self) -> Iterator[tuple[int, str, str]]:
        """(cost, audit, symbol) of the axioms over this row; a deleted row has no symbol."""
        yield DELETE, "D", ""
        if self.fault not in ("blank", "duplicate"):
            more = TRUNCATED if self.fault == "truncated" else 0
            if self.initial:
                yield KEEP + more, "K", self.initial
            for symbol in ROLE:
                yield REROLE + more, "R", symbol


def fault_of(role: str, text: str, seen: bool) -> str | None:
    """A row's first fault."""
    visible = text.rstrip(BLANK)
    if not visible:
        return "blank"
    if seen:
        return "duplicate"
    return None if visible[-1] in ".!?" else "truncated"


def derive(rows: Sequence[Row], start: int, goals: Sequence[int], every: bool = False) -> dict[int, Weight]:
    """Lightest derivations from ``prefix(0, start)`` to ``prefix(len(rows), q)``: of the first goal popped, or of every goal."""
    n = len(rows)
    wanted = set(goals)
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    found: dict[int, Weight] = {}
    while agenda:
        cost, audit, i, q = heapq.heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        if i == n and q in wanted:
            found[q] = (cost, audit)
            if not every or len(found) == len(wanted):
                break
        if i < n:
            for c, a, symbol in rows[i].edits():
                to = STEP.get((q, symbol)) if symbol else q
                if to is not None and (i + 1, to) not in final:
                    heapq.heappush(agenda, (cost + c, audit + a, i + 1, to))
        for symbol in ROLE:
            to = STEP.get((q, symbol))
            if to is not None and (i, to) not in final:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, to))
    return found


def applied(audit: str, rows: Sequence[tuple[str, str]], state: int = START) -> tuple[list[str], int]:
    """The ``role:text`` lines of (role, text) rows after the edits of ``audit``, and the state reached."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        symbol = rows[at][0][:1] if edit == "K" else "a" if state == USER else "u"
        state = STEP[state, symbol]
        if edit == "I":
            out.append(f"{ROLE[symbol]}:")
            continue
        role, text = rows[at]
        out.append(f"{role if edit == 'K' else ROLE[symbol]}:{text}")
        at += 1
    return out, state


class Counts:
    """Figures of a conversation, row by row: gaps, faults and illegal neighbours."""

    def __init__(self):
        self.least = self.most = self.last_turn = self.last_initial = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: str | None) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.distinct += turn != self.last_turn
            self.most = self.last_turn = turn
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in LEGAL
        self.last_initial = initial

    def row(self) -> tuple[int, ...]:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


_RESULT = [("gaps", T.LongType()), ("blank", T.LongType()), ("duplicate", T.LongType()), ("truncated", T.LongType()), ("illegal", T.LongType()),
           ("cost", T.LongType()), ("audit", T.StringType()), ("repaired_sha256", T.StringType())]


def _typed(key: T.DataType, fields: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField("c", key), *[T.StructField(n, t) for n, t in fields]])


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None,
           max_rows: int = turns.MAX_ROWS, max_bytes: int = turns.MAX_BYTES) -> DataFrame:
    """One row per conversation: the id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    ``present`` names a boolean column; rows where it is false stand for a
    conversation without being rows of it.
    """
    space = F.lit(" ")
    picked = rows.select(F.col(f"`{conv}`").alias("c"), F.col(f"`{turn}`").cast("bigint").alias("t"), F.coalesce(F.col(f"`{role}`"), space).alias("r"),
                         F.coalesce(F.col(f"`{text}`"), space).alias("x"), (F.col(f"`{present}`") if present else F.lit(True)).alias("p"))
    ordinary, long = turns.deal(picked, "c", ["t", "r", "x"], "x", max_rows, max_bytes)
    schema = _typed(picked.schema["c"].dataType, _RESULT)
    arrow = to_arrow_schema(schema)

    def solve(found: list[tuple]) -> tuple:
        here = [r for r in found if r[4]]
        counts, known, items = Counts(), set(), []
        for _, t, r, x, _ in here:
            mark = _digest(r, x)
            fault = fault_of(r, x, mark in known)
            known.add(mark)
            counts.add(t, r[:1], fault)
            items.append(Row(r, fault))
        cost, audit = min(derive(items, START, GOALS).values())
        lines, _ = applied(audit, [(r[2], r[3]) for r in here])
        return found[0][0], *counts.row(), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((solve(found) for _, _, found in turns.runs(batches, 3)), arrow)

    done = ordinary.mapInArrow(run, schema)
    if long is not None:
        done = done.unionByName(_repair_long(long, max_rows, max_bytes))
    return done.withColumnRenamed("c", conv)


# -- conversations that no task holds ----------------------------------------

_STATES = (START, SYSTEM, USER, ASSISTANT)


def _repair_long(rows: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """The rows of ``repair`` for long conversations, sorted inside range partitions."""
    spark = rows.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/repair-{uuid.uuid4().hex}"
    key = rows.schema["c"].dataType
    place = [("part", T.IntegerType()), ("piece", T.IntegerType())]
    row = T.StructType([T.StructField("t", T.LongType()), T.StructField("r", T.StringType()), T.StructField("x", T.StringType()), T.StructField("p", T.BooleanType())])
    piece_schema = _typed(key, [*place, ("rows", T.ArrayType(row)), ("marks", T.ArrayType(T.BinaryType()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ((found[0][0], part, piece, [{"t": t, "r": r, "x": x, "p": p} for _, t, r, x, p in found],
                 list(dict.fromkeys(_digest(r, x) for _, _, r, x, p in found if p))) for part, piece, found in turns.runs(batches, 3, max_rows, max_bytes))
        yield from _batches(made, to_arrow_schema(piece_schema), 1)

    rows.mapInArrow(cut, piece_schema).write.parquet(f"{base}/pieces")
    pieces = spark.read.schema(piece_schema).parquet(f"{base}/pieces")

    # digests that an earlier piece of the conversation has: a piece lists a digest once, whatever its rows
    marks = pieces.select("c", "part", "piece", F.explode("marks").alias("mark"))
    first = marks.groupBy(F.col("c").alias("_c"), F.col("mark").alias("_m")).agg(F.min(F.struct("part", "piece")).alias("first"))
    later = marks.join(first, F.col("c").eqNullSafe(F.col("_c")) & (F.col("mark") == F.col("_m")) & (F.struct("part", "piece") > F.col("first")))
    known = later.groupBy(F.col("c").alias("_c"), F.col("part").alias("_part"), F.col("piece").alias("_piece")).agg(F.collect_list("mark").alias("known"))
    same = F.col("c").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_part")) & (F.col("piece") == F.col("_piece"))
    informed = pieces.join(known, same, "left").drop("_c", "_part", "_piece", "marks")

    count = T.StructType([T.StructField(n, T.LongType()) for n in ("least", "most", "distinct", "blank", "duplicate", "truncated", "illegal")]
                         + [T.StructField(n, T.StringType()) for n in ("first", "last")])
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
    span_schema = _typed(key, [*place, ("counts", count), ("spans", T.ArrayType(span))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((spans_of(*values) for batch in batches for values in zip(*[c.to_pylist() for c in batch.columns])), to_arrow_schema(span_schema), 20)

    def spans_of(c, part: int, piece: int, found: list[dict], known: list[bytes] | None) -> tuple:
        seen, counts, items = set(known or ()), Counts(), []
        here = [r for r in found if r["p"]]
        for r in here:
            mark = _digest(r["r"], r["x"])
            fault = fault_of(r["r"], r["x"], mark in seen)
            seen.add(mark)
            counts.add(r["t"], r["r"][:1], fault)
            items.append(Row(r["r"], fault))
        spans = [{"start": q, "end": to, "cost": w[0], "audit": w[1]} for q in _STATES for to, w in derive(items, q, _reachable(q, items), every=True).items()]
        figures = {n: getattr(counts, n) for n in ("least", "most", "distinct", "blank", "duplicate", "truncated", "illegal")}
        return c, part, piece, {**figures, "first": here[0]["r"][:1] if here else None, "last": counts.last_initial}, spans

    informed.mapInArrow(parse, span_schema).write.parquet(f"{base}/spans")
    spans = spark.read.schema(span_schema).parquet(f"{base}/spans")
    chosen_schema = _typed(key, [*place, ("chosen", T.StringType()), ("state", T.IntegerType()), ("total", T.LongType()), ("figures", T.ArrayType(T.LongType()))])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_chosen(row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns])), to_arrow_schema(chosen_schema), 200)

    spans.repartition("c").sortWithinPartitions("c", "part", "piece").mapInArrow(choose, chosen_schema).write.parquet(f"{base}/chosen")
    chosen = spark.read.schema(chosen_schema).parquet(f"{base}/chosen")
    right = chosen.select(F.col("c").alias("_c"), F.col("part").alias("_part"), F.col("piece").alias("_piece"), "chosen", "state", "total", "figures")
    edited = pieces.drop("marks").join(right, same).drop("_c", "_part", "_piece")
    schema = _typed(key, _RESULT)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            c = state = None
            for batch in batches:
                for row in zip(*[batch.column(n).to_pylist() for n in ("c", "rows", "chosen", "state", "total", "figures")]):
                    if state is None or c != row[0]:
                        if state is not None:
                            yield c, *state[0], "".join(state[1]), state[2].hexdigest()
                        c, state = row[0], [(), [], hashlib.sha256(), False]
                    lines, _ = applied(row[2], [(r["r"], r["x"]) for r in row[1] if r["p"]], row[3])
                    for line in lines:
                        state[2].update((("\n" if state[3] else "") + line).encode())
                        state[3] = True
                    state[1].append(row[2])
                    state[0] = (*row[5], row[4])
            if state is not None:
                yield c, *state[0], "".join(state[1]), state[2].hexdigest()
        yield from _batches(made(), to_arrow_schema(schema), 10)

    return edited.repartition("c").sortWithinPartitions("c", "part", "piece").mapInArrow(finish, schema)


def _reachable(q: int, rows: Sequence[Row]) -> tuple[int, ...]:
    """States that some derivation over ``rows`` reaches from ``q``: itself by deletions, those after it, and system by a kept row."""
    out = {q, USER, ASSISTANT}
    if q == START and any(r.initial == "s" and r.fault not in ("blank", "duplicate") for r in rows):
        out.add(SYSTEM)
    return tuple(sorted(out))


class _Chain:
    """A derivation over pieces: the span it ends with and the one before."""

    __slots__ = ("before", "audit", "place", "state")

    def __init__(self, before: _Chain | None, audit: str, place: tuple[int, int] | None, state: int):
        self.before, self.audit, self.place, self.state = before, audit, place, state


def _lighter(a: tuple[int, _Chain], b: tuple[int, _Chain]) -> bool:
    """Whether weight a is below b; chains of equal length are compared from where they part."""
    if a[0] != b[0]:
        return a[0] < b[0]
    x, y, xs, ys = a[1], b[1], [], []
    while x is not y:
        xs.append(x.audit)
        ys.append(y.audit)
        x, y = x.before, y.before
    return "".join(reversed(xs)) < "".join(reversed(ys))


def _chosen(rows: Iterator[tuple]) -> Iterator[tuple]:
    """For each piece of the conversations, in order, the span of the lightest derivation over all pieces."""
    root = _Chain(None, "", None, START)
    key = held = None
    for c, part, piece, counts, spans in rows:
        if held is None or key != c:
            if held is not None:
                yield from _backwards(key, held, counted)
            key, held, counted = c, {START: (0, root)}, None
        nxt: dict[int, tuple[int, _Chain]] = {}
        for s in spans:
            if s["start"] not in held:
                continue
            cost, before = held[s["start"]]
            item = (cost + s["cost"], _Chain(before, s["audit"], (part, piece), s["end"]))
            if s["end"] not in nxt or _lighter(item, nxt[s["end"]]):
                nxt[s["end"]] = item
        held, counted = nxt, _joined(counted, counts)
    if held is not None:
        yield from _backwards(key, held, counted)


def _joined(a: dict | None, b: dict) -> dict:
    """Figures of two neighbouring runs of rows."""
    if a is None:
        return b
    out = {n: a[n] + b[n] for n in ("distinct", "blank", "duplicate", "truncated", "illegal")}
    out["distinct"] -= a["most"] is not None and a["most"] == b["least"]
    out["illegal"] += a["last"] is not None and b["first"] is not None and a["last"] + b["first"] not in LEGAL
    out["least"] = b["least"] if a["least"] is None else a["least"]
    out["most"] = a["most"] if b["most"] is None else b["most"]
    out["first"] = b["first"] if a["first"] is None else a["first"]
    out["last"] = a["last"] if b["last"] is None else b["last"]
    return out


def _backwards(c, held: dict, counts: dict) -> Iterator[tuple]:
    best = None
    for q in GOALS:
        if q in held and (best is None or _lighter(held[q], best)):
            best = held[q]
    gaps = 0 if counts["least"] is None else counts["most"] - counts["least"] + 1 - counts["distinct"]
    figures = [gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"]]
    chain = []
    link = best[1]
    while link.place is not None:
        chain.append(link)
        link = link.before
    for link in reversed(chain):
        yield c, *link.place, link.audit, link.before.state, best[0], figures


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` with the faults that ``crc32(conv_id:turn) % 20`` plants; dropped rows stay, marked by ``present``."""
    space = F.lit(" ")
    spelled = lambda name: F.coalesce(F.col(name).cast("string"), space)
    kind = F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn"))) % 20
    text = F.coalesce(F.col("text"), space)
    marked = rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(spelled("role")).alias("role"),
                         F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                         (kind != 0).alias("present"), F.when(kind == 3, 2).otherwise(1).alias("copies"))
    return marked.withColumn("copy", F.explode(F.expr("sequence(1, copies)"))).drop("copies", "copy")
