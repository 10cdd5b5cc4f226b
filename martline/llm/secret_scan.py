"""Secret scanning with inferred credential grammars.

Base patterns find credentials of known shape.  Their values, taken from all
documents and labelled by pattern, teach a probabilistic automaton per kind.
A value is read as segments: runs of letters and digits, whose symbol is the
smallest character set that holds them (digits, hexadecimal, lower case, ...),
and single separators.  The prefix tree over these symbols keeps, for every
state, how often values stop, which symbol follows, how long its segment is
and which characters it has.  States are merged, red-blue, while stops,
symbols and lengths are statistically compatible all the way down (Hoeffding
and DKW bounds); states that few values reached give no evidence and stay as
they are, so three values of one format teach that format and no more.

Every run of credential characters outside base spans is a candidate; where
the whole is no credential, its pieces between separators are.  A candidate is
a credential of the kind if its structure (symbols, lengths, stop) and its
characters surprise the automaton hardly more than the labelled values do, and
its likelihood is clearly above that of ordinary text (a model of single
characters).  Such spans are added as kind ``format``; base spans always stay.
Runs too short for any path within the structure's bound are passed over: that
length is computed from the automata, so nothing acceptable is lost.

Learned from: of each kind the ``PER_KIND`` values with the smallest hashes
among those of up to ``MAX_CHARS`` characters; a kind without values has no
automaton.  Offsets are code points, ends exclusive.  Cases: a null text is
empty; a text without candidates has no spans; repeated rows get equal spans;
a very long text is held whole in its task, about 26 bytes per byte of it.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.blocks import blocks, break_spans, replace_columns
from martline.session import ensure_checkpoint_dir

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED = 6
#: Base matches within runs are at least this long.
MIN_CANDIDATE = 16
#: Separators at which a run is cut into pieces.
SEPARATORS = "=/.-"
#: Bounds of the labelled credentials: of each kind, characters of each.
PER_KIND = 1_000
MAX_CHARS = 4_096
#: Parts of the hash range in which values are counted.
HASH_PARTS = 4_096

_RUN = np.zeros(256, dtype=bool)
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-":
    _RUN[_c] = True


#: Character sets of segments, smaller ones first: their symbol, characters and size.
SETS = [("0", re.compile("[0-9]+"), 10), ("f", re.compile("[0-9a-f]+"), 16), ("F", re.compile("[0-9A-F]+"), 16), ("g", re.compile("[0-9a-z]+"), 36),
        ("G", re.compile("[0-9A-Z]+"), 36), ("m", re.compile("[0-9A-Za-z]+"), 62)]
SIZE = {symbol: size for symbol, _, size in SETS}
#: The sets that hold all characters of a set.
WIDER = {"0": "0fFgGm", "f": "fgm", "F": "FGm", "g": "gm", "G": "Gm", "m": "m"}
_SEGMENT = re.compile("[0-9A-Za-z]+|[^0-9A-Za-z]")

#: Values that must have reached two states before they are compared.
EVIDENCE = 10
#: Positions of a segment whose characters are learned one by one.
HEAD = 8
#: Weight of what was never seen.
EPSILON = 0.05
#: Bits that an unseen symbol costs beyond the prefix tree.
LOST = 12.0


def segments(s: str) -> list[tuple[str, str]]:
    """(symbol, text) of the segments of a value."""
    out = []
    for part in _SEGMENT.findall(s):
        out.append((next((symbol for symbol, chars, _ in SETS if chars.fullmatch(part)), part), part))
    return out


class Segment:
    """Lengths and characters of a symbol's segments after one state."""

    def __init__(self):
        self.lengths: Counter = Counter()
        self.heads: list[Counter] = [Counter() for _ in range(HEAD)]
        self.chars: Counter = Counter()

    def add(self, part: str) -> None:
        self.lengths[len(part)] += 1
        self.chars.update(part)
        for c, head in zip(part, self.heads):
            head[c] += 1

    def update(self, other: Segment) -> None:
        self.lengths.update(other.lengths)
        self.chars.update(other.chars)
        for mine, theirs in zip(self.heads, other.heads):
            mine.update(theirs)

    def length_bits(self, n: int, own: int = 0) -> float:
        """Surprise of a length: lengths seen once tell how much is left for those never seen.

        With ``own`` 1 the value itself, one of those learned from, is left out.
        """
        total, seen = self.lengths.total() - own, self.lengths.get(n, 0) - own
        unseen = min(0.5, (self._once(self.lengths, n, own) + 0.5) / (total + 1))
        return -math.log2((1 - unseen) * seen / total if seen > 0 else unseen / (max(n, *self.lengths) + 8))

    @staticmethod
    def _once(counts: Counter, of: object, own: int) -> int:
        """How many things were seen once, without one sight of ``of`` if that is left out."""
        once = sum(c == 1 for c in counts.values())
        return once + ((counts[of] == 2) - (counts[of] == 1) if own else 0)

    def char_bits(self, part: str, size: int, own: int = 0) -> float:
        """Surprise of a segment's characters: in its head by place, as far as characters recur there, else by the set's."""
        mine = Counter(part) if own else {}
        total = max(0, self.chars.total() - own * len(part))
        bits = 0.0
        for i, c in enumerate(part):
            p = (max(0, self.chars.get(c, 0) - mine.get(c, 0)) + 0.5) / (total + 0.5 * size)
            if i < HEAD:
                head = self.heads[i]
                n = head.total() - own
                if n > 0:
                    new = min(1.0, (self._once(head, c, own) + 0.5) / (n + 1))
                    p = (1 - new) * max(0, head.get(c, 0) - own) / n + new * p
            bits -= math.log2(p)
        return bits


@dataclass
class State:
    arrivals: int = 0
    stops: int = 0
    to: dict[str, int] = field(default_factory=dict)
    taken: Counter = field(default_factory=Counter)
    parts: dict[str, Segment] = field(default_factory=dict)

    def stop_bits(self, own: int = 0) -> float:
        return -math.log2((max(0, self.stops - own) + EPSILON) / (self.arrivals - own + EPSILON * (len(self.to) + 2)))

    def symbol_bits(self, symbol: str, own: int = 0) -> float:
        return -math.log2((max(0, self.taken[symbol] - own) + EPSILON) / (self.arrivals - own + EPSILON * (len(self.to) + 2)))


class Automaton:
    """Stochastic automaton inferred from strings by merging compatible prefix-tree states."""

    def __init__(self, strings: Sequence[str], alpha: float = 0.05):
        self.states = [State()]
        self.alpha = alpha
        for s in strings:
            self._add(s)
        self._merge()
        found = [self.surprise(s, own=1) for s in strings] or [(0.0, 0.0)]
        place = int(0.98 * (len(found) - 1))
        #: What the labelled values are surprising by when left out, but for the oddest fiftieth: bits of structure, bits per character.
        self.structure = sorted(x for x, _ in found)[place]
        self.characters = sorted(y / max(1, len(s)) for (_, y), s in zip(found, strings or [""]))[place]

    def _add(self, s: str) -> None:
        at = 0
        for symbol, part in segments(s):
            state = self.states[at]
            state.arrivals += 1
            state.taken[symbol] += 1
            if symbol not in state.to:
                self.states.append(State())
                state.to[symbol] = len(self.states) - 1
                state.parts[symbol] = Segment()
            state.parts[symbol].add(part)
            at = state.to[symbol]
        self.states[at].arrivals += 1
        self.states[at].stops += 1

    def _bound(self, n1: int, n2: int) -> float:
        return math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self._bound(n1, n2)

    def _lengths_differ(self, x: Counter, y: Counter) -> bool:
        """Whether the distributions of two sets of lengths are farther apart than chance allows."""
        n1, n2 = x.total(), y.total()
        if min(n1, n2) < EVIDENCE:
            return False
        a = b = 0
        for n in sorted(x.keys() | y.keys()):
            a, b = a + x.get(n, 0), b + y.get(n, 0)
            if self._differ(a, n1, b, n2):
                return True
        return False

    def _compatible(self, a: int, b: int) -> bool:
        if min(self.states[a].arrivals, self.states[b].arrivals) < EVIDENCE:
            return False
        todo, seen = [(a, b)], set()
        while todo:
            pair = todo.pop()
            x, y = self.states[pair[0]], self.states[pair[1]]
            if pair in seen or min(x.arrivals, y.arrivals) < EVIDENCE:
                continue
            seen.add(pair)
            if self._differ(x.stops, x.arrivals, y.stops, y.arrivals):
                return False
            for symbol in x.to.keys() | y.to.keys():
                if self._differ(x.taken[symbol], x.arrivals, y.taken[symbol], y.arrivals):
                    return False
                if symbol in x.to and symbol in y.to:
                    if self._lengths_differ(x.parts[symbol].lengths, y.parts[symbol].lengths):
                        return False
                    todo.append((x.to[symbol], y.to[symbol]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the automaton at ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            x, y = self.states[a], self.states[b]
            x.arrivals += y.arrivals
            x.stops += y.stops
            x.taken.update(y.taken)
            for symbol, child in y.to.items():
                if symbol in x.to:
                    x.parts[symbol].update(y.parts[symbol])
                    todo.append((x.to[symbol], child))
                else:
                    x.to[symbol], x.parts[symbol] = child, y.parts[symbol]

    def _merge(self) -> None:
        red = [0]
        known = {0}
        while True:
            blue = [(r, symbol, child) for r in red for symbol, child in self.states[r].to.items() if child not in known]
            if not blue:
                break
            parent, symbol, node = max(blue, key=lambda x: (self.states[x[2]].arrivals, -x[2]))
            merged = next((r for r in red if self._compatible(r, node)), None)
            if merged is None:
                # states with as little evidence as this one are not compared either
                new = [node] if self.states[node].arrivals >= EVIDENCE else [child for _, _, child in blue]
                red += new
                known.update(new)
            else:
                self.states[parent].to[symbol] = merged
                self._fold(merged, node)
        number = {r: i for i, r in enumerate(red)}
        self.states = [self.states[r] for r in red]
        for s in self.states:
            s.to = {symbol: number[c] for symbol, c in s.to.items()}

    def _ways(self, state: State, symbol: str) -> list[str]:
        """Symbols after a state that produce a segment of ``symbol``."""
        return [w for w in WIDER.get(symbol, symbol) if w in state.to]

    def structure_bits(self, shape: Sequence[tuple[str, int]]) -> float:
        """Least surprise of symbols, lengths and the stop, over all paths."""
        paths: dict[int | None, float] = {0: 0.0}
        for symbol, n in shape:
            after: dict[int | None, float] = {}
            for at, bits in paths.items():
                state = None if at is None else self.states[at]
                ways = [] if state is None else self._ways(state, symbol)
                if not ways:
                    after[None] = min(after.get(None, math.inf), bits + LOST)
                for w in ways:
                    cost = bits + state.symbol_bits(w) + (state.parts[w].length_bits(n) if w in SIZE else 0.0)
                    after[state.to[w]] = min(after.get(state.to[w], math.inf), cost)
            paths = after
        return min((bits + (LOST if at is None else self.states[at].stop_bits()) for at, bits in paths.items()), default=math.inf)

    def surprise(self, s: str, own: int = 0) -> tuple[float, float]:
        """Bits of structure and bits of characters of the likeliest path for ``s`` (``own`` 1: as if not learned from)."""
        paths: dict[int | None, tuple[float, float]] = {0: (0.0, 0.0)}
        for symbol, part in segments(s):
            after: dict[int | None, tuple[float, float]] = {}
            for at, (bits, said) in paths.items():
                state = None if at is None else self.states[at]
                ways = [] if state is None else self._ways(state, symbol)
                if not ways:
                    new = [(None, (bits + LOST, said + len(part) * math.log2(SIZE.get(symbol, 2))))]
                else:
                    new = [(state.to[w], (bits + state.symbol_bits(w, own * (w == symbol)) + (state.parts[w].length_bits(len(part), own * (w == symbol)) if w in SIZE else 0.0),
                                          said + (state.parts[w].char_bits(part, SIZE[w], own * (w == symbol)) if w in SIZE else 0.0))) for w in ways]
                for to, found in new:
                    if to not in after or sum(found) < sum(after[to]):
                        after[to] = found
            paths = after
        ends = [(bits + (LOST if at is None else self.states[at].stop_bits(own)), said) for at, (bits, said) in paths.items()]
        return min(ends, key=sum)

    def score(self, s: str) -> float:
        """Log2 likelihood per character."""
        return -sum(self.surprise(s)) / max(1, len(s))

    def shortest(self, bits: float) -> int:
        """The least length of any string whose structure surprises by at most ``bits``."""
        queue: list[tuple[int, float, int]] = [(0, 0.0, 0)]
        best: dict[int, float] = {}
        while queue:
            n, used, at = heapq.heappop(queue)
            state = self.states[at]
            if n and used + state.stop_bits() <= bits:
                return n
            if best.get(at, math.inf) <= used:
                continue  # a shorter string came here with as few bits
            best[at] = used
            for symbol, to in state.to.items():
                cost = used + state.symbol_bits(symbol)
                if symbol not in SIZE:
                    options = {1: 0.0}
                else:
                    part = state.parts[symbol]
                    # of the lengths never seen, all up to the longest cost the same: the least will do
                    unseen = next(x for x in itertools.count(1) if x not in part.lengths)
                    options = {x: part.length_bits(x) for x in (unseen, *part.lengths)}
                for length, bits_of in options.items():
                    total = cost + bits_of
                    if total <= bits:
                        heapq.heappush(queue, (n + length, total, to))
        return 1 << 30


@dataclass
class Grammar:
    """Automata by kind and the character model of ordinary text.

    ``margin``: bits per character by which a credential is likelier than
    ordinary text; ``slack``: bits of structure, and ``loose`` bits per
    character, by which it may surprise more than the labelled values.
    """

    automata: dict[str, Automaton]
    ordinary: dict[str, float]
    floor: float
    margin: float = 1.0
    slack: float = 2.0
    loose: float = 0.5
    known: dict[str, bool] = field(default_factory=dict)
    shapes: dict[tuple, list[str]] = field(default_factory=dict)

    def __post_init__(self):
        #: No shorter string has a structure within the bounds.
        self.least = min((a.shortest(a.structure + self.slack) for a in self.automata.values()), default=MIN_CANDIDATE)

    def accepts(self, s: str) -> bool:
        """``is_credential``, with the answers for short strings kept in bounds."""
        if len(s) > 64:
            return self.is_credential(s)
        if s not in self.known:
            if len(self.known) >= 1 << 16:
                self.known.clear()
            self.known[s] = self.is_credential(s)
        return self.known[s]

    def credentials(self, run: str, at: int) -> Iterator[tuple[int, int]]:
        """Spans of the run that starts ``at``: the whole if it is a credential, else those of its pieces."""
        todo = [(run, at)]
        while todo:
            s, at = todo.pop()
            if len(s) < self.least:
                continue
            if self.accepts(s):
                yield at, at + len(s)
                continue
            inner = s.strip(SEPARATORS)
            if inner != s:
                todo.append((inner, at + len(s) - len(s.lstrip(SEPARATORS))))
                continue
            # a value after an equals sign is a candidate before its own pieces
            cuts = [i for i, c in enumerate(s) if c == "="] or [i for i, c in enumerate(s) if c in SEPARATORS]
            if cuts:
                todo += [(s[a + 1:b], at + a + 1) for a, b in zip([-1, *cuts], [*cuts, len(s)])]

    def _structured(self, s: str) -> list[str]:
        """The kinds whose structure ``s`` has."""
        shape = tuple((symbol, len(part)) for symbol, part in segments(s))
        if shape not in self.shapes:
            if len(self.shapes) >= 1 << 15:
                self.shapes.clear()
            self.shapes[shape] = [k for k, a in self.automata.items() if a.structure_bits(shape) <= a.structure + self.slack]
        return self.shapes[shape]

    def is_credential(self, s: str) -> bool:
        kinds = self._structured(s)
        if not kinds:
            return False
        plain = -sum(self.ordinary.get(c, self.floor) for c in s)
        for a in map(self.automata.__getitem__, kinds):
            structure, said = a.surprise(s)
            if structure <= a.structure + self.slack and said / len(s) <= a.characters + self.loose and structure + said + self.margin * len(s) <= plain:
                return True
        return False


def fit_grammar(credentials: Sequence[tuple[str, str]], ordinary_chars: Counter) -> Grammar:
    """Automata of the kinds of (kind, value) pairs, and the character model."""
    by_kind: dict[str, set[str]] = {}
    for kind, value in credentials:
        by_kind.setdefault(kind, set()).add(value)
    total = sum(ordinary_chars.values()) + 1
    ordinary = {c: math.log2((n + 0.5) / total) for c, n in sorted(ordinary_chars.items())}
    automata = {k: Automaton(sorted(v, key=_place)[:PER_KIND]) for k, v in sorted(by_kind.items())}
    return Grammar(automata, ordinary, math.log2(0.5 / total))


def _place(value: str) -> tuple[int, str]:
    """Credentials in the order of a hash, the same in every task."""
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "little", signed=True), value


def text_spans(data: np.ndarray, off: np.ndarray, least: int = MIN_CANDIDATE) -> Iterator[tuple[int, list[tuple[int, int, str, str]], list[tuple[int, int, str]]]]:
    """For each text with any: its index, base spans (start, end, kind, value) and candidates (start, end, string).

    Access keys, hex strings and candidates all lie within runs of credential
    characters, so the bytes are searched for long runs first.
    """
    starts, ends, counts = break_spans(_RUN[data], off)
    row = np.repeat(np.arange(len(off) - 1), counts)
    long = ends - starts >= min(least, MIN_CANDIDATE)
    starts, ends, row = starts[long], ends[long], row[long]
    raw = data.tobytes()
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    # an assignment needs a colon or an equals sign
    signs = np.concatenate([[0], np.cumsum((data == 0x3A) | (data == 0x3D))])
    assigns = signs[off[1:]] > signs[off[:-1]]
    first = np.searchsorted(row, np.arange(len(off)))
    for i in np.flatnonzero(assigns | (np.diff(first) > 0)):
        base: list[tuple[int, int, str, str]] = []
        found: list[tuple[int, int, str]] = []
        zero = int(points[off[i]])
        if assigns[i]:
            text = raw[off[i]:off[i + 1]].decode("utf-8", errors="replace")
            base += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
        for k in range(first[i], first[i + 1]):
            run = raw[starts[k]:ends[k]].decode()
            at = int(points[starts[k]]) - zero
            if len(run) >= 20:
                base += [(at + m.start(), at + m.end(), "access", m[0]) for m in ACCESS.finditer(run)]
            if len(run) >= 24:
                base += [(at + m.start(), at + m.end(), "hex", m[0]) for m in HEX.finditer(run)]
            if len(run) >= least:
                found.append((at, at + len(run), run))
        if base or found:
            yield int(i), base, found


def _sorted(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def outside(run: str, at: int, spans: list[tuple[int, int]]) -> Iterator[tuple[str, int]]:
    """The parts of a run, starting ``at``, that no span covers."""
    end, lo = at + len(run), at
    for a, b in spans:
        if a < end and b > lo:
            if a > lo:
                yield run[lo - at:a - at], lo
            lo = b
    if lo < end:
        yield run[lo - at:], lo


def fit(docs: DataFrame, text: str = "text", train_on: Column | None = None) -> Grammar:
    """Learn from the base matches of all documents.

    A task hands on character counts and, of each kind, the ``PER_KIND`` values
    with the smallest hashes.  They are counted by kind and part of the hash
    range; the parts up to the one with a kind's ``PER_KIND``-th value are read.
    """
    rows = docs if train_on is None else docs.where(train_on)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values: dict[str, set[tuple[int, str]]] = {}
        chars = np.zeros(256, np.int64)
        for batch in batches:
            for _, _, data, off in blocks(batch.column(0)):
                chars += np.bincount(data, minlength=256)
                for _, base, _ in text_spans(data, off):
                    for _, _, kind, value in base:
                        kept = values.setdefault(kind, set())
                        if len(value) <= MAX_CHARS:
                            kept.add(_place(value))
                        if len(kept) >= 4 * PER_KIND:
                            values[kind] = set(sorted(kept)[:PER_KIND])
        out = [(kind, v, h, 0) for kind, kept in sorted(values.items()) for h, v in sorted(kept)[:PER_KIND]]
        out += [("", chr(c), 0, int(k)) for c, k in enumerate(chars) if k and _RUN[c]]
        kinds, vs, hs, ks = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(vs, pa.string()), pa.array(hs, pa.int64()), pa.array(ks, pa.int64())],
                                         ["kind", "value", "h", "n"])

    ensure_checkpoint_dir(docs.sparkSession)
    width = (1 << 64) // HASH_PARTS
    part = F.shiftright("h", width.bit_length() - 1)
    found = (rows.select(F.col(f"`{text}`")).mapInArrow(run, "kind string, value string, h bigint, n bigint")
             .groupBy("kind", "value", "h").agg(F.sum("n").alias("n")).checkpoint())
    ends: dict[str, int] = {}
    counts: Counter = Counter()
    for r in found.where("kind <> ''").groupBy("kind", part.alias("part")).count().orderBy("kind", "part").collect():
        if counts[r["kind"]] < PER_KIND:
            ends[r["kind"]] = r["part"]
        counts[r["kind"]] += r["count"]
    wanted = F.col("kind") == ""
    for kind, end in ends.items():
        wanted = wanted | ((F.col("kind") == kind) & (part <= end))
    kept = found.where(wanted).collect()
    ordinary = Counter({r["value"]: r["n"] for r in kept if r["kind"] == ""})
    return fit_grammar([(r["kind"], r["value"]) for r in kept if r["kind"]], ordinary)


def scan(docs: DataFrame, grammar: Grammar | None, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` plus all spans of each whole text as an array of (start, end, kind), in order."""
    kept = replace_columns(docs, spans)
    learned = grammar is not None and bool(grammar.automata)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for column in batches:
            out: list[list[dict]] = [[] for _ in range(len(column))]
            for lo, _, data, off in blocks(column):
                for i, base, found in text_spans(data, off, grammar.least if learned else MIN_CANDIDATE):
                    spans = [(a, b, k) for a, b, k, _ in base]
                    taken = sorted((a, b) for a, b, _ in spans)
                    for a, b, run in found if learned else ():
                        parts = outside(run, a, [x for x in taken if x[0] < b and a < x[1]]) if taken else ((run, a),)
                        spans += [(x, y, "format") for part, at in parts for x, y in grammar.credentials(part, at)]
                    out[lo + i] = [{"start": a, "end": b, "kind": k} for a, b, k in _sorted(spans)]
            yield pa.array(out, kind_type)

    schema = "array<struct<start: bigint, end: bigint, kind: string>>"
    return kept.withColumn(spans, F.arrow_udf(run, schema, F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`")))
