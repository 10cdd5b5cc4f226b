"""A quality suite planned as one pass per table (Q1-Q5, Q7-Q9, Q12 fused; Q11 over it).

Checks are declared first; then the planner gathers, for each table, every
figure that any check wants of it.  A table is read once: figures that need
keys (duplicates, distinct groups) come from one grouping by the table's keys
that also carries the partial sums of all other figures, and a second, small
aggregate brings them to one row per day.  Those rows are turned into cells
``(check, item, side, day, value)``, the cells of all tables are united, and
one fold compares the two sides of every check, by day where the check is by
day.  Checks join nothing: two tables meet in the fold's grouping.

Sums are DECIMAL(38,10) throughout.  An empty or null-only table still has a
row for each of its checks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.functions.numeric import MONEY, formula_mismatch
from martline.operators.rollup import dealt
from martline.plans.quality import OUT

VALUE = "decimal(38,10)"
LEFT, RIGHT = 0, 1


@dataclass(frozen=True)
class Figure:
    """What a check wants of a table: kind is count, sum, filled, count_if, duplicates or groups."""

    kind: str
    name: str = ""
    of: Column | None = field(default=None, compare=False)
    keys: tuple[str, ...] = ()

    def partial(self) -> Column:
        """The figure of some rows, such that figures of several parts add up."""
        if self.kind == "sum":
            return F.sum(self.of.cast(VALUE))
        if self.kind == "filled":
            return F.count(F.col(f"`{self.name}`"))
        return F.count_if(self.of) if self.kind == "count_if" else F.count(F.lit(1))


COUNT = Figure("count")


def total(of: str | Column, name: str = "") -> Figure:
    """The sum of a column, or of an expression under a name of its own."""
    return Figure("sum", name or str(of), F.col(of) if isinstance(of, str) else of)


def rows_where(name: str, cond: Column) -> Figure:
    return Figure("count_if", name, cond)


def groups(keys: Sequence[str]) -> Figure:
    """The number of distinct key combinations (nulls equal)."""
    return Figure("groups", keys=tuple(keys))


@dataclass
class _Want:
    """One side of a check: a figure of a table, times a factor, by day or in all."""

    check: int
    item: str
    side: int
    figure: Figure
    by_day: bool = False
    factor: int = 1


class Suite:
    """Declared checks over named tables; ``rows`` plans and returns (check, table_name, status, detail)."""

    def __init__(self, tolerance: float = 0.01):
        self.tolerance = tolerance
        self.checks: list[tuple[str, str, str]] = []  # (check, table_name, kind of verdict)
        self.wants: dict[str, list[_Want]] = {}
        self.dates: dict[str, str] = {}
        self.placed: set[str] = set()
        self._all_columns: list[tuple[int, str, set[str]]] = []

    # -- declarations

    def dated(self, **columns: str) -> Suite:
        """The date column of each table that has one."""
        self.dates.update(columns)
        return self

    def dealt(self, *tables: str) -> Suite:
        """Tables whose rows come dealt by some of the keys they are grouped by; they are not dealt again."""
        self.placed.update(tables)
        return self

    def _check(self, check: str, table: str, verdict: str) -> int:
        self.checks.append((check, table, verdict))
        return len(self.checks) - 1

    def _want(self, table: str, *args, **kw) -> None:
        self.wants.setdefault(table, []).append(_Want(*args, **kw))

    def exists(self, *tables: str) -> Suite:
        """Q1: the table has rows."""
        for t in tables:
            self._want(t, self._check("exists", t, "exists"), "", LEFT, COUNT)
        return self

    def grain(self, table: str, keys: Sequence[str]) -> Suite:
        """Q2: no two rows share the keys (nulls equal); the detail counts all rows that do."""
        self._want(table, self._check("grain", table, "none"), "", LEFT, Figure("duplicates", keys=tuple(keys)))
        return self

    def date_range(self, table: str, within: str) -> Suite:
        """Q3: the table's days lie between the first and the last day of ``within``."""
        c = self._check("date_range", table, "days")
        self._want(table, c, "", LEFT, COUNT, by_day=True)
        self._want(within, c, "", RIGHT, COUNT, by_day=True)
        return self

    def filled(self, table: str, allowed: Sequence[str] = ()) -> Suite:
        """Q4: every column but the ``allowed`` has a value."""
        self._all_columns.append((self._check("empty_columns", table, "columns"), table, set(allowed)))
        return self

    def totals(self, name: str, left: tuple[str, Figure], right: tuple[str, Figure]) -> Suite:
        """Q5: two totals agree."""
        return self._pair(self._check("reconcile", name, "totals"), left, right)

    def expected(self, name: str, left: tuple[str, Figure], right: tuple[str, Figure], factor: int = 1) -> Suite:
        """Q7: a count equals ``factor`` times another table's."""
        return self._pair(self._check("expected_rows", name, "counts"), left, right, factor)

    def _pair(self, check: int, left: tuple[str, Figure], right: tuple[str, Figure], factor: int = 1) -> Suite:
        self._want(left[0], check, "", LEFT, left[1])
        self._want(right[0], check, "", RIGHT, right[1], factor=factor)
        return self

    def alignment(self, name: str, source: str, rollup: str, metrics: Sequence[tuple[str, Figure, Figure]]) -> Suite:
        """Q8: per day, figures of a source equal those of its rollup; the detail counts days that differ."""
        for metric, left, right in metrics:
            c = self._check("alignment_" + metric, name, "aligned")
            self._want(source, c, "", LEFT, left, by_day=True)
            self._want(rollup, c, "", RIGHT, right, by_day=True)
        return self

    def overlap(self, name: str, raw: str, kept: str, dropped: Column) -> Suite:
        """Q9: rows of all extracts minus those removed are the rows kept."""
        c = self._check("overlap_removal", name, "overlap")
        self._want(raw, c, "", LEFT, COUNT)
        self._want(raw, c, "dropped", LEFT, rows_where("dropped", dropped))
        self._want(kept, c, "", RIGHT, COUNT)
        return self

    def formula(self, name: str, table: str, columns: Sequence[str] = ("quantity", "unit_price", "discount_per_unit", "line_revenue")) -> Suite:
        """Q12: line revenue is quantity times price less discount."""
        self._want(table, self._check("revenue_formula", name, "none"), "", LEFT, rows_where("formula", formula_mismatch(*columns, self.tolerance)))
        return self

    # -- planning

    def rows(self, spark: SparkSession, table: Callable[[str], DataFrame] | Mapping[str, DataFrame]) -> DataFrame:
        """The check rows; a plan only, nothing runs or is written."""
        get = table if callable(table) else table.__getitem__
        wants = {t: list(w) for t, w in self.wants.items()}
        known = {(w.check, w.item) for ws in wants.values() for w in ws}
        frames = {t: get(t) for t in [*wants, *(t for _, t, _ in self._all_columns)]}
        for check, t, allowed in self._all_columns:
            for c in frames[t].columns:
                if c not in allowed:
                    wants.setdefault(t, []).append(_Want(check, c, LEFT, Figure("filled", c)))
                    known.add((check, c))
        cells = None
        for t, ws in wants.items():
            part = self._cells(frames[t], t, ws)
            cells = part if cells is None else cells.unionByName(part)
        # every check has a row, also where its tables have none
        named = spark.createDataFrame(sorted(known), "check int, item string")
        blank = named.select("check", "item", F.lit(None).cast("int").alias("side"), F.lit(None).cast("date").alias("day"), F.lit(None).cast(VALUE).alias("value"))
        return self._verdicts(blank if cells is None else cells.unionByName(blank))

    def _cells(self, df: DataFrame, table: str, wants: Sequence[_Want]) -> DataFrame:
        date = self.dates.get(table)
        if date is None and any(w.by_day for w in wants):
            raise ValueError(f"{table} has no date column for a check by day")
        figures = list(dict.fromkeys(w.figure for w in wants))
        at = {f: f"f{i}" for i, f in enumerate(figures)}
        day = F.to_date(F.col(f"`{date}`")) if date and any(w.by_day for w in wants) else F.lit(None).cast("date")
        key_sets = list(dict.fromkeys(f.keys for f in figures if f.keys))
        plain = [f for f in figures if not f.keys]
        daily = None
        for keys in key_sets or [()]:
            # plain figures ride on the first grouping
            carried = plain if not key_sets or keys == key_sets[0] else []
            if keys:
                by = (df if table in self.placed else dealt(df, keys)).groupBy(*[F.col(f"`{k}`") for k in keys], day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"), *[f.partial().alias(at[f]) for f in carried])
                keyed = {"duplicates": F.sum(F.when(F.col("_n") > 1, F.col("_n"))), "groups": F.count(F.lit(1))}
                aggs = [F.sum(at[f]).cast(VALUE).alias(at[f]) for f in carried]
                aggs += [keyed[f.kind].cast(VALUE).alias(at[f]) for f in figures if f.keys == keys]
                one = by.groupBy("_day").agg(*aggs)
            else:
                one = df.groupBy(day.alias("_day")).agg(*[f.partial().cast(VALUE).alias(at[f]) for f in carried])
            there = set(one.columns)
            text = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
            cell = ", ".join(
                f"named_struct('check', {w.check}, 'item', {text(w.item)}, 'side', {w.side}, 'day', {'_day' if w.by_day else 'CAST(NULL AS DATE)'}, "
                f"'value', CAST({at[w.figure]} * {w.factor} AS {VALUE}))" for w in wants if at[w.figure] in there)
            part = one.selectExpr(f"inline(array({cell}))")
            daily = part if daily is None else daily.unionByName(part)
        return daily

    def _verdicts(self, cells: DataFrame) -> DataFrame:
        left, right = F.col("side") == LEFT, F.col("side") == RIGHT
        tol = F.lit(str(self.tolerance)).cast("decimal(18,6)")
        by_day = cells.groupBy("check", "item", "day").agg(
            F.sum(F.when(left, F.col("value"))).alias("l"), F.sum(F.when(right, F.col("value"))).alias("r"),
            F.max(left).alias("has_l"), F.max(right).alias("has_r"))
        real = F.col("has_l") | F.col("has_r")
        differs = real & (F.col("l").isNull() | F.col("r").isNull() | (F.abs(F.col("l") - F.col("r")) > tol))
        span = lambda side, f: f(F.when(F.col(side), F.col("day")))
        items = by_day.groupBy("check", "item").agg(
            F.sum("l").alias("l"), F.sum("r").alias("r"), F.count_if(differs).alias("days"),
            span("has_l", F.min).alias("l_first"), span("has_l", F.max).alias("l_last"), span("has_r", F.min).alias("r_first"), span("has_r", F.max).alias("r_last"))
        main = F.col("item") == ""
        folded = items.groupBy("check").agg(
            *[F.max(F.when(main, F.col(c))).alias(c) for c in ("l", "r", "days", "l_first", "l_last", "r_first", "r_last")],
            F.max(F.when(F.col("item") == "dropped", F.col("l"))).alias("dropped"),
            F.array_join(F.array_sort(F.collect_list(F.when(F.coalesce(F.col("l"), F.lit(0)) == 0, F.col("item")))), ",").alias("empty"))
        whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
        text = lambda c: c.cast("string")
        diff = F.abs(F.col("l") - F.col("r"))
        rules = {
            "exists": (whole("l") > 0, F.when(whole("l") > 0, "non-empty").otherwise("empty")),
            "none": (whole("l") == 0, text(whole("l"))),
            "days": ((F.col("l_first") >= F.col("r_first")) & (F.col("l_last") <= F.col("r_last")), F.concat_ws("..", text(F.col("l_first")), text(F.col("l_last")))),
            "columns": (F.col("empty") == "", F.col("empty")),
            "totals": (F.round(diff, 6) <= tol, text(F.round(diff, 2).cast(MONEY))),
            "counts": (whole("l") == whole("r"), F.concat_ws("/", text(whole("l")), text(whole("r")))),
            "aligned": (F.col("days") == 0, text(F.col("days"))),
            "overlap": (whole("l") - whole("dropped") == whole("r"), F.concat(text(whole("l")), F.lit("-"), text(whole("dropped")), F.lit("="), text(whole("r")))),
        }
        ok = detail = None
        verdict = F.element_at(F.array(*[F.lit(v) for _, _, v in self.checks]), F.col("check") + 1)
        for kind in dict.fromkeys(v for _, _, v in self.checks):
            good, said = rules[kind]
            ok = F.when(verdict == kind, good) if ok is None else ok.when(verdict == kind, good)
            detail = F.when(verdict == kind, said) if detail is None else detail.when(verdict == kind, said)
        name = lambda i: F.element_at(F.array(*[F.lit(c[i]) for c in self.checks]), F.col("check") + 1)
        return folded.select(name(0).alias(OUT[0]), name(1).alias(OUT[1]), F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias(OUT[2]), detail.alias(OUT[3]))
