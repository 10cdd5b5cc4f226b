import hashlib
import itertools
import random
import re

import pytest

from martline.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, present boolean, c string, t string, audit string, part string"
TEXTS = ["Yes.", "No!", "why", "", " \t", "Why?\n", "and. so", "é。", None]
ROLES = ["system", "user", "assistant", "tool", "sister", "", None]


def brute(rows):
    """The definition: every edit sequence of bounded cost, shortest cost first, then the least audit."""
    rows = [((r or "") if r is not None else " ", t if t is not None else " ") for r, t in rows]
    faults, seen = [], set()
    for role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = None

    def search(i, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        initials = "".join(r[:1] for r, _ in out)
        if not re.fullmatch(r"s?(ua)*u?", initials):
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", initials):
            found = (cost, audit, out)
            if best is None or found[:2] < best[:2]:
                best = found
        if i < len(rows):
            search(i + 1, cost + 2, audit + "D", out)
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if rows[i][0]:
                    search(i + 1, cost + more, audit + "K", [*out, rows[i]])
                for role in ("user", "assistant"):
                    search(i + 1, cost + more + 1, audit + "R", [*out, (role, rows[i][1])])
        if audit.count("I") < 4:
            for role in ("user", "assistant"):
                search(i, cost + 5, audit + "I", [*out, (role, "")])

    best = (2 * len(rows), "D" * len(rows), [])
    search(0, 0, "", [])
    text = "\n".join(f"{r}:{t}" for r, t in best[2])
    initials = [r[:1] for r, _ in rows]
    return (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            best[0], best[1], hashlib.sha256(text.encode()).hexdigest())


@pytest.fixture(scope="module")
def made():
    rng = random.Random(7)
    out = []
    for c in range(150):
        turn = 0
        for _ in range(rng.randrange(0, 7)):
            turn += rng.choice([0, 1, 1, 1, 2])
            weights = [2, 6, 6, 1, 1, 1, 1]
            out.append((c if c else None, rng.choice([turn] * 9 + [None]), rng.choices(ROLES, weights)[0], rng.choices(TEXTS, [9, 5, 3, 1, 1, 3, 1, 1, 1])[0], True))
    return out


def wanted(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for c, found in by.items():
        # nulls count as one space before the order is taken
        there = sorted((r for r in found if r[4]), key=lambda r: (r[1] is not None, r[1] or 0, r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " "))
        turns = [r[1] for r in there if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, *brute([(r[2], r[3]) for r in there]))
    return out


def run(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)
    return {r.conv_id: tuple(r)[1:] for r in repair.repair(df, present="present", **sizes).collect()}


@pytest.mark.parametrize("sizes", [{}, {"max_rows": 1}, {"max_rows": 2}, {"max_bytes": 3}])
def test_equals_every_edit_sequence(spark, made, sizes):
    assert run(spark, made, **sizes) == wanted(made)


def test_nothing_left_and_nothing_at_all(spark):
    empty = hashlib.sha256(b"").hexdigest()
    rows = [(5, 0, "user", "Hi.", False), (5, 3, "user", "Hi.", False), (6, 0, "user", "Hi.", False), (6, 2, "assistant", "So.", True)]
    got = run(spark, rows)
    assert got[5] == (0, 0, 0, 0, 0, 0, "", empty) and got == run(spark, rows, max_rows=1)
    assert run(spark, rows)[6][0] == 0
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_conversation_in_pieces(spark):
    rng = random.Random(3)
    rows = [(1, i // 2, rng.choice(ROLES[:4]), rng.choice([f"line {i % 50}.", f"open {i % 30}", f"Answer {i}!", " "]), rng.random() > 0.1) for i in range(900)]
    whole = run(spark, rows)
    assert whole == run(spark, rows, max_rows=40) == run(spark, rows, max_bytes=100)
    assert whole[1][4] > 0 and len(whole[1][6]) >= sum(r[4] for r in rows)


def test_same_rows_over_many_pieces(spark):
    rows = [(1, None, "user", "Same.", True)] * 300 + [(1, 1, "assistant", "End.", True)]
    assert run(spark, rows, max_rows=10) == run(spark, rows)
    assert run(spark, rows)[1][2] == 299


def test_weights_of_one_item_never_begin_each_other():
    # the order of equal costs survives more edits only then
    rows = [repair.Row(r, f) for r, f in itertools.product("sua", (None, "truncated", "blank"))]
    found = repair.derive(rows, repair.START, (repair.USER, repair.ASSISTANT, repair.START, repair.SYSTEM), every=True)
    for a, b in itertools.permutations(found.values(), 2):
        assert a[0] != b[0] or not b[1].startswith(a[1])


def test_query_reads_every_conversation(spark):
    path = "/root/testdata/sf0.001"
    rows = queries.op13_conversation_repair(spark, path)
    assert rows.count() == queries.conversations(spark, path).select("conv_id").distinct().count()
