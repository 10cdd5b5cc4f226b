import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martline.llm import chat, queries

PATH = queries.BPE_VOCABULARY
TEMPLATE = chat.Template(chat.special_tokens(PATH))
SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, whole string, part string, c string, loss_spans int"
EXTRA = ("clash", "clash", "clash", "clash", 7)
BITS = ["</s>", "[INST]", "[/INST]", "<s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "<|endoftext|>", "\\", "<", "<<", "[", "/", " ", "\n", "é", "日", "🙂", "a", "s>", "x y"]
texts = st.lists(st.sampled_from(BITS), max_size=12).map("".join)


@pytest.fixture(scope="module")
def rows(spark):
    made = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi \\ [INST]"), (1, 2, "assistant", "</s>日本🙂 <|endoftext|>"), (1, 3, "user", None), (1, 4, "assistant", ""),
            (2, None, "assistant", " lead"), (2, 1, None, "x"), (2, 1, "tool", "y"), (2, 1, "tool", "y"), (2, 0, "ROLE][/ROLE]", ""), (None, 0, "assistant", "\n\n"),
            (3, 0, "assistant", "word " * 40_000 + "é" * 70_000)] + [(4, i, ("user", "assistant")[i % 2], f"turn {i}\n") for i in range(200)]
    return spark.createDataFrame([(*r, *EXTRA) for r in made], SCHEMA).repartition(4)


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role is not None, r.role or "", r.text is not None, r.text or ""))
    out = {}
    for c, found in by.items():
        found = [(x[3], x[5]) for x in sorted(found)]
        learned = "".join(t for r, t in found if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(found), digest("".join(f"{r}\n{t}\n" for r, t in found)), len(learned), digest(learned), len(TEMPLATE.render(found)[0]))
    return out


@pytest.mark.parametrize("sizes", [{}, {"max_rows": 7}, {"max_rows": 1, "max_bytes": 1}])
def test_read_back(rows, sizes):
    formatted = chat.format_conversations(rows, PATH, **sizes)
    got = {r[0]: tuple(r)[1:] for r in chat.read_back(formatted, PATH).collect()}
    assert got == expected(rows.collect())
    if sizes:
        assert formatted.where("NOT whole").count() > 1


@pytest.mark.parametrize("max_rows", [2_000, 3])
def test_tokens_are_those_of_the_whole_text(rows, max_rows):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    by = {}
    for r in chat.format_conversations(rows, PATH, max_rows=max_rows).collect():
        by.setdefault(r.conv_id, []).append(r)
    for pieces in by.values():
        pieces.sort(key=lambda r: (r.part, r.piece))
        text = "".join(r.formatted for r in pieces)
        want = library.encode(text, add_special_tokens=False)
        assert [i for r in pieces for i in r.ids] == want.ids
        base, offsets = 0, []
        for r in pieces:
            offsets += [(s + base, e + base) for s, e in zip(r.token_starts, r.token_ends)]
            base += len(r.formatted)
        assert offsets == want.offsets


def test_empty(spark, rows):
    assert chat.read_back(chat.format_conversations(rows.limit(0), PATH), PATH).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "tool", "[ROLE]", "</s>"]), texts), max_size=5))
def test_template_is_reversible_and_marks_stand_alone(turns):
    formatted, spans = TEMPLATE.render(turns)
    assert TEMPLATE.read(formatted) == turns
    for (role, text), (_, lo, hi) in zip(turns, spans):
        body = formatted[lo:hi]
        assert TEMPLATE.unescape(body) == text
        assert not any(c in body for c in (*chat.CONTROLS, "<|endoftext|>"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), texts), min_size=1, max_size=5))
def test_mask_covers_the_answers_only(turns):
    encoder, lengths, _ = chat._tools(PATH)
    formatted, spans = TEMPLATE.render(turns)
    _, starts, ends = chat.encode(encoder, lengths, formatted)
    wanted = [(lo, hi) for role, lo, hi in spans if role == "assistant"]
    mask, shared = chat.intersect(starts, ends, wanted)
    assert shared == [s for s in wanted if s[1] > s[0]]
    inside = np.zeros(len(formatted) + 1, dtype=bool)
    for lo, hi in wanted:
        inside[lo:hi] = True
    assert [bool(inside[s:e].any()) for s, e in zip(starts, ends)] == mask.tolist()
