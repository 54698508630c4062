from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assetlife.llm import chat
from assetlife.llm.queries import TOKENIZER

SCHEMA = "conv_id long, turn long, role string, text string, piece string, ids int"


def expected(rows):
    """Digests by plain loops; rows of one conversation in order."""
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA)
    out = chat.read_back(chat.format_conversations(frame, TOKENIZER)).collect()
    assert len(out) == len({r["conv_id"] for r in out})
    return {r["conv_id"]: tuple(r)[1:5] for r in out}


pieces = st.lists(st.one_of(st.sampled_from([*chat.CONTROL, chat.JOINER, "<", "|", "[", "/", ">"]), st.text(max_size=4)), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_escape_is_reversible_and_hides_control_strings(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROL)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a|b"]), pieces), max_size=6))
def test_render_reads_back(turns):
    text, spans = chat.render(turns)
    assert chat.read_turns(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans.tolist()] == [t for r, t in turns if r == "assistant"]


def test_mask_meets_spans_by_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        cuts = sorted(rng.sample(range(1, 60), rng.randint(1, 20)))
        offsets = np.array(list(zip([0, *cuts], [*cuts, 60])))
        edges = sorted(rng.sample(range(61), 2 * rng.randint(0, 4)))
        spans = np.array(list(zip(edges[::2], edges[1::2])), np.int64).reshape(-1, 2)
        want = [any(a < y and x < b for x, y in spans.tolist()) for a, b in offsets.tolist()]
        assert chat.loss_mask(offsets, spans).tolist() == want


def test_digests(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "日本 \U0001F600 é"), (1, 2, "assistant", "  ça va? \U0001F600日\n"), (1, 3, "assistant", ""), (1, 4, "assistant", "x<|end|>y" + chat.JOINER),
            (2, 0, "user", None), (2, 1, "assistant", None), (3, 5, None, "a"), (3, None, "assistant", "first"), (-1, 0, "user", said), (-1, 1, "assistant", said),
            (4, 0, "assistant", "twice"), (4, 0, "assistant", "twice"), (None, 0, "assistant", "no id"), (5, 0, "user", "w " * 300_000), (5, 1, "assistant", "é" * 100_000)]
    got = run(spark, rows)
    groups: dict = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        groups.setdefault(c, []).append((r, x))
    assert got == {c: expected(v) for c, v in groups.items()}
    assert run(spark, []) == {}


def test_long_conversations_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_CHARS", 40)
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i} says é{i}") for i in range(200)] + [(8, 0, "assistant", "z")]
    frame = spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA)
    out = chat.format_conversations(frame, TOKENIZER)
    assert out.where("conv_id = 7").count() > 20
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(out).collect()}
    assert got == {7: expected([(r, t) for c, _, r, t in rows if c == 7]), 8: expected([("assistant", "z")])}


def test_marks_are_single_tokens():
    with open(TOKENIZER, encoding="utf-8") as f:
        t = chat._tokenizer(f.read())
    text, _ = chat.render([("assistant", "a"), ("user", chat.END)])
    ids = t.encode(text, add_special_tokens=False).ids
    for mark in (chat.TURN, chat.TEXT, chat.END):
        assert ids.count(t.token_to_id(mark)) == 2


@pytest.mark.parametrize("offsets,mask,want", [([(0, 1), (1, 2), (1, 2), (2, 3)], [0, 1, 1, 0], "b"), ([(0, 2), (2, 3)], [1, 1], "abc"), ([(0, 1), (1, 2), (2, 3)], [1, 0, 1], "ac")])
def test_masked_text(offsets, mask, want):
    assert chat.masked_text("abc", np.array(offsets), np.array(mask, bool)) == want
