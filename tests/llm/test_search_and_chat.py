"""Exact search and chat formatting against plain versions."""

import hashlib
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat, topk

VECTORS = "vec_id bigint, embedding array<float>, id string, rows string, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", 0.0) for i, v in rows], VECTORS)


def plain(rows, k=5, step=50):
    good = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    found = {}
    for i, v in good:
        if i is not None and i % step == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, w in good if j != i]
            found[i] = [(None if n else j, -s) for s, n, j in sorted(scores)[:k]]
    return found


def found(spark, rows, **more):
    got = {}
    for r in topk.top_inner_products(vectors(spark, rows), lambda i: i % 50 == 0, **more).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [(v, s) for _, v, s in sorted(rows)] for q, rows in got.items()}


def test_search_equals_all_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "GROUP", 4)
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 12))
    rows = [(i, (centers[i % 6] + 0.2 * rng.normal(size=12)).astype(float).tolist()) for i in range(900)]
    rows += [(900 + i, rows[3][1]) for i in range(300)]  # a third are copies of one vector
    rows += [(5000, None), (5050, [float("nan")] * 12), (5100, [1.0, None] + [0.0] * 10), (5150, [float("inf")] * 12), (5200, [0.5, 1.0]), (5250, []), (None, rows[0][1]), (1350, [0.0] * 12)]
    assert found(spark, rows) == plain(rows)


def test_search_of_small_and_extreme_tables(spark):
    assert found(spark, []) == {}
    assert found(spark, [(0, None)]) == {}
    assert found(spark, [(0, [1.0])]) == {}
    rows = [(0, [1.0, -1.0]), (50, [1.0, -1.0]), (3, [2.0, 0.5])]
    assert found(spark, rows) == plain(rows)
    large = [(0, [2.0**18, 3.0]), (1, [2.0**18 + 0.25, 1.0]), (2, [2.0**18, 5.0]), (3, [-(2.0**18), 5.0])]
    assert found(spark, large) == plain(large)


def test_annuli_are_skipped(spark, monkeypatch):
    """Tight clusters: later rounds visit only what the bound lets through."""
    seen = []
    search = topk._search
    monkeypatch.setattr(topk, "_search", lambda visits, *a: (seen.append(visits.count()), search(visits, *a))[1])
    rng = np.random.default_rng(2)
    centers = 8 * np.eye(16)
    rows = [(i, (centers[i % 16] + 0.01 * rng.normal(size=16)).tolist()) for i in range(1600)]
    assert found(spark, rows) == plain(rows)
    assert sum(seen[1:]) < 0.5 * 16 * 256


TEXT = st.lists(st.sampled_from([*chat.CONTROL, "\\", "\n", "<", "|", "[", "é", "😀", "ok ", "n", "/s>", "im_end|>"]), max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=5))
def test_escapes_are_reversible(turns):
    text = "".join(f"{chat.BEGIN}{chat.escape_role(r)}\n{chat.escape(t)}{chat.END}\n" for r, t in turns)
    assert chat.parse_piece(text) == turns
    assert not any(c in chat.escape(t) for _, t in turns for c in chat.CONTROL)


def test_layouts_become_turns(spark):
    turns = [("user", "q"), ("assistant", "a")]
    same = [{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, {"conversations": [{"from": "human", "value": "q"}, {"value": "a", "from": "gpt"}]},
            {"prompt": "q", "response": "a"}, {"completion": "a", "prompt": "q"}, {"instruction": "q", "input": "", "output": "a"}, {"question": "q", "answer": "a"},
            {"system": None, "prompt": "q", "response": "a"}]
    rows = [(n, json.dumps(r)) for n, r in enumerate(same)]
    rows += [(20, json.dumps({"instruction": "q", "input": "more", "output": None})), (21, json.dumps({"messages": []})), (22, json.dumps({"turn": 4, "role": "user", "text": None}))]
    bad = [None, "no json", "[]", "3", json.dumps({"prompt": "q"}), json.dumps({"prompt": 3, "response": "a"}), json.dumps({"messages": [{"role": "user", "content": {"a": 1}}]}), json.dumps({"turn": "x", "role": "user", "text": "t"})]
    rows += [(30 + n, b) for n, b in enumerate(bad)]
    table = spark.createDataFrame([(i, r, "x", "x") for i, r in rows], "conv_id bigint, record string, key string, turn string")
    got = {}
    for r in chat.canonical_turns(table, "conv_id", "record").collect():
        got.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"], r["layout"]))
    for n in range(len(same)):
        assert [t[1:3] for t in sorted(got[n])] == turns
    assert [t[1:3] for t in sorted(got[20])] == [("user", "q\nmore"), ("assistant", "")]
    assert 21 not in got and got[22] == [(4, "user", "", "turn")]
    assert all(got[30 + n] == [(None, None, None, None)] for n in range(len(bad)))


def digest(conversation):
    said = "".join(t for r, t in conversation if r == "assistant")
    return (len(conversation), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in conversation).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())


def test_conversations_come_back(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 40)
    rng = random.Random(1)
    talks = {i: [(rng.choice(["user", "assistant", "tool\nx", ""]), rng.choice([*chat.CONTROL, "\\n", "", "😀 é\n"]) * rng.randint(0, 3)) for _ in range(rng.randint(1, 9))] for i in range(40)}
    talks[None] = [("user", "a"), ("assistant", "b")]
    talks[99] = [("assistant", "word " * 50_000)] + [("user", "</s>[INST] ok [/INST]")] * 400
    rows = [(i, n, r, t, "x") for i, talk in talks.items() for n, (r, t) in enumerate(talk)]
    rows += [(200, None, None, None, "x"), (200, 1, "assistant", "same", "x"), (200, 1, "assistant", "same", "x")]
    talks[200] = [("", ""), ("assistant", "same"), ("assistant", "same")]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, piece string")
    pieces = chat.format_turns(chat.canonical_turns(chat.turn_records(table), "conv_id", "record"), "conv_id")
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_conversations(pieces, "conv_id").collect()}
    assert got == {i: digest(t) for i, t in talks.items()}
    assert pieces.where("conv_id = 99").count() > 100
    empty = chat.format_turns(chat.canonical_turns(chat.turn_records(table.limit(0)), "conv_id", "record"), "conv_id")
    assert empty.count() == 0 and chat.read_conversations(empty, "conv_id").count() == 0


def test_damaged_text_is_refused():
    with pytest.raises(ValueError):
        chat.parse_piece(f"{chat.BEGIN}user\nhi")
