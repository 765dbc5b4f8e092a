"""Roles by Viterbi: against enumeration of all paths, across blocks, held-out accuracy, odd rows."""

import itertools
import random

import numpy as np
import pytest

from skygrain.llm import chat, queries

SF = "/root/testdata/sf0.01"


def _model(seed=0):
    pick = np.random.default_rng(seed)
    logs = lambda *shape: np.log(pick.dirichlet(np.ones(shape[-1]), shape[:-1]))
    return chat.Model(logs(chat.STATES), logs(chat.STATES, chat.STATES), [logs(chat.STATES, n) for n in chat.SIZES])


def _path(model, lines, states):
    scores = model.scores(lines)
    return model.start[states[0]] + sum(model.move[a, b] for a, b in zip(states, states[1:])) + sum(scores[k, s] for k, s in enumerate(states))


def test_viterbi_is_the_best_path():
    lines = ["User: hi?", "and more", "AI: Yes.", "", "x"]
    for seed in range(4):
        model = _model(seed)
        best = max(itertools.product(range(chat.STATES), repeat=len(lines)), key=lambda p: _path(model, lines, p))
        assert tuple(model.viterbi(lines)) == best
        first = model.transfer(lines[:2], True)[0]
        whole = (first[:, None] + model.transfer(lines[2:], False)).max()
        assert whole == pytest.approx(_path(model, lines, best))


def test_markers():
    for line, role in (("User: x", 0), ("**Assistant**: x", 1), ("### Response:", 1), ("[system] x", 2), ("<|user|> x", 0), ("Human: x", 0), ("q: x", 0),
                       ("Userland: x", 3), ("the user: x", 3), ("", 3), ("A fine day", 3)):
        assert chat.marker(line)[0] == role, line


def test_query_recovers_roles(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    truth = {(r.conv_id, r.line_no): r.role for r in chat.transcripts(table).filter("begins").collect()}
    found = {(r.conv_id, r.turn_line): r.role for r in queries.op3_chat(spark, SF).collect()}
    right = sum(found.get(k) == role for k, role in truth.items())
    assert right / len(truth) > 0.85 and right / len(found) > 0.85


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_give_the_same_turns(spark, monkeypatch, seed):
    pick = random.Random(seed)
    texts = ["User: hi there?", "Assistant: Well.", "and so on", "", "Human: and?", "more text here, a longer line of words.", "AI: no"]
    rows = [(7, n << 20, pick.choice(texts)) for n in range(60)] + [(8, n, "x") for n in range(3)] + [(None, n << 20, pick.choice(texts)) for n in range(30)]
    lines, model = spark.createDataFrame(rows, "conv_id long, line_no long, line string"), _model(seed)
    whole = sorted(map(str, chat.parse(lines, model).collect()))
    monkeypatch.setattr(chat, "BLOCK_LINES", 7)
    assert sorted(map(str, chat.parse(lines, model).collect())) == whole


def test_one_conversation_and_number_may_hold_a_third_of_the_lines(spark, monkeypatch):
    """Blocks have a bounded number of lines whatever their numbers, and the turns are those of one run."""
    pick, model = random.Random(5), _model(3)
    texts = ["User: hi there?", "Assistant: Well.", "and so on", "", "Human: and?", "AI: no"]
    rows = [(9, 0, pick.choice(texts)) for _ in range(200)] + [(None, None, pick.choice(texts)) for _ in range(60)] + [(k, n, pick.choice(texts)) for k in range(40) for n in range(9)]
    lines = spark.createDataFrame(rows, "conv_id long, line_no long, line string").repartition(7)
    whole = sorted(map(str, chat.parse(lines, model).collect()))
    monkeypatch.setattr(chat, "BLOCK_LINES", 16)
    numbered = chat._numbered(lines)
    largest = numbered.groupBy("conv", "block").count().agg({"count": "max"}).first()[0]
    assert largest == 16 and numbered.count() == len(rows)
    assert sorted(map(str, chat.parse(lines, model).collect())) == whole


def test_odd_rows(spark):
    turns = [(1, 0, "user", "Hello?"), (1, 1, "assistant", "Hi.\nHow are you"), (1, 2, "user", None), (2, 0, "tool", "x"), (2, 0, None, "y"),
             (None, None, "user", "z"), (3, 0, "user", ""), (3, 0, "user", ""), (4, 0, "user", "w " * 100_000)]
    frame = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, line string")
    lines = chat.transcripts(frame)
    found = chat.parse(lines, chat.learn(lines)).collect()
    assert sum(r.n_lines for r in found) == lines.count()
    assert {r.conv_id for r in found} == {1, 2, 3, 4, None}
    assert all(r.rendered.startswith(f"<|im_start|>{r.role}\n") and r.rendered.endswith("<|im_end|>\n") for r in found)
    one = [r.rendered for r in sorted((r for r in found if r.conv_id == 1), key=lambda r: r.turn_line)]
    assert one[0] == "<|im_start|>user\nHello?<|im_end|>\n" or "Hello?" in one[0]
    empty = lines.limit(0)
    assert chat.parse(empty, chat.learn(empty)).count() == 0 and chat.parse(lines, chat.learn(empty)).count() > 0
