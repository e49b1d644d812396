"""Rendering from a window is proved against the whole conversation."""

import sys

import pytest
from pyspark import cloudpickle

from quarryline.llm import chat_format as cf

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't import tests


def numbered(turns):
    return "".join(f"<{i}:{role}>{text}</>" for i, (role, text) in enumerate(turns))


def read_numbered(span):
    role, text = span.split(":", 1)[1].split(">", 1)
    return [(role, text.removesuffix("</>"))]


def looks_far_back(turns):
    """Appends only, until turn 700, whose rendering tells the first turn's text."""
    return "".join(f"[{role}|{turns[0][1] if i == 700 else ''}|{text}]" for i, (role, text) in enumerate(turns))


@pytest.fixture(scope="module")
def chats(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"say {t} <x>") for t in range(1100)] + [(2, t, "assistant", f"{t}") for t in range(40)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_a_window_is_proved_by_the_whole_rendering(chats):
    want = {c: [(r["role"], r["text"]) for r in chats.where(f"conv_id = {c}").orderBy("turn").collect()] for c in (1, 2)}
    got = {r["conv_id"]: r for r in cf.format_chats(chats, window=64).collect()}
    assert got[1]["n_cut"] == 1100 - 64 and got[2]["n_cut"] == 0
    for c, r in got.items():
        assert r["is_whole"] and r["formatted"] == cf.marked_turns(want[c]) and cf.read_marked(r["formatted"]) == want[c]


@pytest.mark.parametrize("template,read", [(numbered, read_numbered), (looks_far_back, lambda s: [(s[1:].split("|")[0], s.rsplit("|", 1)[1][:-1])])])
def test_a_template_that_looks_back_is_found_out_and_rendered_whole(chats, template, read):
    got = {r["conv_id"]: r for r in cf.format_chats(chats, template, read, lambda t: t, window=64, append_only=True).collect()}
    whole = {r["conv_id"]: r for r in cf.format_chats(chats, template, read, lambda t: t, append_only=False).collect()}
    assert got == whole and got[1]["n_cut"] == 0 and got[1]["is_whole"] and got[1]["n_rewrites"] == 0 and got[1]["n_turns"] == 1100


def test_a_template_that_rewrites_history_is_no_whole(chats):
    marks_last = lambda turns: "".join(f"[{r}{'*' if i == len(turns) - 1 else ''}:{t}]" for i, (r, t) in enumerate(turns))
    got = cf.format_chats(chats.where("conv_id = 2"), marks_last, lambda s: [], lambda t: t).first()
    assert got["n_rewrites"] == 39 and not got["is_whole"]
