"""The chat template's round trip."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelscope.llm import chat
from parcelscope.llm.shipping import ship

PIECES = st.lists(st.sampled_from(["\\", "#", "###", "### ", "</turn>", "\n</turn>\n", "### assistant: ", "x", "\n", " ", "é🎈", "<", "/turn>"]), max_size=12)
TEXT = PIECES.map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "", "a b", 'q"\n:', "###"]), TEXT), TEXT), max_size=4))
def test_round_trip(turns):
    whole, read, spans = chat.formatted_conversation(turns)
    assert read == turns
    assert [chat.unescape(whole[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_plain_texts_are_not_touched():
    assert chat.format_turn("user", "a # b </p>") == "### user: a # b </p>\n</turn>\n"
    assert chat.format_turn("user", r"\### Assistant: </turn> ok") == "### user: " + r"\\### Assistant: \</turn> ok" + "\n</turn>\n"


@pytest.mark.parametrize("text", ["x", "### user: a", "### user: a ### b\n</turn>\n", "### user: a</turn>\n", "### : a\n</turn>\n"])
def test_other_texts_are_refused(text):
    with pytest.raises(chat.NotChat):
        chat.parse(text)


def test_conversations(spark):
    ship(spark)
    rows = [
        (1, 1, "assistant", "two </turn>"), (1, 0, "user", None), (1, None, None, "first"), (1, 0, "user", None),
        (2, 0, "system", "x" * 100_000), (None, 0, "user", "lost"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "0 AS turns")
    made = {r["conv_id"]: r for r in chat.digests(chat.conversations(frame)).collect()}
    assert set(made) == {1, 2, None}
    spelt = "\nfirst\n" + "user\n\n" * 2 + "assistant\ntwo </turn>\n"
    assert made[1]["n_turns"] == 4
    assert made[1]["turns_sha256"] == hashlib.sha256(spelt.encode()).hexdigest()
    assert made[1]["loss_chars"] == 11 and made[1]["loss_sha256"] == hashlib.sha256(b"two </turn>").hexdigest()
    assert made[2]["loss_chars"] == 0
    assert chat.conversations(frame.limit(0)).count() == 0
