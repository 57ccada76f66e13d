from __future__ import annotations

from hashlib import sha256

import pytest
from hypothesis import given as random_case
from hypothesis import settings
from hypothesis import strategies as st
from names import CLASHING
from pyspark.sql import functions as F

from mixlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "[", "<", "]", "[\\INST]", "<\\\\s>", "[ROLE]", "[TEXT]", "[/TURN]", "é\n", "INST]", "s>"]


def digest(spark, rows):
    return {r.conv_id: r for r in chat.digests(chat.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()}


def want(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    all_turns = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), sha256(all_turns.encode()).hexdigest(), len(said), sha256(said.encode()).hexdigest()


@settings(max_examples=8, deadline=None)
@random_case(
    st.lists(
        st.lists(
            st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[INST]"]), st.lists(st.sampled_from(PIECES), max_size=6)),
            min_size=1, max_size=6,
        ),
        min_size=1, max_size=12,
    )
)
def test_round_trip(spark, conversations):
    rows = [(c, i, r, "".join(t)) for c, turns in enumerate(conversations) for i, (r, t) in enumerate(turns)]
    got = digest(spark, rows)
    for c, turns in enumerate(conversations):
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want([(a, "".join(t)) for a, t in turns])


def test_no_control_string_of_a_text_is_left(spark):
    df = spark.createDataFrame([("".join(PIECES) * 2,)], "t string").select(chat.escape(F.col("t")).alias("e"))
    assert not any(c in df.first().e for c in chat.INSTRUCT.controls())


@pytest.mark.parametrize(
    ("roles", "fault"),
    [
        ("user assistant", None),
        ("system user assistant user assistant", None),
        ("assistant user", 0),
        ("user user assistant", 1),
        ("user assistant system", 2),
        ("user assistant user", 3),
        ("user tool assistant", 1),
    ],
)
def test_turn_order(spark, roles, fault):
    rows = [(5, i, r, "x") for i, r in enumerate(roles.split())]
    got = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    assert got.first_fault == fault
    assert "".join(s.text for s in got.segments) == got.formatted
    assert [s.text for s in got.segments if s.loss] == ["x"] * roles.split().count("assistant")


def test_edges(spark):
    got = digest(spark, [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, "assistant", "")])
    assert (got[1].n_turns, got[1].turns_sha256) == want([("", ""), ("user", "a"), ("user", "a"), ("user", "b")])[:2]
    assert got[None].n_turns == 1 and got[None].loss_chars == 0
    assert digest(spark, []) == {}
    df = spark.createDataFrame([(1, 0, "user", "y" * 200_000), (1, 1, "assistant", "[/INST]" * 5000)], SCHEMA)
    for name in CLASHING:
        df = df.withColumn(name, F.lit(1))
    r = chat.digests(chat.format_conversations(df)).first()
    assert (r.loss_chars, r.first_fault) == (35000, None)
    assert r.turns_sha256 == want([("user", "y" * 200_000), ("assistant", "[/INST]" * 5000)])[1]
