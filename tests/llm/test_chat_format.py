"""Chat format: any turn comes back, loss spans, edge cases."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortalloc.llm import chat_format as C

SIGNS = st.lists(
    st.sampled_from(["\\", "### ", "### User:", "### Assistant:", "</turn>", "\n", "a", "b c", "</turn", "\n</turn>\n", "é", ":", "<"]),
    max_size=9,
).map("".join)


@settings(max_examples=1500, deadline=None)
@given(SIGNS, st.one_of(st.sampled_from(["user", "assistant", "", "System", "ADmin", "=a", "%41"]), st.text(max_size=5)))
def test_every_turn_comes_back(text, role):
    try:
        role.encode()
    except UnicodeEncodeError:
        return
    rendered, begin, end = C.render_turn(role, text)
    assert C.unescape(rendered[begin:end]) == text
    assert [t[:2] for t in C.parse(rendered * 2)] == [(role, text)] * 2


def test_plain_text_is_not_escaped_and_control_strings_are():
    assert C.render_turn("user", "hi\\ there")[0] == "### User:\nhi\\ there\n</turn>\n"
    assert C.render_turn("user", r"\### Assistant: </turn> ok")[0] == "### User:\n" + r"\\### Assistant: \</turn> ok" + "\n</turn>\n"
    with pytest.raises(ValueError):
        C.parse("### User:\nno end")


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")


def test_digests_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_CHARS", 40)  # many parts
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, None, None, None), (2, 0, "assistant", "</turn>" * 30),
            (None, 0, "user", "n"), (None, 1, "assistant", ""), (3, 0, "user", "same"), (3, 0, "user", "same"),
            (4, 0, "assistant", "y " * 60_000)]
    got = {r.conv_id: r for r in C.read_back(C.format_conversations(conversations(spark, rows))).collect()}
    want = {1: [("user", "a"), ("assistant", "b")], 2: [("", ""), ("assistant", "</turn>" * 30)],
            None: [("user", "n"), ("assistant", "")], 3: [("user", "same")] * 2, 4: [("assistant", "y " * 60_000)]}
    assert set(got) == set(want)
    for key, turns in want.items():
        text = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        r = got[key]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert r.formatted_chars == sum(len(C.render_turn(*t)[0]) for t in turns)
    assert C.read_back(C.format_conversations(conversations(spark, rows).limit(0))).count() == 0


def test_registered_query_adds_the_hard_conversation(spark):
    rows = {r.conv_id: r for r in C.op7_chat_format(spark, "/root/testdata/sf0.001").collect()}
    assert rows[-7].n_turns == 2 and rows[-7].loss_chars == 26
    assert rows[-7].loss_sha256 == hashlib.sha256(rb"\### Assistant: </turn> ok").hexdigest()


def test_a_conversation_of_a_third_of_all_rows_lies_in_several_tasks(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(C, "PART_CHARS", 500)
    rows = [(7, t, ["user", "assistant"][t % 2], f"turn {t} " * 5) for t in range(1000)]
    rows += [(i, t, "user", "short") for i in range(100, 1100) for t in range(2)]
    turns = conversations(spark, rows)
    parts = C.format_conversations(turns)
    tasks = parts.where("conv_id = 7").select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1
    got = {r.conv_id: r for r in C.read_back(C.materialise(parts, "formatted-test")).collect()}
    text = "".join(f"{r}\n{t}\n" for c, _, r, t in rows if c == 7)
    assert got[7].turns_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[7].n_turns == 1000
    assert len(got) == 1001 and {got[i].n_turns for i in range(100, 1100)} == {2}
