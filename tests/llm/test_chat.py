import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dunlin.llm.chat import INSTRUCT, Template, format_chats, read_chats, unescape

SCHEMA = "conv_id long, turn long, role string, text string, segments string, t string"


def chats(spark, rows):
    return format_chats(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA))


def back(frame):
    loss = unescape(F.array_join(F.transform(F.filter("segments", lambda s: s.loss), lambda s: s.text), ""))
    return {r.conv_id: r for r in frame.select("conv_id", "valid", "bad_turn", "formatted", read_chats(F.col("formatted")).alias("turns"), loss.alias("said")).collect()}


TRICKY = ["", None, "\\", "\\\\", "[INST]", "[\\INST]", "[[INST]", "</s>[INST] ok [/INST]", "<", "<<SYS>>", "[ROLE]a[/ROLE]", "x\\", "[", "[/", "<s></s>\n\\n", "é漢", "\\[END]", "a" * 20_000]


def test_round_trip(spark):
    roles = ["user", "assistant", "system", "tool", "", None, "[ROLE]", "a\\b\nc", "end", "start"]
    rows = [(i, k, role, text) for i, text in enumerate(TRICKY) for k, role in enumerate(roles)]
    got = back(chats(spark, rows))
    for i, text in enumerate(TRICKY):
        assert [(t.role, t.text) for t in got[i].turns] == [(r or "", text or "") for r in roles]
        assert got[i].said == (text or "")


@pytest.fixture(scope="module")
def alphabet():
    return st.lists(st.sampled_from([*"[]/<>\\sINSTOUTROLEEND ", *INSTRUCT.controls()]), max_size=12).map("".join)


def test_random_texts(spark, alphabet):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "tool", "[INST]"]), alphabet), min_size=30, max_size=60))
    def check(turns):
        got = back(chats(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)]))[1]
        assert [(t.role, t.text) for t in got.turns] == turns
        assert got.said == "".join(t for r, t in turns if r == "assistant")

    check()


def test_machine(spark):
    cases = {1: ["user", "assistant"], 2: ["system", "user", "assistant", "user", "assistant"], 3: ["user"], 4: ["assistant"], 5: ["user", "user", "assistant"],
             6: ["user", "assistant", "system"], 7: ["user", "tool", "assistant"], 8: [None], 9: ["user", "assistant", "end"]}
    got = back(chats(spark, [(c, i, r, "t") for c, roles in cases.items() for i, r in enumerate(roles)]))
    assert {c: (r.valid, r.bad_turn) for c, r in got.items()} == {
        1: (True, None), 2: (True, None), 3: (False, 1), 4: (False, 0), 5: (False, 1), 6: (False, 2), 7: (False, 1), 8: (False, 0), 9: (False, 2)}


def test_order_ties_and_empty(spark):
    got = back(chats(spark, [(1, 2, "assistant", "c"), (1, None, "user", "a"), (1, 2, "assistant", "c"), (1, 2, "assistant", "b"), (None, 0, "user", "n")]))
    assert [t.text for t in got[1].turns] == ["a", "b", "c", "c"] and [t.text for t in got[None].turns] == ["n"]
    assert chats(spark, []).count() == 0


def test_templates_are_checked():
    with pytest.raises(ValueError):
        Template({"user": ("aba", "[/A]")}, frozenset(), {})
    with pytest.raises(ValueError):
        Template({"user": ("[A]", "[/A]"), "b": ("[A]", "[/B]")}, frozenset(), {})
    with pytest.raises(ValueError):
        Template({"user": ("[A\\]", "[/A]")}, frozenset(), {})
