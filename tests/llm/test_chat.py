from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.llm import chat

PIECES = st.lists(st.sampled_from(["&", "&lt;", "&amp;", "<|", "|>", "<", "</s>", "[INST]", "[/INST]", "<|end|>",
                                   "<|text|>", "<<SYS>>", "a", "\n", "é", "&#91;"]), max_size=8).map("".join)


def test_escape_is_reversible(spark):
    seen = []

    @settings(max_examples=300, deadline=None)
    @given(PIECES)
    def gather(s):
        seen.append((s,))
    gather()
    df = spark.createDataFrame(seen, "s string").withColumn("e", chat.escape(F.col("s")))
    assert df.filter(chat.unescape(F.col("e")) != F.col("s")).count() == 0
    for mark in ("<|", *chat.GUARDED):
        assert df.filter(F.col("e").contains(mark)).count() == 0


def test_expand_and_read_back(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "A [/INST] &amp;"), (1, 2, "user", "more"),
            (1, 3, "assistant", "B"), (1, 4, "user", "bye"),
            (2, 0, "user", "alone"), (3, 0, "assistant", None), (4, 0, None, "x"), (4, 0, None, "x"),
            (None, 0, "assistant", "no id"), (5, None, "assistant", "first"), (5, 0, "assistant", "<|end|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "turns", F.lit("clash")).withColumn("formatted", F.lit(1))
    ex = chat.expand(df)
    got = {}
    for r in ex.collect():
        part = None if r["loss_start"] is None else r["formatted"][r["loss_start"]:r["loss_start"] + r["loss_length"]]
        got.setdefault(r["conv_id"], {})[r["example"]] = (part, r["is_last"])
    assert len(got[1]) == 3 and got[1][2] == (None, True) and got[1][1] == ("B", False)
    assert got[2] == {0: (None, True)} and got[3] == {0: ("", True)}
    back = {r["conv_id"]: r for r in chat.read_back(ex).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [(r[2], r[3]) for r in rows[:5]]
    assert back[1]["loss_text"] == "A [/INST] &amp;B"
    assert [tuple(t) for t in back[4]["turns"]] == [("", "x"), ("", "x")] and back[4]["loss_text"] == ""
    assert back[None]["loss_text"] == "no id" and back[5]["loss_text"] == "first<|end|>"
    # every example holds all turns before its reply
    for r in ex.filter("conv_id = 1").collect():
        assert r["formatted"].count("<|turn|>") == {0: 2, 1: 4, 2: 5}[r["example"]]


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.expand(df)).count() == 0


def test_native_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.read_back(chat.expand(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1
