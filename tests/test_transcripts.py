"""Transcript assembly: roles, empty text, order across parts, system message first, hot conversations."""

from __future__ import annotations

from orderscope.operators import transcripts as T

SCHEMA = "conv_id long, turn long, role string, text string"


def test_turns_keep_user_and_assistant_with_text(spark):
    df = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", ""), (1, 2, "user", "hola"),
                                (1, 3, "assistant", None), (1, 4, "assistant", "ok"), (1, 5, "tool", "x")], SCHEMA)
    assert [(r["turn"], r["role"]) for r in T.transcript_turns(df).orderBy("turn").collect()] == \
        [(2, "user"), (4, "assistant")]


def test_parts_follow_each_other_and_begin_with_the_system_message(spark):
    n = T.PART * 2 + 17
    data = [(7, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in reversed(range(n))]
    data += [(8, 0, "system", "only system")]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    out = {(r["conv_id"], r["parte"]): r for r in T.transcript_text(df, "hola").collect()}
    assert set(out) == {(7, 0), (7, 1), (7, 2), (8, 0)}
    assert [out[7, p]["n_mensajes"] for p in range(3)] == [T.PART, T.PART, 18]
    lines = "\n".join(out[7, p]["transcript"] for p in range(3)).split("\n")
    assert lines == ["system: hola"] + [f"{'user' if t % 2 == 0 else 'assistant'}: m{t}" for t in range(n)]
    assert out[8, 0]["transcript"] == "system: hola" and out[8, 0]["n_mensajes"] == 1


def test_hot_conversation_with_repeated_turn_numbers(spark):
    """A third of all turns in one conversation, every turn number twice, one null conversation."""
    hot = [(1, t // 2, "user", f"h{t:05d}") for t in range(3000)]
    cold = [(2 + t % 600, t // 600, "assistant", f"c{t}") for t in range(6000)]
    df = spark.createDataFrame(hot + cold + [(None, 0, "user", "n")], SCHEMA).repartition(6)
    parts = T.transcript_text(df, "s", part=100).collect()
    assert max(r["n_mensajes"] for r in parts) == 100
    mine = sorted((r for r in parts if r["conv_id"] == 1), key=lambda r: r["parte"])
    assert [r["parte"] for r in mine] == list(range(31))
    lines = "\n".join(r["transcript"] for r in mine).split("\n")
    assert lines == ["system: s"] + [f"user: h{t:05d}" for t in range(3000)]
    assert sum(r["n_mensajes"] for r in parts) == 9001 + 602
    assert [r["transcript"] for r in parts if r["conv_id"] is None] == ["system: s\nuser: n"]


def test_positions_need_no_join_by_conversation(spark):
    """Half of all turns in one conversation, over many tasks, with adaptive execution off."""
    from .test_plans import plan
    data = [(5, t, "user", f"t{t}") for t in range(4000)] + [(t % 50, t, "assistant", f"u{t}") for t in range(4000) if t % 50 != 5]
    df = spark.createDataFrame(data, SCHEMA).repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        messages = T.transcript_messages(df, "s")
        text = plan(messages)
        assert "conv_id" not in "".join(line for line in text.splitlines() if "keys" in line or "hashpartitioning" in line)
        spread = messages.filter("conv_id = 5").rdd.glom().map(len).filter(lambda n: n > 0).collect()
        got = messages.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(spread) >= 3 and max(spread) < 3000
    by_conv = {}
    for r in got:
        by_conv.setdefault(r["conv_id"], []).append(r)
    assert len(by_conv) == 50
    for conv, mine in by_conv.items():
        mine.sort(key=lambda r: r["posicion"])
        assert [r["posicion"] for r in mine] == list(range(len(mine))) and mine[0]["role"] == "system"
        turns = sorted((t, x) for c, t, _, x in data if c == conv)
        assert [r["text"] for r in mine[1:]] == [x for _, x in turns]


def test_no_messages(spark):
    assert T.transcript_messages(spark.createDataFrame([], SCHEMA)).collect() == []
