"""Chat transcript assembly as table jobs.

H1 ``transcript_turns``: the turns a chat model is shown (user and assistant
turns with non-empty text). A filter only; the ``turn`` column carries the
order.

H2 ``transcript_messages``: the message list of every conversation as rows,
a fixed system message at position 0, then the kept turns in turn order
(turns that repeat a number are ordered by their line). Positions come from
one distributed sort of all messages and what each of its partitions carries
over to the next (``ranks.numbered_in_groups``), not from a window over a
conversation or a join by it, so a conversation with a third of all turns is
dealt over many tasks.

``transcript_text``: the same list as text, in parts of at most ``PART``
messages with a part number, so no value and no group grows with a
conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderscope.operators.ranks import numbered_in_groups

# The roles a chat model is shown, besides the system message.
CHAT_ROLES = ["user", "assistant"]
SYSTEM_MESSAGE = "Analista de ventas: responde con las cifras de los reportes."
PART = 256


def _kept() -> Column:
    text = F.col("text")
    return F.col("role").isin(CHAT_ROLES) & text.isNotNull() & (text != F.lit(""))


def transcript_turns(conversations: DataFrame) -> DataFrame:
    """H1: user / assistant turns with content (conv_id, turn, role, text)."""
    return conversations.filter(_kept()).select("conv_id", "turn", "role", "text")


def transcript_messages(conversations: DataFrame, system_message: str = SYSTEM_MESSAGE) -> DataFrame:
    """H2: rows ``conv_id, posicion, role, text``; position 0 is the system message."""
    first = conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("system").alias("role"),
        F.lit(system_message).alias("text"))
    turns = transcript_turns(conversations).select("conv_id", F.lit(1).alias("_kind"), F.col("turn").cast("bigint"), "role", "text")
    return numbered_in_groups(first.unionByName(turns), F.col("_kind") == 0, "conv_id", "_kind", "turn", "role", "text", label="posicion") \
        .select("conv_id", "posicion", "role", "text")


def transcript_text(conversations: DataFrame, system_message: str = SYSTEM_MESSAGE, part: int = PART) -> DataFrame:
    """H2 as text: rows ``conv_id, parte, n_mensajes, transcript``, at most ``part`` messages each."""
    messages = transcript_messages(conversations, system_message)
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    joined = F.transform(F.array_sort(F.collect_list(F.struct("posicion", line.alias("line")))), lambda x: x["line"])
    return messages.groupBy("conv_id", F.expr(f"posicion div {int(part)}").alias("parte")).agg(
        F.count(F.lit(1)).alias("n_mensajes"), F.array_join(joined, "\n").alias("transcript"))
