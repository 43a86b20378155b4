"""Chat formatting: every assistant turn becomes a training example.

A turn reads ``### role: text</turn>`` and a newline.  Inside roles and texts
``\\``, ``<``, ``#`` (and ``:`` in roles) are written as a backslash and a
letter, so a control string in a text is never one in the output, and
:func:`read_turns` gives back every character.

Each assistant turn is expanded into its own example: all turns before it as
context, and only its reply trainable.  Turns after the last reply, or a
conversation without any, give one more example with nothing trainable, so no
turn is lost.  Everything is built-in column functions.

NULL texts and roles count as empty, a NULL ``conv_id`` is a conversation of
its own, turns with equal numbers go by role, then text, repeated rows stay, an
empty table gives no example, and other columns are ignored.  A conversation
is one training text, so its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

END = "</turn>\n"
# What stands for each character that control strings are made of.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))


def escape(text: Column, more: tuple = ()) -> Column:
    for raw, written in (*ESCAPES, *more):
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column, more: tuple = ()) -> Column:
    for raw, written in reversed((*ESCAPES, *more)):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


COLON = ((":", "\\c"),)


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("### "), escape(role, COLON), F.lit(": "), escape(text), F.lit(END))


def prefix_targets(conversations: DataFrame, assistant: str = "assistant") -> DataFrame:
    """One row per example of ``(conv_id, turn, role, text)`` rows.

    ``example`` counts from 1, ``context`` holds the formatted turns before the
    reply, ``formatted`` those and the reply; characters ``loss_start`` (from
    0) to ``loss_start + loss_chars`` of it are trainable.  ``last`` marks the
    example that ends with the conversation's last turn.
    """
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    listed = turns.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == assistant).alias("replies"),
        F.transform("turns", lambda t: format_turn(t["role"], t["text"])).alias("lines"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("lengths"),
        F.size("turns").alias("n"),
    )
    # Places of replies, and the last place if no reply stands there.
    ends = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: F.element_at("replies", i.cast("int")) | (i == F.col("n")))
    rows = listed.select("*", F.posexplode(ends).alias("example", "place"))
    reply = F.element_at("replies", F.col("place"))
    loss = F.when(reply, F.element_at("lengths", F.col("place"))).otherwise(0)
    context = F.array_join(F.slice("lines", F.lit(1), F.col("place") - 1), "")
    formatted = F.array_join(F.slice("lines", F.lit(1), F.col("place")), "")
    return rows.select(
        "conv_id", (F.col("example") + 1).alias("example"), context.alias("context"), formatted.alias("formatted"),
        (F.length(formatted) - len(END) - loss).cast("long").alias("loss_start"), loss.cast("long").alias("loss_chars"),
        (F.col("place") == F.col("n")).alias("last"))


def read_turns(formatted: Column) -> Column:
    """The ``(role, text)`` turns of a formatted text, unescaped."""
    lines = F.filter(F.split(formatted, END), lambda line: line != "")
    return F.transform(lines, lambda line: F.struct(
        unescape(F.substring_index(F.substring(line, 5, 1 << 30), ": ", 1), COLON).alias("role"),
        unescape(F.substring(line, F.instr(line, ": ") + 2, F.lit(1 << 30))).alias("text")))


def loss_text(formatted: Column, start: Column, chars: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescape(F.substring(formatted, (start + 1).cast("int"), chars.cast("int")))
