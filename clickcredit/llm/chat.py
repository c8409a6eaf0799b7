"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Each assistant turn of a conversation becomes one example: all preceding
turns are its context and only that reply is trainable. A turn is written as

    <|im_start|>ROLE NEWLINE TEXT<|im_end|> NEWLINE

Control strings inside roles and texts are escaped reversibly: a backslash is
doubled, ``<|`` becomes ``<\\|``, and a newline in a role becomes ``<\\~|``. So
``<|`` occurs in the output only where the template put it.

Turns that follow the last reply are in no reply's context. They come out as
one more example without a target, so every turn can be read back.

An example holds its whole context, so its size is that of the conversation
up to it; one conversation is gathered in one row, as its examples are.

Defined cases: a null role or text counts as empty; turns are ordered by
``(turn, role, text)``, null turns first, and repeated rows are turns of their
own; rows with a null conversation id form one conversation; an empty table
gives no examples; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINABLE_ROLE = "assistant"


def escape(c: Column) -> Column:
    """Text without any control string."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    """The inverse of ``escape``."""
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("<\\~|"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("<\\~|"), F.lit("\n")))


def format_examples(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per example: ``conv_id, example, n_turns, text, loss_start, loss_length, is_last``.

    ``example`` numbers the examples of a conversation from 0. ``text`` is the
    formatted context and reply. ``loss_start`` (from 0) and ``loss_length``
    count the code points of the reply in ``text``; the length is null where
    nothing is trainable. ``is_last`` marks the example that holds all turns.
    """
    def column(name: str) -> Column:
        return F.coalesce(conversations[name].cast("string"), F.lit(""))

    turns = conversations.select(
        conversations[conv_col].alias("conv_id"),
        F.struct(conversations[turn_col].alias("turn"), column(role_col).alias("role"),
                 column(text_col).alias("text")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
        escape(t["text"]).alias("body"),
        (t["role"] == F.lit(TRAINABLE_ROLE)).alias("reply")))
    n = F.size("pieces")
    formatted = grouped.select("conv_id", pieces.alias("pieces")).select(
        "conv_id", "pieces",
        F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))).alias("whole"),
        F.filter(F.sequence(F.lit(0), n - 1),
                 lambda i: (i == n - 1) | F.get("pieces", i)["reply"]).alias("targets"))
    each = formatted.select("conv_id", "pieces", "whole", F.posexplode("targets").alias("example", "i"))
    target = F.get("pieces", F.col("i"))
    context = F.array_join(F.slice("whole", 1, F.col("i")), "")
    text = F.array_join(F.slice("whole", 1, F.col("i") + 1), "")
    return each.select(
        "conv_id", "example", (F.col("i") + 1).alias("n_turns"), text.alias("text"),
        F.when(target["reply"], F.length(context) + F.length(target["head"])).alias("loss_start"),
        F.when(target["reply"], F.length(target["body"])).alias("loss_length"),
        (F.col("i") == F.size("pieces") - 1).alias("is_last"))


def read_turns(text: Column) -> Column:
    """The turns ``(role, text)`` of a formatted example, unescaped."""
    parts = F.filter(F.split(text, "<\\|im_end\\|>\n"), lambda p: p != F.lit(""))
    bodies = F.transform(parts, lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(bodies, lambda b: F.struct(
        unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substr(b, F.length(F.substring_index(b, "\n", 1)) + 2)).alias("text")))


def read_loss(text: Column, start: Column, length: Column) -> Column:
    """The trainable reply of a formatted example, unescaped; null where there is none."""
    return unescape(F.substr(text, start + 1, length))
