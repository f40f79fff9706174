"""Chat formatting by prefix-target expansion: an example for every assistant turn.

An example is the conversation up to that turn, of which only the reply is trainable. Turns
that follow the last reply form a last example of which nothing is. In the text a turn is
``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings in roles and texts are made harmless by a
backslash after their first character, one more if there are some already; taking one away
gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template: the marks of a turn, and the control strings that texts may not hold.
START, END, NEXT = "<|im_start|>", "<|im_end|>", "\n"
#: `<s>`, `</s>`, `[INST]`, `[/INST]`, `<<SYS>>`, `<</SYS>>` and everything between `<|` and `|>`.
_BODY = r"(/?s>|/?INST\]|<?/?SYS>>|\|[A-Za-z0-9_]*\|>)"
TRAINABLE_ROLE = "assistant"


def escape(text: Column) -> Column:
    """The text with each control string broken by a backslash; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([<\[])(\\*)" + _BODY, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _BODY, "$1$2$3")


def escape_role(role: Column) -> Column:
    """A role on one line: backslashes and line breaks are written as ``\\b`` and ``\\n`` first."""
    return escape(F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def expand(conversations: DataFrame) -> DataFrame:
    """Training examples of ``conversations (conv_id, turn, role, text)``.

    Returns ``(conv_id, alone, example, last, text, loss_start, loss_chars)``: the examples of a conversation are numbered
    from 0; ``last`` marks the one that holds all turns. The loss mask are ``loss_chars`` code points from
    position ``loss_start`` (from 0), the reply as it is written in the text; -1 and 0 where nothing is trainable.

    Turns are ordered by number, then role, then text, so ties have a defined order; NULLs come first. Repeated rows
    are turns of their own. NULL texts and roles are empty. A row with a NULL ``conv_id`` is a conversation of its own, of one turn; ``alone`` tells
    these apart and is NULL for all others.
    Other columns are ignored; an empty table has no example. Texts of any length are whole. A conversation of n turns has up to n examples, each with
    its context, as the method asks; the turns of one conversation are gathered in one row, its turns being a document,
    not a group of the data.
    """
    turn = F.struct("turn", "role", "text")
    written = F.transform(
        F.array_sort(F.collect_list(turn)),
        lambda t: F.struct(
            (F.coalesce(t["role"], F.lit("")) == TRAINABLE_ROLE).alias("reply"),
            F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
        ),
    )
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("alone")
    chats = conversations.select("conv_id", alone, "turn", "role", "text").groupBy("conv_id", "alone").agg(written.alias("turns"))
    n = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | F.element_at("turns", i)["reply"])
    ends = F.transform(ends, lambda i, k: F.struct(k.alias("example"), i.alias("end")))
    chats = chats.select("conv_id", "alone", "turns", F.inline(ends))
    whole = F.transform(F.slice("turns", 1, F.col("end")), lambda t: F.concat(t["head"], t["body"], F.lit(END + NEXT)))
    final = F.element_at("turns", F.col("end"))
    text = F.array_join(whole, "")
    start = F.length("text") - F.length(final["body"]) - len(END + NEXT)
    return (
        chats.withColumn("text", text)
        .withColumns({"loss_start": F.when(final["reply"], start).otherwise(-1), "loss_chars": F.when(final["reply"], F.length(final["body"])).otherwise(0)})
        .select("conv_id", "alone", "example", (F.col("end") == n).alias("last"), "text", F.col("loss_start").cast("long").alias("loss_start"), F.col("loss_chars").cast("long").alias("loss_chars"))
    )


def turns_of(text: Column) -> Column:
    """The turns of an example, ``array<struct<role, text>>``, read back from its text."""
    parts = F.split(text, r"\Q" + END + NEXT + START + r"\E|^\Q" + START + r"\E|\Q" + END + NEXT + r"\E$")
    parts = F.filter(parts, lambda p: p.contains("\n"))
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p))).alias("text"),
        ),
    )


def loss_text(text: Column, start: Column, chars: Column) -> Column:
    """What is trainable of an example, unescaped; empty if nothing is."""
    return unescape(F.substring(text, (start + 1).cast("int"), chars.cast("int")))
