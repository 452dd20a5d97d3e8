"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only that
reply is trainable. Turns after the last reply, and conversations without a reply, end in one more
example without a trainable part, so that nothing of a conversation is lost.

A turn is written as ``### role: text</turn>`` and a line end. What marks a turn is escaped inside
roles and texts by a backslash and a letter, and a backslash is doubled, so every text comes back
exactly. Only DataFrame functions are used.

An example is one value, so a conversation must fit in one row; its turns are put in order once, and
its examples are made from them one after the other.
Defined results: null roles and texts are empty; turns go by number, null first, ties by role and
text; repeated rows are repeated turns; a row without a conversation id is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, ROLE_END = "### ", "</turn>", ": "
ESCAPES = ((CLOSE, "\\e"), (OPEN, "\\h"), (":", "\\c"))


def escape(text: Column, also: tuple[str, ...] = ()) -> Column:
    """The text without control strings; ``also`` names further strings of ESCAPES to escape."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, code in ESCAPES:
        if control in (OPEN, CLOSE, *also):
            out = F.replace(out, F.lit(control), F.lit(code))
    return out


def unescape(text: Column) -> Column:
    """What ``escape`` was given: doubled backslashes part the text into pieces that hold codes only."""

    def piece(p: Column) -> Column:
        for control, code in ESCAPES:
            p = F.replace(p, F.lit(code), F.lit(control))
        return p

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), piece), "\\")


def expand_prefix_targets(
    turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """(conv_id, example, n_turns, text, loss_start, loss_length, is_last), a row per reply.

    ``text`` is the formatted example of n_turns turns, of which loss_length characters from loss_start
    (counted from 0) are trainable; ``is_last`` marks the example with all turns.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_column, text_column))
    head = F.concat(F.lit(OPEN), escape(role, (":",)), F.lit(ROLE_END))
    rows = turns.select(
        F.col(id_column).alias("conv_id"),
        F.struct(
            F.col(turn_column).alias("turn"),
            role.alias("role"),
            text.alias("text"),
            F.concat(head, escape(text), F.lit(CLOSE + "\n")).alias("shown"),
            F.length(head).alias("head"),
            F.length(escape(text)).alias("body"),
        ).alias("t"),
    )
    whole = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.unionByName(rows.where("conv_id IS NULL").select("conv_id", F.array("t").alias("turns")))
    numbers = F.sequence(F.lit(1), F.size("turns"))
    is_reply = lambda n: F.element_at("turns", n)["role"] == "assistant"
    ends = F.filter(numbers, lambda n: is_reply(n) | (n == F.size("turns")))
    each = whole.select("conv_id", "turns", F.posexplode(ends).alias("example", "n_turns"))
    target = F.element_at("turns", F.col("n_turns"))
    before = F.slice("turns", F.lit(1), F.col("n_turns") - 1)
    in_front = F.aggregate(before, F.lit(0), lambda n, t: n + F.length(t["shown"]))
    return each.select(
        "conv_id",
        "example",
        "n_turns",
        F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("n_turns")), lambda t: t["shown"]), "").alias("text"),
        (in_front + target["head"]).alias("loss_start"),
        F.when(target["role"] == "assistant", target["body"]).otherwise(0).alias("loss_length"),
        (F.col("n_turns") == F.size("turns")).alias("is_last"),
    )


def trainable(text: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(text, start + 1, length))


def parse(text: Column) -> Column:
    """array<struct<role, text>> of the turns of a formatted example."""
    shown = F.split(text, CLOSE + "\n", -1)
    turns = F.slice(shown, F.lit(1), F.size(shown) - 1)

    def turn(t: Column) -> Column:
        role_length = F.instr(t, F.lit(ROLE_END)) - 1 - len(OPEN)
        return F.struct(
            unescape(F.substring(t, F.lit(len(OPEN) + 1), role_length)).alias("role"),
            unescape(F.substring(t, len(OPEN) + role_length + len(ROLE_END) + 1, F.length(t))).alias("text"),
        )

    return F.transform(turns, turn)
