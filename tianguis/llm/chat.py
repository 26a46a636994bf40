r"""Chat formatting with prefix-target expansion, in Spark expressions alone.

The template marks every turn:

    user       [INST] text [/INST]
    assistant  <s> text </s>
    system     <<SYS>> text <</SYS>>
    other      [ROLE] role [TEXT] text [/ROLE]

Control strings inside texts get one backslash after their first character, those that
already have backslashes there one more; taking one away undoes it.

Every assistant turn becomes an example of its own: all preceding turns are its context and
only its text is trainable.  The formatted conversation is kept once, and an example is a
prefix of it (``context_chars``) with its target (text and places), so a conversation of n
turns takes n pieces of text and not n^2; ``example_text`` puts the two together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks around a turn's text.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
_CONTROL = r"(/?INST\]|/?s>|</?SYS>>|/?ROLE\]|TEXT\])"
_TURN = r"(?s)\[INST\] (.*?) \[/INST\]|<s> (.*?) </s>|<<SYS>> (.*?) <</SYS>>|\[ROLE\] (.*?) \[TEXT\] (.*?) \[/ROLE\]"


def escape(text: Column) -> Column:
    """Makes control strings harmless; ``unescape`` gives back the same text."""
    return F.regexp_replace(text, r"([\[<])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])\\(\\*)" + _CONTROL, r"$1$2$3")


def _piece(role: Column, text: Column) -> Column:
    out = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]), escape(text), F.lit(OTHER[2]))
    for name, (before, after) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(before), escape(text), F.lit(after))).otherwise(out)
    return out


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row for each conversation: ``conv_id`` and ``formatted``, its marked turns in order.

    ``turns`` has conv_id, turn, role and text; other columns are not read.  Null roles and
    texts count as empty.  Rows with equal turns are ordered by role, then text; null turns
    come first.  Rows whose conv_id is null form one conversation.  Empty tables give empty
    results.  A conversation's text must fit in one row, as its digest needs.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return ordered.select("conv_id", F.array_join(F.transform("ts", lambda t: _piece(t["role"], t["text"])), "").alias("formatted"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of structs (piece, role, text), texts unescaped."""

    def turn(piece: Column) -> Column:
        role, text = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name, (before, after) in MARKS.items():
            ours = piece.startswith(before)
            role = F.when(ours, F.lit(name)).otherwise(role)
            text = F.when(ours, F.substr(piece, F.lit(len(before) + 1), F.length(piece) - len(before) - len(after))).otherwise(text)
        ours = piece.startswith(OTHER[0])
        at = F.instr(piece, OTHER[1])
        role = F.when(ours, F.substr(piece, F.lit(len(OTHER[0]) + 1), at - len(OTHER[0]) - 1)).otherwise(role)
        start = at + len(OTHER[1])
        text = F.when(ours, F.substr(piece, start, F.length(piece) - start - len(OTHER[2]) + 1)).otherwise(text)
        return F.struct(piece.alias("piece"), unescape(role).alias("role"), text.alias("escaped"), unescape(text).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), turn)


def examples(formatted: DataFrame) -> DataFrame:
    """Every assistant turn of ``format_conversations`` as an example.

    conv_id; ``example`` (from 0); ``context_turns`` and ``context_chars``: the prefix of the
    formatted conversation that is its context; ``target``: the marked reply that follows;
    ``loss_start`` and ``loss_end``: the trainable part of context and target together, in
    code points.  Conversations without a reply give no row.
    """
    before = MARKS["assistant"][0]
    pieces = formatted.select("conv_id", F.posexplode(parse(F.col("formatted"))).alias("i", "t"))
    # running sums over the pieces before: their characters, and replies among them
    earlier = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    is_reply = F.col("t.role") == "assistant"
    placed = pieces.withColumns(
        {
            "at": F.coalesce(F.sum(F.length("t.piece").cast("long")).over(earlier), F.lit(0)).cast("int"),
            "example": F.coalesce(F.count_if(is_reply).over(earlier), F.lit(0)).cast("int"),
        }
    )
    start = F.col("at") + len(before)
    return placed.where(is_reply).select(
        "conv_id",
        "example",
        F.col("i").alias("context_turns"),
        F.col("at").alias("context_chars"),
        F.col("t.piece").alias("target"),
        start.alias("loss_start"),
        (start + F.length("t.escaped")).alias("loss_end"),
    )


def example_text(formatted: Column, context_chars: Column, target: Column) -> Column:
    """The whole text of one example: its context and its target."""
    return F.concat(F.substr(formatted, F.lit(1), context_chars), target)


def expanded(formatted: DataFrame) -> DataFrame:
    """``examples`` with the text of each: ``text``, its whole context and its target, which ``loss_start`` and ``loss_end`` refer to.

    A reply's context is repeated in every later example, so a conversation of n turns gives n^2 of text; it is
    put together row by row behind the join, and never shuffled.
    """
    whole = formatted.select(F.col("conv_id").alias("__conv"), F.col("formatted").alias("__formatted"))
    each = examples(formatted).join(whole, F.col("conv_id").eqNullSafe(F.col("__conv")))
    return each.withColumn("text", example_text(F.col("__formatted"), F.col("context_chars"), F.col("target"))).drop("__conv", "__formatted")


def masked(text: Column, loss_start: Column, loss_end: Column) -> Column:
    """The text under the loss mask of an example's whole text, unescaped."""
    return unescape(F.substr(text, loss_start + 1, loss_end - loss_start))


def trainable(target: Column, context_chars: Column, loss_start: Column, loss_end: Column) -> Column:
    """The text under an example's loss mask, unescaped."""
    return unescape(F.substr(target, loss_start - context_chars + 1, loss_end - loss_start))
