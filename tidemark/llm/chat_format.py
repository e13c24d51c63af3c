"""Relational chat formatting with Spark expressions only, and its exact inverse.

A conversation's turns are collected as structs and sorted; adjacent turns of one role are merged into
one block by array aggregation; blocks are concatenated. Of the special characters `<`, `[` and `\\`
each one inside a role or text is followed by an added `\\`, so no control string can occur there and
reading back is exact. In a block of several turns, a control string stands between the turns.

    <s>[ROLE] user [/ROLE]text[NEXT]text</s><s>[ROLE] assistant [/ROLE]text</s>

Loss spans are (start, length) in code points of the escaped assistant texts within the output.

Defined cases: a null text is empty; a null role is written as the control string [NULL] and read back
as null; null turns sort first; turns with equal numbers are ordered by role and text; repeated rows
are turns of their own; a null conversation id is a conversation. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    block_open: str = "<s>[ROLE] "
    text_open: str = " [/ROLE]"
    next_turn: str = "[NEXT]"
    block_close: str = "</s>"
    null_role: str = "[NULL]"
    loss_role: str = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])\\", "$1")


def format_chats(turns: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_spans array<struct<start: int, length: int>>), one row per conversation."""
    t = template
    rows = turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(F.col(turn).cast("long").alias("turn"), F.coalesce(escape(F.col(role)), F.lit(t.null_role)).alias("role"), escape(F.coalesce(F.col(text), F.lit(""))).alias("text")).alias("t"),
    )
    sorted_ = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    # array aggregation: blocks of one role, each with the escaped texts of its turns
    blocks = F.expr("""aggregate(turns, cast(array() as array<struct<role: string, texts: array<string>>>), (acc, x) ->
        if(size(acc) > 0 and element_at(acc, -1).role = x.role,
           concat(slice(acc, 1, size(acc) - 1), array(named_struct('role', x.role, 'texts', concat(element_at(acc, -1).texts, array(x.text))))),
           concat(acc, array(named_struct('role', x.role, 'texts', array(x.text))))))""")
    head = lambda b: F.concat(F.lit(t.block_open), b["role"], F.lit(t.text_open))
    piece = lambda b: F.concat(head(b), F.array_join(b["texts"], t.next_turn), F.lit(t.block_close))
    pieces = sorted_.select("conv_id", blocks.alias("blocks")).select("conv_id", "blocks", F.transform("blocks", piece).alias("pieces"))
    # running offsets: where each block begins, then where each of its texts does
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, length: int>>)").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        b, p = x["blocks"], x["pieces"]
        inner = F.aggregate(
            b["texts"],
            F.struct((acc["at"] + F.char_length(head(b))).alias("at"), acc["spans"].alias("spans")),
            lambda s, w: F.struct(
                (s["at"] + F.char_length(w) + len(t.next_turn)).alias("at"),
                F.concat(s["spans"], F.array(F.struct(s["at"].alias("start"), F.char_length(w).alias("length")))).alias("spans"),
            ),
        )["spans"]
        spans = F.when(b["role"] == t.loss_role, inner).otherwise(acc["spans"])
        return F.struct((acc["at"] + F.char_length(p)).alias("at"), spans.alias("spans"))

    spans = F.aggregate(F.arrays_zip("blocks", "pieces"), zero, step)["spans"]
    return pieces.select("conv_id", F.concat_ws("", "pieces").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>, loss_text, formatted_chars), parsed from the formatted text alone."""
    t = template
    lit = lambda x: "\\Q" + x + "\\E"
    body = F.split("formatted", lit(t.block_close))
    blocks = F.slice(body, 1, F.size(body) - 1)

    def turns_of(b: Column) -> Column:
        parts = F.split(F.substr(b, F.lit(len(t.block_open) + 1)), lit(t.text_open), 2)
        role = F.when(parts[0] != t.null_role, unescape(parts[0]))
        return F.transform(F.split(parts[1], lit(t.next_turn)), lambda w: F.struct(role.alias("role"), unescape(w).alias("text")))

    loss = F.concat_ws("", F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))))
    return formatted.select("conv_id", F.flatten(F.transform(blocks, turns_of)).alias("turns"), loss.alias("loss_text"), F.char_length("formatted").cast("long").alias("formatted_chars"))
