"""Chat formatting (operator 7, native): turn structs are collected, sorted, merged and concatenated by expressions.

Template of a block: ``<|im_start|>role\\n`` text ``<|im_end|>\\n``. Adjacent turns of one role share a block; their texts
are parted by ``<|im_sep|>``, so that the turns can be read back. Inside roles and texts every ``<`` that is followed by
any number of backslashes and a bar gets one more backslash; hence no control string can occur in them, and taking one
backslash away gives the text again. A line break in a role is written ``<|im_nl|>``.

Defined cases: a null text or role is empty; turns are ordered by (turn, role, text), null turns first, so ties and
repeated rows have a fixed order and all stay; a row without a conv_id belongs to no other and is a conversation of its
own, so that such rows aren't collected; extra columns are ignored, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed control strings of the template.
START, END, SEP, BREAK = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>", "<|im_nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_chats(turns: DataFrame, assistant: str = "assistant") -> DataFrame:
    """One row per conv_id: formatted string, pieces array<struct<text, loss>>; the pieces joined are the string.

    The pieces with loss are the loss mask: exactly the texts of the assistant's turns, without markers. collect_list
    combines on the map side. The blocks are found from their first positions, each is a slice, so the work is linear
    in the number of turns.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("own")
    rows = turns.select("conv_id", own, turn.alias("turn")).groupBy("conv_id", "own").agg(F.array_sort(F.collect_list("turn"), _by_turn).alias("turns"))
    first = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", F.greatest(i - 1, F.lit(0)))["role"]),
    )
    rows = rows.withColumn("first", first)
    block = lambda i, k: F.struct(
        F.get("turns", i)["role"].alias("role"),
        F.transform(F.slice("turns", i + 1, F.coalesce(F.get("first", k + 1), F.size("turns")) - i), lambda t: t["text"]).alias("texts"),
    )
    rows = rows.select("conv_id", F.transform("first", block).alias("blocks"))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def pieces(b: Column) -> Column:
        role = F.replace(escape(b["role"]), F.lit("\n"), F.lit(BREAK))
        head = piece(F.concat(F.lit(START), role, F.lit("\n")), F.lit(False))
        body = F.flatten(
            F.transform(
                b["texts"],
                lambda t, i: F.array(piece(F.when(i > 0, F.lit(SEP)).otherwise(F.lit("")), F.lit(False)), piece(escape(t), b["role"] == assistant)),
            )
        )
        return F.concat(F.array(head), body, F.array(piece(F.lit(END), F.lit(False))))

    rows = rows.select("conv_id", F.flatten(F.transform("blocks", pieces)).alias("pieces"))
    return rows.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), "pieces")


def _by_turn(a: Column, b: Column) -> Column:
    def compare(x: Column, y: Column, rest: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1).otherwise(rest)

    texts = compare(a["role"], b["role"], compare(a["text"], b["text"], F.lit(0)))
    nulls = F.when(a["turn"].isNull() & b["turn"].isNotNull(), -1).when(a["turn"].isNotNull() & b["turn"].isNull(), 1)
    return nulls.otherwise(compare(a["turn"], b["turn"], texts))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string: array<struct<role, text>>, one for each row that went in."""
    blocks = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 2_000_000_000)

    def turns(b: Column) -> Column:
        head = F.substring_index(b, "\n", 1)
        body = F.replace(b.substr(F.length(head) + 2, F.length(b)), F.lit(END), F.lit(""))
        role = unescape(F.replace(head, F.lit(BREAK), F.lit("\n")))
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped: the pieces with loss, in order, nothing between."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")
