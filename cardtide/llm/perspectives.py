"""Chat formatting: every speaker's view of a dialogue, in built-in functions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks around a message, and what stands for the first sign of a mark inside a text.
BEGIN, END, QUOTED = "<|im_start|>", "<|im_end|>\n", "<\\|"


def _quoted(text: Column) -> Column:
    """Text that cannot be taken for marks."""
    return F.replace(text, F.lit("<|"), F.lit(QUOTED))


def rotated(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    narrators: Sequence[str] = ("system",),
    part_turns: int = 256,
) -> DataFrame:
    """(conversation id, speaker, part, n_parts, n_turns, text, mask): the dialogue as each speaker sees it.

    For every speaker the turns are rendered in order with the speaker's own as ``assistant`` and all others as
    ``user`` with their names; ``narrators`` speak as themselves in every view and have none of their own. ``mask``
    lists what is learned from, as ``start:length`` in characters of ``text``, separated by commas: each of the
    speaker's messages with its end mark.

    A dialogue comes in parts of ``part_turns`` turn numbers, so that no row holds more of one than that; its
    ``n_parts`` parts, joined in order, are the whole, and most dialogues have just part 0. Turns are ordered by
    number, then by role and text; equal turns (repeated rows) count once. A null text is empty, a null role is a
    narrator shown as ``unknown`` (a speaker of that name is one like any other), a line end in a name is shown as a
    space, a null turn number comes first, in part -1; turns without a conversation id belong to none and are left
    out. A dialogue with narrators alone, and an empty table, give no rows.
    """
    named = F.col(role_col).isNotNull()
    role = F.coalesce(F.col(role_col).cast("string"), F.lit("unknown"))
    known = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.coalesce(F.floor(F.col(turn_col) / part_turns).cast("long"), F.lit(-1)).alias("part"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        _quoted(F.coalesce(F.col(text_col), F.lit(""))).alias("said"),
        named.alias("named"),
    )
    parts = known.groupBy("id", "part").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "said", "named"))).alias("turns"))
    speaks = F.col("named") & ~F.col("role").isin(*narrators)
    speakers = known.where(speaks).select("id", F.col("role").alias("speaker")).distinct()
    numbers = known.select("id", "part").distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n_parts"))
    mine = lambda t: t["named"] & (t["role"] == F.col("speaker"))
    shown_name = lambda t: F.replace(_quoted(t["role"]), F.lit("\n"), F.lit(" "))
    head = lambda t: F.when(mine(t), F.lit("assistant")).when(
        ~t["named"] | t["role"].isin(*narrators), shown_name(t)
    ).otherwise(F.concat(F.lit("user name="), shown_name(t)))
    shown = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(BEGIN), head(t), F.lit("\n")).alias("head"), F.concat(t["said"], F.lit(END)).alias("body"), mine(t).alias("mine")
        ),
    )
    spans = F.aggregate(
        "shown",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("mask")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"])).cast("long").alias("at"),
            F.when(
                t["mine"], F.array_append(acc["mask"], F.concat_ws(":", (acc["at"] + F.length(t["head"])).cast("string"), F.length(t["body"]).cast("string")))
            ).otherwise(acc["mask"]).alias("mask"),
        ),
        lambda acc: F.array_join(acc["mask"], ","),
    )
    return (
        parts.join(speakers.join(numbers, "id"), "id")
        .withColumn("shown", shown)
        .select(
            F.col("id").alias(id_col),
            "speaker",
            "part",
            "n_parts",
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["body"])), "").alias("text"),
            spans.alias("mask"),
        )
    )
