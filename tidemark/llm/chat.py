"""Chat formatting: one rendering of a dialogue for each of its participants.

For a participant, that speaker's turns are the assistant's and are learned; the others
are users with their names, and system turns stay system turns. A dialogue is written
in blocks of `block_turns` turn numbers, so a conversation of any length stays in rows
of bounded size that different tasks make; a shorter one is one row. The mask is a list
of (characters, learn) that covers the block's text from start to end.

Order is by turn, then role, then text; exactly repeated rows are one turn. A null turn
comes in block -1, after all others. A null role is a user called `unknown` and no
participant; a null text is empty; rows of a null conv_id are one conversation. A
conversation without participants has no rendering. `<|` in names and texts becomes
`<\\|`, so no text can pose as a marker. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"


def _plain(value: Column) -> Column:
    return F.replace(value, F.lit("<|"), F.lit("<\\|"))


def perspectives(conversations: DataFrame, block_turns: int = 64, system: tuple[str, ...] = ("system",)) -> DataFrame:
    """conv_id, perspective, block, n_turns, text, mask array<struct<n, learn>>, n_learned."""
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = rows.filter(F.col("role").isNotNull() & ~F.col("role").isin(*system)).select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct()
    block = F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-1)).cast("long")
    turns = rows.withColumn("block", block).withColumn("role", F.coalesce("role", F.lit("unknown")))
    # One list per block of a conversation, of which every perspective is a view.
    lists = turns.groupBy("conv_id", "block").agg(F.sort_array(F.collect_set(F.struct(F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text"))).alias("turns"))
    viewed = lists.join(named, F.col("conv_id").eqNullSafe(F.col("of")))

    def head(turn: Column) -> Column:
        name = F.when(turn["role"] == F.col("perspective"), "<|assistant|>\n").when(turn["role"].isin(*system), "<|system|>\n")
        return name.otherwise(F.concat(F.lit("<|user name="), _plain(turn["role"]), F.lit("|>\n")))

    def tail(turn: Column) -> Column:
        return F.concat(_plain(turn["text"]), F.lit(END))

    def masked(turn: Column) -> Column:
        learned = turn["role"] == F.col("perspective")
        return F.array(F.struct(F.length(head(turn)).alias("n"), F.lit(False).alias("learn")), F.struct(F.length(tail(turn)).alias("n"), learned.alias("learn")))

    mask = F.flatten(F.transform("turns", masked))
    return viewed.select(
        "conv_id",
        "perspective",
        "block",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(head(t), tail(t))), "").alias("text"),
        mask.alias("mask"),
    ).withColumn("n_learned", F.expr("aggregate(mask, 0L, (t, m) -> t + if(m.learn, m.n, 0))"))
