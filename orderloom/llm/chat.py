"""Preference formatting: one prompt from the common turns, two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turns): each conversation's turns as an array in order of turn.

    Nulls sort first, equal turn numbers by role and text, repeated rows stay. A null
    role or text reads as empty. Rows without conv_id belong to no conversation.
    A conversation is one row of the output, so its turns meet in one task by nature.
    """
    turn = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    gathered = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("all"))
    return gathered.select(
        "conv_id", F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def replaced_replies(talks: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """Preference pairs (pair_id, chosen, rejected) out of plain conversations.

    Chosen is a conversation up to its last trained turn; rejected is the same with that
    turn's text taken from the last trained turn of conversation conv_id + 1. Without
    either turn there is no pair.
    """
    at = F.array_max(
        F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["role"] == trained)
    )
    cut = talks.where(F.size("turns") > 0).withColumn("at", at).where("at IS NOT NULL")
    cut = cut.withColumn("reply", F.element_at("turns", F.col("at")))
    other = cut.select((F.col("conv_id") - 1).alias("conv_id"), F.col("reply").alias("other"))
    same = F.slice("turns", F.lit(1), F.col("at") - 1)
    return cut.join(other, "conv_id").select(
        F.col("conv_id").alias("pair_id"),
        F.slice("turns", F.lit(1), F.col("at")).alias("chosen"),
        F.concat(same, F.array("other")).alias("rejected"),
    )


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit("\n"))), "")


def _spans(turns: Column, trained: str) -> Column:
    """Runs (start, length) of code points to train on: text and line end of trained turns."""
    nothing = F.array().cast("array<struct<start:int,length:int>>")
    start = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_head(turn))
        length = F.length(turn["text"]) + 1
        span = F.array(F.struct(begin.alias("start"), length.alias("length")))
        spans = F.when(turn["role"] == trained, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((begin + length).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def format_preferences(pairs: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """Rows (pair_id, shared_turns, prompt, chosen, rejected, chosen_mask, rejected_mask).

    The prompt is the longest common prefix of turns (same role, same text), rendered
    once; each completion is the rest of its side, and its mask lists the runs of code
    points that count in the loss. Where one side is a prefix of the other its completion
    is empty, as are equal sides'. A null side reads as a conversation without turns.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.select(
        "pair_id", F.coalesce("chosen", empty).alias("c"), F.coalesce("rejected", empty).alias("r")
    ).withColumn("least", F.least(F.size("c"), F.size("r")))
    differs = F.array_min(
        F.filter(
            F.sequence(F.lit(1), F.col("least")),
            lambda i: ~F.element_at("c", i).eqNullSafe(F.element_at("r", i)),
        )
    )
    found = F.when(F.col("least") > 0, F.coalesce(differs - 1, F.col("least"))).otherwise(F.lit(0))
    cut = sides.withColumn("shared", found)
    cut = cut.withColumns(
        {
            "p": F.slice("c", F.lit(1), F.col("shared")),
            "c": F.slice("c", F.col("shared") + 1, F.size("c")),
            "r": F.slice("r", F.col("shared") + 1, F.size("r")),
        }
    )
    return cut.select(
        "pair_id",
        F.col("shared").alias("shared_turns"),
        _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"),
        _rendered(F.col("r")).alias("rejected"),
        _spans(F.col("c"), trained).alias("chosen_mask"),
        _spans(F.col("r"), trained).alias("rejected_mask"),
    )


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit("+"), s["length"].cast("string"))), " ")
