"""Conversation histories and request bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions import chat
from loomwork.operators import scan


def conversation_history(turns: DataFrame, piece_turns: int | None = None) -> DataFrame:
    """For each assistant turn all earlier turns: (conv_id, turn, text, messages).

    A very long conversation is gathered in pieces.  A turn takes what comes before
    it in its own piece and the earlier pieces, which are put together once per piece,
    so no task builds all histories of a conversation.
    """
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    inside = (Window.partitionBy("conv_id", "_piece").orderBy("turn")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = turns.withColumn("_piece", chat.piece_of(F.col("turn"), piece_turns))
    own = placed.withColumn("_own", F.collect_list(message).over(inside)).where(F.col("role") == "assistant")
    pieces = chat.pieces(turns, piece_turns)
    before = pieces.select("conv_id", F.col("piece").alias("_before"), "turns")
    earlier = (pieces.where("piece > 0").select("conv_id", F.col("piece").alias("_piece")).join(before, "conv_id")
               .where("_before < _piece").groupBy("conv_id", "_piece")
               .agg(F.array_sort(F.collect_list(F.struct("_before", "turns"))).alias("_lists")))
    said = F.transform(F.flatten(F.transform("_lists", lambda p: p["turns"])), lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("content")))
    earlier = earlier.select("conv_id", "_piece", said.alias("_earlier"))
    whole = F.when(F.col("_earlier").isNull(), F.col("_own")).otherwise(F.concat("_earlier", "_own"))
    return own.join(earlier, ["conv_id", "_piece"], "left").select(
        "conv_id", "turn", "text", whole.alias("messages"))


def chat_requests(turns: DataFrame, model: str, piece_turns: int | None = None) -> DataFrame:
    """(conv_id, turn, body): the request that each assistant turn answers, with the whole history."""
    return conversation_history(turns, piece_turns).select(
        "conv_id", "turn", chat.chat_request_json(F.col("messages"), model).alias("body"))


def history_display(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, line): numbered lines of each conversation, numbers from 1."""
    numbered = scan.running(turns, ["conv_id"], ["turn"], {"n": F.lit(1)})
    return numbered.select("conv_id", "turn", chat.history_line(
        F.col("n"), F.col("role"), F.col("text")).alias("line"))
