"""Preference formatting of chat pairs (DataFrame only).

Input: the turns of a chosen and of a rejected conversation per pair
(pair_id, turn, role, text).  Output per pair: the longest common turn prefix,
rendered once as ``prompt``, and two completions with loss masks.

1. Turns of each side are numbered 1, 2, ... in turn order.
2. The sides meet on (pair_id, number): one aggregation tells for every number
   whether both sides have the same turn; the smallest number that differs ends
   the common prefix.  No conversation is collected for that.
3. Each turn is rendered as ``<|role|>\\n text <|end|>\\n``; a running sum of
   lengths gives its place in its completion; trained are the text and end mark
   of assistant turns.
4. One aggregation per pair puts the turns in order: a row per pair is the
   product, so a pair is as long as its two conversations.

A mask is a list ``start-end,start-end`` of trained character spans (code
points, end excluded) of the completion; prompt and other turns are masked.
A marker inside a text is written ``< |`` so that no text can end its turn.

Defined cases: null text is empty, a null role is ``unknown``; turns with a null
pair_id are left out; null turn numbers come last; equal turn numbers are
ordered by role and text; repeated rows are repeated turns; a pair with one side
only has an empty other completion; identical sides give two empty completions;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>", "<|end|>"


def _clean(c: Column) -> Column:
    return F.replace(c, F.lit(OPEN), F.lit("< |"))


def _numbered(turns: DataFrame, side: str) -> DataFrame:
    w = Window.partitionBy("pair_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return (turns.filter("pair_id is not null")
            .select("pair_id", "turn", F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .select("pair_id", F.lit(side).alias("side"), F.row_number().over(w).alias("k"), "role", "text"))


def turn_segments(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, part, k, rendered, first, end): every turn once in its part (prompt, chosen or rejected), with the
    trained span inside the part (null: masked).  A row per turn, whatever a conversation's length."""
    both = _numbered(chosen, "chosen").unionByName(_numbered(rejected, "rejected"))
    turn = F.struct("role", "text")
    same = (both.groupBy("pair_id", "k").agg(F.count(F.lit(1)).alias("n"), F.min(turn).alias("lo"),
                                             F.max(turn).alias("hi"))
            .groupBy("pair_id").agg(F.min(F.when((F.col("n") < 2) | (F.col("lo") != F.col("hi")), F.col("k")))
                                    .alias("split")))
    both = both.join(same, "pair_id")
    common = F.col("split").isNull() | (F.col("k") < F.col("split"))
    both = both.withColumn("part", F.when(common, F.lit("prompt")).otherwise(F.col("side")))
    both = both.filter((F.col("part") != "prompt") | (F.col("side") == "chosen"))
    head = F.concat(F.lit(OPEN), _clean(F.col("role")), F.lit(CLOSE + "\n"))
    body = F.concat(_clean(F.col("text")), F.lit(END))
    both = both.select("pair_id", "part", "k", "role", F.length(head).alias("h"), F.length(body).alias("b"),
                       F.concat(head, body, F.lit("\n")).alias("rendered"))
    w = Window.partitionBy("pair_id", "part").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("rendered")).over(w), F.lit(0)) + F.col("h")
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    return both.select("pair_id", "part", "k", "rendered", F.when(trained, start).alias("first"),
                       F.when(trained, start + F.col("b")).alias("end"))


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per pair: pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask."""
    seg = turn_segments(chosen, rejected)

    def joined(part: str, value: str, glue: str) -> Column:
        own = F.collect_list(F.when((F.col("part") == part) & F.col(value).isNotNull(), F.struct("k", value)))
        return F.array_join(F.transform(F.array_sort(own), lambda x: x[value]), glue)

    seg = seg.withColumn("span", F.concat_ws("-", "first", "end")).withColumn(
        "span", F.when(F.col("first").isNotNull(), F.col("span")))
    return seg.groupBy("pair_id").agg(
        F.count(F.when(F.col("part") == "prompt", 1)).alias("n_prompt_turns"),
        joined("prompt", "rendered", "").alias("prompt"),
        joined("chosen", "rendered", "").alias("chosen"), joined("chosen", "span", ",").alias("chosen_mask"),
        joined("rejected", "rendered", "").alias("rejected"),
        joined("rejected", "span", ",").alias("rejected_mask"))


def answer_swaps(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs out of plain conversations (conv_id, turn, role, text): (chosen turns, rejected turns).

    Chosen is every conversation up to its last assistant turn; rejected is the
    same with that turn's text replaced by the last assistant text of the
    neighbour (conv_id with its lowest bit flipped), or without the turn if the
    neighbour has none.  Conversations without assistant turns pair with
    themselves.
    """
    turns = conversations.filter("conv_id is not null").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    said = F.when(F.col("role") == "assistant", F.struct("turn", "text"))
    last = turns.groupBy("pair_id").agg(F.max(said).alias("last"))
    chosen = (turns.join(last.select("pair_id", F.col("last.turn").alias("stop")), "pair_id")
              .filter("stop is null or turn <= stop"))
    other = last.filter("last is not null").select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"),
                                                   F.col("last.text").alias("swap"), F.lit(True).alias("has"))
    is_last = (F.col("role") == "assistant") & F.col("turn").eqNullSafe(F.col("stop"))
    rejected = (chosen.join(other, "pair_id", "left").filter(~F.coalesce(is_last, F.lit(False)) | F.col("has"))
                .withColumn("text", F.when(is_last, F.col("swap")).otherwise(F.col("text"))))
    keep = ["pair_id", "turn", "role", "text"]
    return chosen.select(*keep), rejected.select(*keep)
