"""Preference formatting of conversations, in DataFrame functions only.

Method: the chosen and the rejected conversation of a pair are put in turn order; their longest common prefix of
turns is rendered once, as the prompt, and what follows in each as its completion. Spans tell which
characters of prompt and completion together a loss may see: the assistant's words and end marks in the completion.

A single shuffle by pair brings both conversations together; a pair is one example and has to fit in a row.

Defined cases: a null role or text is empty; turns of one number are ordered by role and text, null turns come first;
rows without pair are no conversation; a pair with one side missing gives no row; where one conversation begins
with the whole other one, the shorter completion is empty, and two equal ones have only a prompt; texts are
rendered as they are; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: a turn is START, role, line end, text, END, line end
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def _turns(turns: DataFrame, pair: str, side: int) -> DataFrame:
    empty = F.lit("")
    return turns.where(F.col(pair).isNotNull()).select(
        F.col(pair).cast("long").alias("pair_id"),
        F.lit(side).alias("side"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )


def preferences(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id") -> DataFrame:
    """pair_id, prompt, prompt_turns, chosen, rejected, chosen_spans and rejected_spans of every pair.

    Both tables have the columns pair, turn, role and text. Spans are (start, end) in characters.
    """
    rows = _turns(chosen, pair, 0).unionByName(_turns(rejected, pair, 1)).repartition("pair_id")
    head = F.concat(F.lit(START), "role", F.lit("\n"))
    rows = rows.withColumn("rendered", F.concat(head, "text", F.lit(END + "\n")))
    order = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    rows = rows.withColumn("place", F.row_number().over(order))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("rendered").cast("long")).over(upto)
    start = end - F.length("text") - len(END) - 1
    span = F.when(F.col("role") == TRAINED, F.struct(start.alias("start"), (end - 1).alias("end")))
    rows = rows.withColumn("one", F.struct("place", "rendered", span.alias("span")))
    sides = [F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("one")))).alias(f"side{side}") for side in (0, 1)]
    both = rows.groupBy("pair_id").agg(*sides).where((F.size("side0") > 0) & (F.size("side1") > 0))
    same = F.zip_with("side0", "side1", lambda a, b: a["rendered"].eqNullSafe(b["rendered"]))
    unlike = F.array_position(same, False)
    both = both.withColumn("prompt_turns", F.when(unlike > 0, unlike - 1).otherwise(F.size("side0")).cast("int"))

    def after(side: str) -> Column:
        return F.filter(side, lambda turn: turn["place"] > F.col("prompt_turns"))

    def text(turns: Column) -> Column:
        return F.array_join(F.transform(turns, lambda turn: turn["rendered"]), "")

    def spans(side: str) -> Column:
        return F.filter(F.transform(after(side), lambda turn: turn["span"]), lambda s: s.isNotNull())

    return both.select(
        "pair_id",
        text(F.filter("side0", lambda turn: turn["place"] <= F.col("prompt_turns"))).alias("prompt"),
        "prompt_turns",
        text(after("side0")).alias("chosen"),
        text(after("side1")).alias("rejected"),
        spans("side0").alias("chosen_spans"),
        spans("side1").alias("rejected_spans"),
    )


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns made from plain conversations.

    A conversation is chosen; rejected is the same one with its last assistant turn's text taken from its
    neighbour (conversations 2n and 2n + 1 are neighbours). Conversations without an answer,
    or whose neighbour has none, give no pair.
    """
    said = conversations.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select("conv_id", "turn", "role", "text")
    answers = said.where(F.col("role") == TRAINED)
    last = answers.groupBy("conv_id").agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    other = last.select((F.col("conv_id").bitwiseXOR(F.lit(1))).alias("conv_id"), F.col("last.text").alias("other"))
    paired = last.join(other, "conv_id").select("conv_id", F.col("last.turn").alias("last"), "other")
    chosen = said.join(paired, "conv_id")
    answer = (F.col("turn") == F.col("last")) & (F.col("role") == TRAINED)
    rejected = chosen.withColumn("text", F.when(answer, F.col("other")).otherwise(F.col("text")))
    return tuple(turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text") for turns in (chosen, rejected))
