"""Preference pairs: one prompt, and a chosen and a rejected completion with masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is rendered; the content of an assistant's turn and the mark after it are learned.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"


def _side(turns: DataFrame, name: str, pair: str) -> DataFrame:
    return turns.where(F.col(pair).isNotNull()).select(
        F.col(pair).alias("pair"),
        F.lit(name).alias("side"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column) -> Column:
    """Where in the rendered turns the learned characters stand: (start, end) in code points."""
    empty = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("spans"))

    def add(done: Column, turn: Column) -> Column:
        start = done["at"] + F.length(F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE)))
        end = done["at"] + F.length(_rendered(turn))
        span = F.struct(start.alias("start"), (end - 1).alias("end"))
        spans = F.when(turn["role"] == LEARNED_ROLE, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, empty, add, lambda done: done["spans"])


def preference_rows(chosen: DataFrame, rejected: DataFrame, *, pair: str = "pair_id") -> DataFrame:
    """One row for each pair of conversations with turns on both sides.

    `chosen` and `rejected` have `pair`, turn, role and text. Turns are put in order of turn,
    then role and text; a null role or text is empty, a null turn comes first. The turns that
    both begin with, compared by role and text, are rendered once as prompt; the others of each
    side are its completion. Returns `pair`, prompt_turns (how many), prompt, chosen, rejected
    (rendered text) and chosen_mask, rejected_mask: arrays of (start, end), the code points of a
    completion that are learned, which are the contents of assistants' turns with the mark that
    ends them (without its line feed). Equal conversations have empty completions. A repeated
    row is a turn of its own; rows with a null `pair` are left out; other columns may have any
    name, and one side alone makes no row.

    Both sides of all pairs are gathered in one shuffle; a group is a pair of conversations,
    whose text is one row of the result.
    """
    turns = _side(chosen, "c", pair).unionByName(_side(rejected, "r", pair))
    turn = F.struct("turn", "role", "text")
    sides = turns.groupBy("pair").agg(
        F.array_sort(F.collect_list(F.when(F.col("side") == "c", turn))).alias("c"),
        F.array_sort(F.collect_list(F.when(F.col("side") == "r", turn))).alias("r"),
    )
    both = sides.where((F.size("c") > 0) & (F.size("r") > 0))
    differs = F.zip_with("c", "r", lambda a, b: ~(a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])))
    same = F.coalesce(F.array_position(differs, True), F.lit(0))
    shared = both.select("*", (F.when(same > 0, same - 1).otherwise(F.size("c"))).cast("int").alias("n"))
    rest = [F.slice(c, F.col("n") + 1, F.size(c)) for c in ("c", "r")]
    cut = shared.select("pair", "n", F.slice("c", 1, F.col("n")).alias("p"), rest[0].alias("c"), rest[1].alias("r"))
    return cut.select(
        F.col("pair").alias(pair),
        F.col("n").alias("prompt_turns"),
        _joined(F.col("p")).alias("prompt"),
        _joined(F.col("c")).alias("chosen"),
        _joined(F.col("r")).alias("rejected"),
        _spans(F.col("c")).alias("chosen_mask"),
        _spans(F.col("r")).alias("rejected_mask"),
    )
