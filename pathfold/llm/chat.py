"""Preference formatting of paired conversations.  DataFrame functions only.

A pair is a chosen and a rejected conversation.  Their longest common prefix of
turns is rendered once, as the prompt; what follows it on either side is that
side's completion, in which only the assistant's turns are trained on.

The result is one row per rendered turn rather than per conversation, so a
conversation of any length is spread over tasks by (pair, turn); the first
turn that differs is a minimum combined map-side.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = ("chosen", "rejected")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def preference_turns(turns: DataFrame) -> DataFrame:
    """Rows of ``turns`` (pair_id, side, turn, role, text) as prompt or completion.

    Returns pair_id, part (prompt, chosen or rejected), turn, role, text,
    rendered, trained (the turn counts for the loss).  Turns are alike if role
    and text are (nulls alike); a turn given several times in a conversation is
    alike if all its rows are, and each row is returned; rows of equal
    conversations are all prompt.  Rows with a null pair_id, turn or another side
    than chosen and rejected belong to no conversation, and a pair with one side
    only is none: neither is returned.  Other columns are not read.
    """
    own = (turns.where(F.col("pair_id").isNotNull() & F.col("turn").isNotNull() & F.col("side").isin(*SIDES))
           .groupBy("pair_id", "side", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")))
    content = F.struct("role", "text", "n")
    by_turn = own.groupBy("pair_id", "turn").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("side") == s, content))).alias(s) for s in SIDES])
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    pairs = by_turn.groupBy("pair_id").agg(
        F.min(F.when(differs, F.col("turn"))).alias("first_diff"),
        *[F.max(F.size(s) > 0).alias(f"any_{s}") for s in SIDES]).where("any_chosen and any_rejected")
    joined = by_turn.join(pairs, "pair_id")
    common = F.col("first_diff").isNull() | (F.col("turn") < F.col("first_diff"))
    part = lambda name, side: F.transform(side, lambda x: F.struct(
        F.lit(name).alias("part"), x["role"].alias("role"), x["text"].alias("text"), x["n"].alias("n")))
    rows = joined.select("pair_id", "turn", F.inline(F.when(common, part("prompt", "chosen")).otherwise(
        F.concat(part("chosen", "chosen"), part("rejected", "rejected")))))
    each = rows.select("pair_id", "part", "turn", "role", "text", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("_"))
    return each.select("pair_id", "part", "turn", "role", "text", rendered(F.col("role"), F.col("text")).alias("rendered"),
                       ((F.col("part") != "prompt") & F.col("role").eqNullSafe(F.lit("assistant"))).alias("trained"))


def preference_texts(rows: DataFrame) -> DataFrame:
    """pair_id, prompt, chosen, rejected (texts) and the trained character spans
    of both completions: one row per pair, for pairs that fit one."""
    out = None
    for name in ("prompt", *SIDES):
        part = F.array_sort(F.collect_list(F.when(F.col("part") == name, F.struct("turn", "role", "rendered", "trained"))))
        col = [F.array_join(F.transform(part, lambda x: x["rendered"]), "").alias(name),
               F.transform(part, lambda x: F.struct(F.length(x["rendered"]).alias("length"), x["trained"].alias("trained"))).alias(f"{name}_mask")]
        out = (out or []) + col
    return rows.groupBy("pair_id").agg(*out).drop("prompt_mask")
