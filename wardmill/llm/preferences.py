"""Preference pairs for chat models, with DataFrame functions only.

A conversation is an array of turns (role, text) in turn order. ``formatted`` takes pairs of such arrays, finds the longest
common prefix of whole turns, renders it once as the prompt, and renders what follows in either conversation as its
completion. The loss covers what the assistant says in a completion: ``spans`` of it in characters, end included in no span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands before and after a turn's text.
HEAD, MIDDLE, TAIL = "<|", "|>\n", "<|end|>\n"
ASSISTANT = "assistant"


def conversations(turns: DataFrame, id_: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``id`` and ``turns`` (role, text; null is empty), a row per conversation.

    Turns lie in the order of turn number (null first), role and text; repeated rows stay. Rows without an id are left out.
    """
    kept = turns.where(F.col(id_).isNotNull()).select(
        F.col(id_).alias("id"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("one"))
    listed = kept.groupBy("id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    return listed.select("id", F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def _last_reply(turns: Column) -> Column:
    """Place of the assistant's last turn from 1; 0 if there is none."""
    return F.coalesce(F.array_max(F.transform(turns, lambda x, i: F.when(x["role"] == ASSISTANT, i + 1).otherwise(0))), F.lit(0))


def pairs(talks: DataFrame) -> DataFrame:
    """``chosen_id``, ``rejected_id``, ``chosen``, ``rejected``: one pair for each conversation with a reply.

    A conversation ends with its last reply here. Of conversations with the same first turn, that with the smallest id is
    what all others are preferred to. That one, and any with a first turn of its own, is preferred to itself with the last
    reply replaced by the reply before it, or by nothing where there is none; rejected_id is then null.
    """
    ended = talks.withColumn("last", _last_reply(F.col("turns"))).where("last > 0").select("id", F.slice("turns", 1, F.col("last")).alias("turns"), "last")
    ended = ended.withColumns({"role": F.get("turns", F.lit(0))["role"], "opening": F.get("turns", F.lit(0))["text"]})
    firsts = ended.groupBy("role", "opening").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("role", "opening", "first")
    other = ended.select(F.col("id").alias("first"), F.col("turns").alias("first_turns"))
    matched = ended.join(firsts, ["role", "opening"], "left").withColumn("first", F.when(F.col("first") != F.col("id"), F.col("first")))
    alone = matched.where("first is null")
    replies = F.filter(F.slice("turns", 1, F.col("last") - 1), lambda x: x["role"] == ASSISTANT)
    worse = F.struct(F.lit(ASSISTANT).alias("role"), F.coalesce(F.try_element_at(replies, F.lit(-1))["text"], F.lit("")).alias("text"))
    alone = alone.select(F.col("id").alias("chosen_id"), F.lit(None).cast(talks.schema["id"].dataType).alias("rejected_id"), F.col("turns").alias("chosen"),
                         F.concat(F.slice("turns", 1, F.col("last") - 1), F.array(worse)).alias("rejected"))
    matched = matched.where("first is not null").join(other, "first")
    return alone.unionByName(matched.select(F.col("id").alias("chosen_id"), F.col("first").alias("rejected_id"), F.col("turns").alias("chosen"), F.col("first_turns").alias("rejected")))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(F.lit(HEAD), x["role"], F.lit(MIDDLE), x["text"], F.lit(TAIL))), "")


def _spans(turns: Column) -> Column:
    """Start and end of each reply in the rendered turns; its end mark is learned, too, its role is not."""
    around = len(HEAD) + len(MIDDLE) + len(TAIL)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + len(HEAD) + F.length(x["role"]) + len(MIDDLE)
        after = state["at"] + around + F.length(x["role"]) + F.length(x["text"])
        span = F.struct(begin.cast("long").alias("start"), (after - 1).cast("long").alias("end"))
        return F.struct(after.cast("long").alias("at"), F.when(x["role"] == ASSISTANT, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, start, step)["spans"]


def formatted(paired: DataFrame) -> DataFrame:
    """Adds ``n_common``, ``prompt``, ``chosen_text``, ``chosen_spans``, ``rejected_text``, ``rejected_spans``.

    Turns are common if role and text are equal; null turns are equal to each other. Equal conversations leave two empty completions.
    """
    short = F.least(F.size("chosen"), F.size("rejected"))
    differs = F.filter(F.sequence(F.lit(1), F.greatest(short, F.lit(1))),
                       lambda i: (i <= short) & ~F.try_element_at("chosen", i).eqNullSafe(F.try_element_at("rejected", i)))
    common = F.coalesce(F.array_min(differs) - 1, short)
    out = paired.withColumn("n_common", common)
    out = out.withColumn("prompt", _render(F.slice("chosen", F.lit(1), F.col("n_common"))))
    for side in ("chosen", "rejected"):
        rest = F.slice(side, F.col("n_common") + 1, F.size(side))
        out = out.withColumns({f"{side}_text": _render(rest), f"{side}_spans": _spans(rest)})
    return out
