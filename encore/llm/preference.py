"""Operator 1, chat formatting: preference pairs.

The turns of a chosen and a rejected conversation are compared in order; their longest common prefix is rendered
once as the prompt, what follows on either side as its completion, with the character spans that a loss may
see (the words of the assistant; role headers and other roles stay masked). Everything is a grouped aggregate
and array expressions, so it runs inside the JVM; the one shuffle brings a pair's turns together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, MIDDLE, TAIL = "<|", "|>\n", "<|end|>\n"
SIDES = ("chosen", "rejected")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), turn["role"], F.lit(MIDDLE))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(TAIL))), "")


def _spans(turns: Column, roles: tuple[str, ...]) -> Column:
    """Start and end, in the rendered turns, of the text of turns with these roles."""
    step = F.aggregate(
        turns, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(_head(t)) + F.length(t["text"]) + F.length(F.lit(TAIL))).cast("long").alias("at"),
            F.when(t["role"].isin(*roles) & (t["text"] != ""), F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(_head(t))).cast("long").alias("start"),
                (acc["at"] + F.length(_head(t)) + F.length(t["text"])).cast("long").alias("end")))))
            .otherwise(acc["spans"]).alias("spans")))
    return step["spans"]


def preference_examples(turns: DataFrame, pair_col: str = "pair_id", side_col: str = "side", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text", train_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per pair: prompt, chosen, rejected (rendered), their spans, the numbers of turns, and a status.

    ``turns`` holds the turns of both sides, ``side`` being 'chosen' or 'rejected'. Two turns are equal if role and
    text are. Cases: a null text is empty, a null role is 'unknown', rows with a null pair or another side take no
    part; turns come in the order of turn, role, text (a null turn first), exact repeats of a row count once; a pair
    with one side only has status 'missing_chosen' or 'missing_rejected', an empty prompt and an empty completion on
    that side; 'identical' pairs have empty completions; 'chosen_ends' and 'rejected_ends' mean that this side is a
    prefix of the other. Texts of any length; extra columns are ignored; an empty table gives an empty result. A
    pair's distinct turns end up in one row, which is the result asked for (repeats are dropped before the shuffle, and again
    as partial sets meet, so a turn repeated in a third of all rows is held once a task); pairs are independent.
    """
    turn = F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = turns.where(F.col(pair_col).isNotNull() & F.col(side_col).isin(*SIDES)).select(
        F.col(pair_col).alias("pair_id"), F.col(side_col).alias("side"), turn.alias("t"))
    both = rows.groupBy("pair_id").agg(*(F.array_sort(F.collect_set(F.when(F.col("side") == s, F.col("t")))).alias(s) for s in SIDES))
    same = F.zip_with("chosen", "rejected", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    first = F.array_position(same, False)
    n = F.when(first > 0, first - 1).otherwise(F.least(F.size("chosen"), F.size("rejected"))).cast("int")
    cut = both.withColumn("n_prompt_turns", n)
    rest = lambda s: F.slice(F.col(s), F.col("n_prompt_turns") + 1, F.greatest(F.size(s) - F.col("n_prompt_turns"), F.lit(0)))
    cut = cut.withColumns({"c": rest("chosen"), "r": rest("rejected"), "p": F.slice("chosen", F.lit(1), F.col("n_prompt_turns"))})
    status = F.when(F.size("chosen") == 0, "missing_chosen").when(F.size("rejected") == 0, "missing_rejected") \
        .when((F.size("c") == 0) & (F.size("r") == 0), "identical").when(F.size("c") == 0, "chosen_ends") \
        .when(F.size("r") == 0, "rejected_ends").otherwise("pair")
    return cut.select("pair_id", "n_prompt_turns", F.size("c").alias("n_chosen_turns"), F.size("r").alias("n_rejected_turns"), status.alias("status"),
                      _render(F.col("p")).alias("prompt"), _render(F.col("c")).alias("chosen"), _render(F.col("r")).alias("rejected"),
                      _spans(F.col("c"), train_roles).alias("chosen_spans"), _spans(F.col("r"), train_roles).alias("rejected_spans"))


def swapped_answers(conversations: DataFrame, role: str = "assistant") -> DataFrame:
    """Pairs made from ``conversations`` (conv_id, turn, role, text): every conversation is the chosen side, the
    rejected one ends with the last answer of the next conversation (conv_id + 1) in place of its own.

    What follows a conversation's last answer is left out on the rejected side; without a next conversation that has
    an answer, the rejected side stops before the answer; conversations without an answer make no pair. Rows with a
    null conv_id take no part. Turns with the same number share a place: the last answer is the one with the
    greatest turn, then text.
    """
    c = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"))
    last = c.where(F.col("role") == role).groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("answer"))
    has = last.select("pair_id", F.col("answer.turn").alias("at"))
    chosen = c.join(has, "pair_id").select("pair_id", "turn", "role", "text", "at")
    other = last.select((F.col("pair_id") - 1).alias("pair_id"), F.col("answer.text").alias("text"))
    swapped = has.join(other, "pair_id").select("pair_id", F.col("at").alias("turn"), F.lit(role).alias("role"), "text")
    tagged = lambda d, s: d.select("pair_id", F.lit(s).alias("side"), "turn", "role", "text")
    return tagged(chosen, "chosen").unionByName(tagged(chosen.where("turn < at"), "rejected")).unionByName(tagged(swapped, "rejected"))
