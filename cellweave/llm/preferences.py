"""Preference pairs for training: a shared prompt and two masked completions.

The longest common prefix of turns of the chosen and the rejected conversation is rendered once as the prompt; the turns
after it are the completions. A completion carries the spans of its text that count for the loss: what the
assistant says and the mark that ends its turn, but neither headers nor the turns of others.

Turns are gathered per conversation, and a pair is formed in one row, by array expressions only. A conversation is as large
as its own turns; equal conversations under different ids stay apart, so a frequent conversation or first turn gathers
nothing.

Defined cases: turns without a conversation id are left out; repeated turns (all of number, role and text equal) are one;
turns with the same number are ordered by role and text, nulls first; a null role is ``user``, a null text is empty; the
template's marks inside a text are broken by a space; equal conversations have empty completions; a pair whose other
side has no turn shares nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the public ChatML template.
BEGIN, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def gathered(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``id, turns``: the turns of each conversation in their order, as ``role, text``."""
    rows = turns.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("id"), F.struct(
        F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text")).alias("t"))
    ordered = F.array_sort(F.collect_set("t"))
    return rows.groupBy("id").agg(F.transform(ordered, lambda x: F.struct(
        F.coalesce(x["role"], F.lit("user")).alias("role"), F.coalesce(x["text"], F.lit("")).alias("text"))).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """How many turns two conversations begin with alike."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first_other = F.array_position(same, F.lit(False)).cast("int")
    return F.when(first_other > 0, first_other - 1).otherwise(F.size(a))


def _safe(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(BEGIN), F.lit("< |im_start|>")), F.lit(END), F.lit("< |im_end|>"))


def _header(x: Column) -> Column:
    return F.concat(F.lit(BEGIN), _safe(x["role"]), F.lit("\n"))


def _body(x: Column) -> Column:
    return F.concat(_safe(x["text"]), F.lit(END))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(_header(x), _body(x), F.lit("\n"))), "")


def spans(turns: Column) -> Column:
    """``start, end`` in code points of what counts for the loss, in the rendered turns."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(_header(x))
        end = start + F.char_length(_body(x))
        here = F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end")))
        return F.struct((end + 1).cast("int").alias("at"),
                        F.when(x["role"] == ASSISTANT, F.concat(acc["found"], here)).otherwise(acc["found"]).alias("found"))

    return F.aggregate(turns, begin, step, lambda acc: acc["found"])


def formatted(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Pairs of conversations (arrays of ``role, text``) rendered: all columns of ``pairs`` packed as ``pair``, with
    ``prompt_turns, prompt, chosen, chosen_spans, rejected, rejected_spans``."""
    none = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.select(F.struct(*[F.col(f"`{c}`") for c in pairs.columns]).alias("pair"),
                         F.coalesce(F.col(f"`{chosen}`"), none).alias("good"), F.coalesce(F.col(f"`{rejected}`"), none).alias("bad"))
    cut = sides.withColumn("n", common_turns(F.col("good"), F.col("bad")))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c), F.lit(1)))
    parts = cut.select("pair", "n", F.slice("good", F.lit(1), F.col("n")).alias("shared"), rest("good").alias("good"), rest("bad").alias("bad"))
    return parts.select("pair", F.col("n").alias("prompt_turns"), rendered(F.col("shared")).alias("prompt"),
                        rendered(F.col("good")).alias("chosen"), spans(F.col("good")).alias("chosen_spans"),
                        rendered(F.col("bad")).alias("rejected"), spans(F.col("bad")).alias("rejected_spans"))


def last_answer_pairs(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``pair_id, chosen, rejected`` from a plain table of conversations with integer ids.

    Chosen is the conversation up to its last answer; rejected has, in place of that answer, the last answer of the
    conversation whose id differs in the lowest bit. Conversations without an answer on either side form no pair.
    """
    whole = gathered(turns, key, turn, role, text)
    last = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda x: x["role"] == ASSISTANT)), F.lit(True)) + 1
    answered = (whole.where(F.exists("turns", lambda x: x["role"] == ASSISTANT)).withColumn("last", last.cast("int"))
                .select("id", F.slice("turns", F.lit(1), F.col("last")).alias("turns"), F.element_at("turns", F.col("last")).alias("answer")))
    other = answered.select(F.col("id").bitwiseXOR(F.lit(1)).alias("id"), F.col("answer").alias("other"))
    return answered.join(other, "id").select(
        F.col("id").alias("pair_id"), F.col("turns").alias("chosen"),
        F.concat(F.slice("turns", F.lit(1), F.size("turns") - 1), F.array("other")).alias("rejected"))


def spans_text(spans_: Column) -> Column:
    """Spans as text, ``12-40,55-80``."""
    return F.array_join(F.transform(spans_, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
