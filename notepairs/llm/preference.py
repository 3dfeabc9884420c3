"""Preference formatting: one shared prompt and two masked completions a pair.

A pair is a chosen and a rejected conversation. Their longest common turn prefix, equal in
role and text, is rendered once as the prompt; what follows on either side is rendered as
its completion. A completion is a list of segments with a flag: only the text of assistant
turns and its end mark is trained on. Prompt and completion together are the rendering of
the whole conversation.

Defined cases: a null role or text counts as empty; turns stand in the order of turn,
role, text, with nulls first, so repeated rows are turns of their own; a pair with one
side alone has no rejected or chosen completion; ``usable`` tells pairs whose completions
differ and both hold an assistant turn; texts of any length are rendered whole; an empty
table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notepairs.functions.text import settle

# The public chat markup.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"


def _turns(df: DataFrame, side: int) -> DataFrame:
    role, text = (F.coalesce(df[c].cast("string"), F.lit("")) for c in ("role", "text"))
    return df.select(df["pair_id"], F.struct(df["turn"].cast("long").alias("turn"), role.alias("role"), text.alias("text")).alias("t"), F.lit(side).alias("side"))


def render(turn: Column) -> Column:
    """One turn with its marks."""
    return F.concat(F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(END))


def segments(turns: Column) -> Column:
    """Text pieces of the turns in order, with ``trained`` set for what assistants say."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.concat(F.lit(START), t["role"], F.lit("\n")).alias("text"), F.lit(False).alias("trained")),
        F.struct(F.concat(t["text"], F.lit(END)).alias("text"), (t["role"] == TRAINED).alias("trained")),
    )))


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``pair_id, prefix_turns, prompt, chosen, rejected, usable`` from turns ``pair_id, turn, role, text``.

    ``chosen`` and ``rejected`` are lists of segments. A conversation is gathered in one
    row, since its rendering is one value of the result.
    """
    return _formatted(_turns(chosen, 0).unionByName(_turns(rejected, 1)).groupBy("pair_id").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("side") == i, F.col("t")))).alias(name) for i, name in enumerate(("_c", "_r"))]
    ))


def _formatted(both: DataFrame) -> DataFrame:
    """The result, from rows ``pair_id, _c, _r`` with the turns of either side in order."""
    same = F.zip_with("_c", "_r", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    both = settle(both.withColumn("_same", same), "_same")
    first = F.array_position("_same", False)
    both = settle(both.withColumn("_n", F.when(first > 0, first - 1).otherwise(F.size("_same")).cast("int")), "_n")
    rest = [F.slice(c, F.col("_n") + 1, F.size(c)) for c in ("_c", "_r")]
    speaks = [F.exists(r, lambda t: t["role"] == TRAINED) for r in rest]
    prompt = F.array_join(F.transform(F.slice("_c", 1, F.col("_n")), render), "")
    return both.select(
        "pair_id", F.col("_n").cast("long").alias("prefix_turns"), prompt.alias("prompt"), segments(rest[0]).alias("chosen"),
        segments(rest[1]).alias("rejected"), (speaks[0] & speaks[1]).alias("usable"),
    )


def completion(parts: Column) -> Column:
    """The text of a list of segments."""
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def mask(parts: Column) -> Column:
    """Lengths of the segments in characters, each after ``1:`` if it is trained on, else ``0:``."""
    return F.array_join(F.transform(parts, lambda s: F.concat(F.when(s["trained"], F.lit("1:")).otherwise(F.lit("0:")), F.length(s["text"]).cast("string"))), ",")


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """``preference_pairs`` of every conversation of ``conv_id, turn, role, text``, the rejected side made from a neighbour.

    On the rejected side, the last assistant turn says what the last assistant turn of the
    neighbour says, the conversation whose id differs in the lowest bit; all other turns,
    those behind it too, stand on both sides. A conversation without an assistant turn, or
    whose neighbour has none or does not exist, has an empty rejected side and is not
    ``usable``; rows without an id are one conversation without a neighbour.

    Neighbours are dealt to the same task, so texts move once.
    """
    rows = _turns(turns.select(turns["conv_id"].alias("pair_id"), turns["turn"], turns["role"], turns["text"]), 0)
    dealt = rows.withColumn("_couple", F.shiftright("pair_id", 1)).repartition("_couple")
    talks = dealt.groupBy("_couple", "pair_id").agg(F.sort_array(F.collect_list("t")).alias("_c"))
    behind = F.array_position(F.reverse(F.transform("_c", lambda t: t["role"] == TRAINED)), True)
    talks = settle(talks.withColumn("_at", F.when(behind > 0, F.size("_c") - behind).cast("int")), "_at")
    talks = talks.withColumn("_reply", F.get("_c", F.col("_at"))["text"])
    odd = F.pmod("pair_id", F.lit(2)) == 1
    couple = Window.partitionBy("_couple")
    said = lambda which: F.max(F.when(which, F.col("_reply"))).over(couple)
    talks = talks.withColumn("_other", F.when(odd, said(~odd)).otherwise(said(odd)))
    swapped = F.transform("_c", lambda t, i: F.when(i == F.col("_at"), t.withField("text", F.col("_other"))).otherwise(t))
    paired = F.col("_at").isNotNull() & F.col("_other").isNotNull()
    return _formatted(talks.select("pair_id", "_c", F.when(paired, swapped).otherwise(F.slice("_c", 1, 0)).alias("_r")))
