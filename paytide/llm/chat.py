"""Preference formatting: a shared prompt and two masked completions.

A pair has a chosen and a rejected conversation. The longest common prefix of their turns
(role and text alike) is rendered once as the prompt; what follows in either is its completion.
Only what an assistant says counts for training: each completion comes with its segments and a
flag for each, and with the character ranges of the flagged ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(MIDDLE), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair of ``pairs`` (pair_id, chosen, rejected: conversation ids).

    ``turns`` has conv_id, turn, role, text. Turns are numbered by turn, role and text, nulls
    first, so repeated rows and equal turn numbers have a fixed order. Returns pair_id, chosen,
    rejected, prefix_turns, prompt, chosen_completion, rejected_completion, and chosen_mask and
    rejected_mask: ``start-end`` ranges of the completion that are trained, comma-joined. A
    missing conversation has no turns: the prompt is then empty and its completion null. Null
    roles and texts render as empty and equal only null. A conversation is rendered by one
    task, since its text is one value of one row.
    """
    sides = pairs.select("pair_id", F.explode(F.array(
        F.struct(F.lit(True).alias("is_chosen"), F.col("chosen").alias("conv_id")),
        F.struct(F.lit(False).alias("is_chosen"), F.col("rejected").alias("conv_id")),
    )).alias("s")).select("pair_id", "s.*").filter("conv_id IS NOT NULL")
    order = Window.partitionBy("pair_id", "is_chosen").orderBy("turn", "role", "text")
    rows = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text").join(sides, "conv_id")
    rows = rows.withColumn("i", F.row_number().over(order) - 1)
    # a place is common if both sides have it and it is alike; the prefix ends before the first that is not
    said = F.struct("role", "text")
    places = rows.groupBy("pair_id", "i").agg(
        (F.max(F.when(F.col("is_chosen"), F.struct(F.lit(1), said))).eqNullSafe(F.max(F.when(~F.col("is_chosen"), F.struct(F.lit(1), said))))).alias("same")
    )
    prefix = places.groupBy("pair_id").agg(F.coalesce(F.min(F.when(~F.col("same"), F.col("i"))), F.max("i") + 1).alias("prefix_turns"))
    rows = rows.join(prefix, "pair_id")
    piece = F.struct("i", rendered(F.col("role"), F.col("text")).alias("t"), (F.col("role") == "assistant").alias("train"), F.length(F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit(MIDDLE))).alias("head"))
    common = F.col("i") < F.col("prefix_turns")

    def told(side: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(side & ~common, piece)))

    whole = rows.groupBy("pair_id").agg(
        F.first("prefix_turns").alias("prefix_turns"),
        F.sort_array(F.collect_list(F.when(F.col("is_chosen") & common, piece))).alias("p"),
        told(F.col("is_chosen")).alias("c"),
        told(~F.col("is_chosen")).alias("r"),
        F.max("is_chosen").alias("has_c"),
        F.max(~F.col("is_chosen")).alias("has_r"),
    )

    def text_of(pieces: str) -> Column:
        return F.array_join(F.transform(pieces, lambda x: x["t"]), "")

    def mask(pieces: str) -> Column:
        """Ranges from after an assistant turn's header to the end of its closing mark."""
        lengths = F.aggregate(
            pieces,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
            lambda s, x: F.struct(
                (s["at"] + F.length(x["t"])).alias("at"),
                F.when(
                    F.coalesce(x["train"], F.lit(False)),
                    F.array_append(s["out"], F.concat_ws("-", (s["at"] + x["head"]).cast("string"), (s["at"] + F.length(x["t"])).cast("string"))),
                ).otherwise(s["out"]).alias("out"),
            ),
        )
        return F.array_join(lengths["out"], ",")

    return pairs.select("pair_id", "chosen", "rejected").join(whole, "pair_id", "left").select(
        "pair_id",
        "chosen",
        "rejected",
        F.coalesce("prefix_turns", F.lit(0)).cast("int").alias("prefix_turns"),
        F.coalesce(text_of("p"), F.lit("")).alias("prompt"),
        F.when(F.col("has_c"), text_of("c")).alias("chosen_completion"),
        F.when(F.col("has_r"), text_of("r")).alias("rejected_completion"),
        F.when(F.col("has_c"), mask("c")).alias("chosen_mask"),
        F.when(F.col("has_r"), mask("r")).alias("rejected_mask"),
    )


def neighbouring_pairs(turns: DataFrame) -> DataFrame:
    """Pairs for a table that names none: conversation 2k is chosen, 2k+1 rejected.

    A missing neighbour leaves that side null.
    """
    ids = turns.filter("conv_id IS NOT NULL").select("conv_id").distinct()
    at = F.shiftright("conv_id", 1)
    even = F.pmod("conv_id", F.lit(2)) == 0
    return ids.groupBy(at.alias("pair_id")).agg(
        F.max(F.when(even, F.col("conv_id"))).alias("chosen"), F.max(F.when(~even, F.col("conv_id"))).alias("rejected")
    )
