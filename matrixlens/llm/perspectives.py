"""Chat formatting by perspective rotation.

Every participant of a conversation gets a rendering of the whole dialogue in which that
speaker is the assistant and all others are users by name, together with the spans a loss
should cover: the assistant's text and its end marker.

DataFrame functions only, and no group larger than a part: a conversation is cut, in its order,
into parts of ``ROWS`` rows, so one that holds a third of all rows is many groups.  A dialogue of
no more rows is one row.  Joining the parts of a perspective gives the dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from matrixlens.llm.tables import written
from matrixlens.operators.positions import assign_positions
from matrixlens.session import small_side

#: Rows of a conversation in one part.
ROWS = 1024
#: Roles that set the scene and are nobody's perspective.
NARRATORS = ("system",)
END = "<|end|>"


def _plain(text: Column) -> Column:
    """Keep markers in the content from being read as markers."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate_perspectives(turns: DataFrame, narrators: tuple[str, ...] = NARRATORS, size: int = ROWS) -> DataFrame:
    """Render ``turns`` (conv_id, turn, role, text) once per conversation and participant.

    Returns conv_id, perspective, part, n_turns, text, mask; ``mask`` lists the trained
    spans of ``text`` as ``start-end`` in code points, end exclusive, comma-joined.

    A null text is empty, a null role is ``unknown``; rows without a conversation id form one
    conversation.  Rows are in order of (turn, role, text), those without a turn number first, and
    part p holds the rows of rank ``p * size`` up to ``(p + 1) * size``, counted from 0.  Repeated
    rows are rendered as often as they occur.  A conversation in which only narrators speak has no
    perspective and gives no row; an empty table gives none.  Other columns are not looked at.
    """
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # All rows of a conversation that is one part, and its speakers, are in one list; only longer ones need ranks.
    counted = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > size)
    long = written(counted.select(F.col("conv_id").alias("_conv")))
    n_long = long.count()
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    said = F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("_turns")
    single = turns.join(small_side(long, n_long), same, "left_anti") if n_long else turns
    own = single.groupBy("conv_id").agg(said)
    speakers = F.array_except(F.array_distinct(F.transform("_turns", lambda t: t["role"])), F.array(*map(F.lit, narrators)).cast("array<string>"))
    seen = own.select("conv_id", F.lit(0).cast("long").alias("part"), "_turns", F.explode(speakers).alias("perspective"))
    if n_long:
        placed = assign_positions(turns.join(small_side(long, n_long), same, "left_semi"), "conv_id", "turn", "role", "text", name="_at")
        first = placed.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("_at").alias("_first"))
        ranked = placed.join(small_side(first, n_long), same)
        parts = ranked.groupBy("conv_id", F.floor((F.col("_at") - F.col("_first")) / size).alias("part")).agg(said)
        heard = placed.where(~F.col("role").isin(*narrators)).select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective")).distinct()
        seen = seen.unionByName(parts.join(heard, same).select("conv_id", "part", "_turns", "perspective"))

    def segment(t: Column) -> Column:
        own = t["role"] == F.col("perspective")
        head = (
            F.when(own, F.lit("<|assistant|>\n"))
            .when(t["role"].isin(*narrators), F.concat(F.lit("<|"), _plain(t["role"]), F.lit("|>\n")))
            .otherwise(F.concat(F.lit("<|user name="), _plain(t["role"]), F.lit("|>\n")))
        )
        body = F.concat(_plain(t["text"]), F.lit(END))
        return F.struct(own.alias("own"), head.alias("head"), body.alias("body"))

    segments = seen.withColumn("_said", F.transform("_turns", segment))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def advance(state: Column, s: Column) -> Column:
        begin = state["at"] + F.length(s["head"])
        end = begin + F.length(s["body"])
        span = F.concat_ws("-", begin.cast("string"), end.cast("string"))
        return F.struct((end + 1).alias("at"), F.when(s["own"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return segments.select(
        "conv_id", "perspective", "part",
        F.size("_turns").alias("n_turns"),
        F.array_join(F.transform("_said", lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), "").alias("text"),
        F.aggregate("_said", start, advance, lambda state: F.array_join(state["spans"], ",")).alias("mask"),
    )
