"""Chat formatting: every dialogue once from the side of each of its speakers, in DataFrames only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import attach
from marquee.operators.ordering import numbered
from marquee.session import durable

SYSTEM = "system"
NAMELESS = "unknown"
# A dialogue comes in parts of so many turns; its parts in order are the whole.
PART_TURNS = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _clean(text: Column) -> Column:
    """Markers inside a text are broken up, so that no text can end its own turn."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _name(speaker: Column) -> Column:
    return F.regexp_replace(speaker, "[^0-9A-Za-z_-]", "_")


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, perspective, part, n_turns, text, mask``: each part of each dialogue for each speaker.

    Speakers are the distinct roles of a dialogue but for ``system``. For each of
    them its own turns are those of the assistant, those of others of users with
    their names, and system turns stay. ``mask`` lists the spans, in code points
    of the part's text with the end exclusive, that the assistant says, its end
    marker included. Turns come by number, ties by role and text, null ones first;
    a null role is a speaker ``unknown``, a null text is empty, a null id is a
    dialogue like any other, and repeated rows are repeated turns. Dialogues of
    system turns alone have no speaker and so no row; an empty table has none.
    Other columns are not read.

    A dialogue is cut into parts of ``part_turns`` turns, so a very long one is
    spread over tasks like any others; ``part`` counts them from 0.
    """
    own = F.col(conv_id)
    key = F.when(own.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), own.cast("string")))
    read = turns.select(
        key.alias("key"), own.alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(NAMELESS)).alias("role"), _clean(F.col(text)).alias("text"))
    placed = durable(numbered(read, ["key"], ["turn", "role", "text"], "number"), "turns")
    speakers = durable(placed.groupBy("key").agg(
        F.array_sort(F.collect_set(F.when(F.col("role") != SYSTEM, F.col("role")))).alias("speakers"),
        F.count("*").alias("n")), "speakers")
    seen = (attach(placed, speakers, "key", "n", placed.count())
            .withColumn("perspective", F.explode("speakers")))
    spoken = F.col("role") == F.col("perspective")
    head = (F.when(spoken, F.lit("assistant"))
            .when(F.col("role") == SYSTEM, F.lit(SYSTEM))
            .otherwise(F.concat(F.lit("user name="), _name(F.col("role")))))
    rendered = seen.select(
        "key", "conv_id", "perspective", F.floor((F.col("number") - 1) / part_turns).cast("long").alias("part"),
        F.struct("number", F.concat(F.lit(OPEN), head, F.lit("\n")).alias("head"),
                 F.concat("text", F.lit(CLOSE)).alias("said"), spoken.alias("spoken")).alias("segment"))
    parts = rendered.groupBy("key", "perspective", "part").agg(
        F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list("segment")).alias("segments"))

    def add(state: Column, s: Column) -> Column:
        start = state["at"] + F.length(s["head"])
        end = start + F.length(s["said"])
        span = F.concat(start.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(s["spoken"], F.concat(state["spans"], F.array(span)))
                        .otherwise(state["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    spans = F.aggregate("segments", begin, add, lambda state: state["spans"])
    return parts.select(
        "conv_id", "perspective", "part", F.size("segments").cast("long").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["said"])), "").alias("text"),
        F.array_join(spans, ",").alias("mask"))
