"""Chat formatting from every participant's point of view.

For each participant of a conversation the dialogue is rendered with that speaker as the
assistant and all others as users who are named; system turns stay as they are and are
nobody's view. A turn reads ``<|role name|>`` and a line break, its text, ``<|end|>`` and a line
break. The mask marks what is learnt from: the text and the end mark of the assistant's
turns.

A dialogue comes in *parts* of ``PART_TURNS`` turn numbers, so that a conversation of any
length is never one row or one task's work while turn numbers are its own; all turns
without a number, or with the same one, are one part and so one row. ``start`` says where in the whole rendering a
part begins, and the parts of a view, laid end to end, are the whole. The running start is
summed over parts, not over turns.

Defined results: a null role is the speaker ``unknown``; a null text is empty; turns that
share a number are put in order by role and text; null turn numbers form a part of their
own that comes first; turns without a conversation id form one conversation; a
conversation of system turns only has no view. Other columns are not read, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import same, stored

PART_TURNS = 256
SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>"


def render_views(
    turns: DataFrame,
    conversation_column: str,
    turn_column: str,
    role_column: str,
    text_column: str,
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """Per conversation, view and part: ``conv, view, part, n_turns, start, text, masks``,
    the last an array of ``start, end`` within the part's text, in characters."""
    part = F.floor(F.col(turn_column) / F.lit(part_turns)).cast("bigint")
    said = turns.select(
        F.col(conversation_column).alias("conv"),
        part.alias("part"),
        F.col(turn_column).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_column), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    # Everyone who speaks in a conversation, for each of its parts.
    speakers = (
        said.filter(F.col("role") != SYSTEM)
        .select(F.col("conv").alias("c"), F.col("role").alias("view"))
        .distinct()
    )
    parts = stored(
        said.groupBy("conv", "part").agg(
            F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("said")
        ),
        "parts",
    )
    views = parts.join(speakers, same(F.col("conv"), F.col("c"))).drop("c")

    def header(turn):
        as_user = F.concat(F.lit("<|user "), turn["role"], F.lit("|>\n"))
        return (
            F.when(turn["role"] == SYSTEM, F.lit("<|system|>\n"))
            .when(turn["role"] == F.col("view"), F.lit("<|assistant|>\n"))
            .otherwise(as_user)
        )

    pieces = views.select(
        "conv",
        "view",
        "part",
        F.transform(
            "said",
            lambda turn: F.struct(
                header(turn).alias("head"),
                F.concat(turn["text"], F.lit(END)).alias("body"),
                (turn["role"] == F.col("view")).alias("learnt"),
            ),
        ).alias("turns"),
    )
    # The end of each turn's body within the part, its line break left out.
    lengths = F.transform(
        "turns", lambda t: (F.length(t["head"]) + F.length(t["body"]) + 1).cast("bigint")
    )
    ends = F.aggregate(
        lengths,
        F.array(F.lit(0).cast("bigint")),
        lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)),
    )
    spans = F.transform(
        "turns",
        lambda t, i: F.struct(
            (F.get("ends", i + 1) - 1 - F.length(t["body"])).alias("start"),
            (F.get("ends", i + 1) - 1).alias("end"),
            t["learnt"].alias("learnt"),
        ),
    )
    rendered = pieces.withColumn("ends", ends).select(
        "conv",
        "view",
        "part",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.element_at("ends", -1).alias("length"),
        F.concat_ws(
            "", F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit("\n")))
        ).alias("text"),
        F.transform(
            F.filter(spans, lambda s: s["learnt"]),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
        ).alias("masks"),
    )
    # One small row per part: where each begins.
    before = Window.partitionBy("conv", "view").orderBy(F.col("part").asc_nulls_first())
    starts = F.coalesce(
        F.sum("length").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rendered = stored(rendered, "views")
    placed = rendered.select("conv", "view", "part", starts.alias("start")).select(
        F.col("conv").alias("c"), F.col("view").alias("v"), F.col("part").alias("p"), "start"
    )
    on = (
        same(F.col("conv"), F.col("c"))
        & (F.col("view") == F.col("v"))
        & same(F.col("part"), F.col("p"))
    )
    return rendered.join(placed, on).select(
        "conv", "view", "part", "n_turns", "start", "text", "masks"
    )
