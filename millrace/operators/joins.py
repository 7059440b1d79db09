"""Joins against large tables whose keys may be badly skewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import time_bucket


def rows_without_match(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str
) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``.

    ``right`` is reduced to its distinct keys first, on the map side too, so a key
    repeated many times crosses the shuffle once per task. The aggregation leaves
    it partitioned by the key, so the join adds no shuffle on that side.
    """
    keys = right.select(F.col(right_key).alias(left_key)).distinct()
    return left.join(keys, left_key, "left_anti")


def keys_in_first_only(
    first: DataFrame, first_key: str, second: DataFrame, second_key: str, name: str
) -> DataFrame:
    """Distinct keys of ``first`` that ``second`` does not have, as column ``name``.

    Both sides are made distinct before they meet: few values spread over many
    rows would otherwise put all rows of a value into one task.
    """
    left = first.select(F.col(first_key).alias(name)).distinct()
    right = second.select(F.col(second_key).alias(name)).distinct()
    return left.subtract(right)


def last_before(
    df: DataFrame,
    key: str,
    ts: str,
    row_id: str,
    source: Column,
    target: Column,
    chunk: str = "1 hour",
    piece: str = "1 second",
) -> DataFrame:
    """As-of join: for each ``target`` row the last ``source`` row of the same key
    before it, by ``(ts, row_id)``.

    Returns ``key, row_id, ts, source_id, source_ts``, the last two null where
    there is none. A row without key or time matches nothing.

    A window over all rows of a key would sort a hot key in one task. Rows are
    partitioned by key and time instead, in pieces (which should divide the chunks),
    and searched within their piece. What earlier pieces hand on is one row per key
    and piece: it is carried along within a chunk, and over chunks as one row per key
    and chunk. So no window holds more rows than a piece has, a chunk has pieces, or
    the data's time range has chunks, however many rows the key has. All steps share
    one shuffle of the rows.
    """
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    rows = (
        df.filter((source | target) & known)
        .select(
            key,
            ts,
            row_id,
            source.alias("_source"),
            target.alias("_target"),
            time_bucket(ts, chunk).alias("_chunk"),
        )
        .withColumn("_piece", time_bucket(ts, piece))
        # All steps name the same columns and conditions, so that they share the shuffle.
        .filter(F.col("_chunk").isNotNull() & F.col("_piece").isNotNull())
        .repartition(key, "_chunk", "_piece")
    )
    mark = F.when(F.col("_source"), F.struct(ts, row_id))

    within = (
        Window.partitionBy(key, "_chunk", "_piece")
        .orderBy(ts, row_id)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    targets = rows.withColumn("_here", F.last(mark, ignorenulls=True).over(within))

    def so_far(*keys: str, order: str) -> Column:
        rows_before = (Window.unboundedPreceding, -1)
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(*rows_before)
        return F.last("_last", ignorenulls=True).over(window)

    pieces = rows.groupBy(key, "_chunk", "_piece").agg(
        F.max(mark).alias("_last"), F.max("_target").alias("_wanted")
    )
    chunks = (
        pieces.groupBy(key, "_chunk")
        .agg(F.max("_last").alias("_last"), F.max("_wanted").alias("_needed"))
        .withColumn("_before", so_far(key, order="_chunk"))
        .filter("_needed")
        .select(key, "_chunk", "_before")
    )
    carried = (
        pieces.withColumn("_within", so_far(key, "_chunk", order="_piece"))
        .filter("_wanted")
        .join(chunks, [key, "_chunk"])
        .select(
            key, "_chunk", "_piece", F.coalesce("_within", "_before").alias("_carried")
        )
        .filter(F.col("_carried").isNotNull())
    )
    found = F.coalesce("_here", "_carried")
    matched = (
        targets.filter("_target")
        .join(carried, [key, "_chunk", "_piece"], "left")
        .select(
            key,
            row_id,
            ts,
            found[row_id].alias("source_id"),
            found[ts].alias("source_ts"),
        )
    )
    nothing = [
        F.lit(None).cast(matched.schema[name].dataType).alias(name)
        for name in ("source_id", "source_ts")
    ]
    unknown = df.filter(target & ~known).select(key, row_id, ts, *nothing)
    return matched.unionByName(unknown)
