"""Sessions of a key: runs of rows without a pause longer than a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import interval, time_bucket


def sessionize(df: DataFrame, key: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    """``key, session_start, session_end, n_rows``; the end is the last row plus
    ``gap``, and a pause of exactly ``gap`` does not end a session.

    Rows of a key in one time bucket of length ``gap`` always share a session, so
    they are first reduced to one row per key and bucket, on the map side too. The
    window over a key then holds at most one row per ``gap`` of the data's time
    range, however many rows the key has.
    """
    panes = df.groupBy(key, time_bucket(ts, gap).alias("_pane")).agg(
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.count(F.lit(1)).alias("_n"),
    )
    in_order = Window.partitionBy(key).orderBy("_pane")
    pause = F.col("_first") - F.lag("_last").over(in_order)
    opens = F.coalesce(pause > interval(gap), F.lit(True)).cast("int")
    numbered = panes.withColumn("_opens", opens).withColumn(
        "_session",
        F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
    )
    return (
        numbered.groupBy(key, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            (F.max("_last") + interval(gap)).alias("session_end"),
            F.sum("_n").alias("n_rows"),
        )
        .drop("_session")
    )
