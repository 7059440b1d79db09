"""Top rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import whole


def top_per_group(
    df: DataFrame, group: str, order: list[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, numbered from 1 in ``rank``.

    The filter sits right on the row number, so Spark keeps only ``n`` rows per
    group in each task before the shuffle; a group with most of the rows sends
    ``n`` rows per task.
    """
    number = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    top = df.withColumn(rank, number).filter(F.col(rank) <= n)
    return top.withColumn(rank, whole(rank))
