"""Sums over everything that comes before, without bringing all rows together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.shared import checkpointed


def sums_before(
    df: DataFrame, keys: list[str], values: list[str]
) -> tuple[DataFrame, dict[str, int]]:
    """Per distinct ``keys`` (none of them null) the sums of ``values``, and as
    ``before_<value>`` the sums over all lesser keys; and the sums over everything.

    Rows are summed per key first, on the map side too, so a key is one row however many
    rows it has. Keys are then range-partitioned; a partition's keys are added up in
    order, and one sum per partition, the only thing the driver sees, says how much lies
    before each. No window spans more than a partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    summed = df.groupBy(*keys).agg(*(F.sum(value).alias(value) for value in values))
    placed = checkpointed(
        summed.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id())
    )
    totals = placed.groupBy("_part").agg(*(F.sum(value).alias(value) for value in values))
    done, rows = [0] * len(values), []
    for part, *sizes in sorted(tuple(row) for row in totals.collect()):
        rows.append((part, *done))
        done = [a + b for a, b in zip(done, sizes)]
    fields = ", ".join(["_part int", *(f"_{value} bigint" for value in values)])
    offsets = spark.createDataFrame(rows, fields)
    earlier = (
        Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    )
    # Window first: it needs the shuffle, and the offsets are few enough for any join.
    within = placed.select(
        *keys, *values, "_part",
        *(F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias(f"before_{value}") for value in values),
    )
    found = within.join(offsets, "_part").select(
        *keys,
        *values,
        *((F.col(f"before_{v}") + F.col(f"_{v}")).alias(f"before_{v}") for v in values),
    )
    return found, dict(zip(values, done))


def percentiles(df: DataFrame, order: str, tie: str, buckets: int = 100) -> DataFrame:
    """``df``'s ``tie`` and ``order`` with ``rank``, ``percent_rank`` and ``bucket``
    (1 to ``buckets``, as even as can be), over all rows.

    Equal values share rank and percentage; buckets go by ``order``, then ``tie``. Rows
    without a value are left out. A value that very many rows have is spread by ``tie``.
    """
    rows = df.filter(F.col(order).isNotNull()).select(order, tie, F.lit(1).alias("n"))
    rows = rows.withColumn("_known", F.col(tie).isNotNull()).withColumn(
        "_tie", F.coalesce(F.col(tie), F.lit(0))
    )
    numbered, totals = sums_before(rows, [order, "_known", "_tie"], ["n"])
    ranked, _ = sums_before(numbered.select(order, "n"), [order], ["n"])
    n = totals["n"]
    small, larger = n // buckets, n % buckets
    edge = larger * (small + 1)
    # Rows that repeat value and tie are numbered one after the other.
    numbered = numbered.select(
        order,
        F.when(F.col("_known"), F.col("_tie")).alias(tie),
        F.explode(F.sequence(F.col("before_n"), F.col("before_n") + F.col("n") - 1)).alias("_at"),
    )
    in_larger = F.expr(f"_at div {small + 1}")
    in_small = F.expr(f"{larger} + (_at - {edge}) div {max(small, 1)}")
    return numbered.join(
        ranked.select(order, F.col("before_n").alias("_less")), order
    ).select(
        tie,
        order,
        (F.col("_less") + 1).alias("rank"),
        (F.col("_less") / F.lit(max(n - 1, 1))).alias("percent_rank"),
        (F.when(F.col("_at") < edge, in_larger).otherwise(in_small) + 1).alias("bucket"),
    )
