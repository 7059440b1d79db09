"""Exact quantiles of amounts, for groups of any size."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import hundredths, whole
from millrace.sources.shared import broadcast_if_small, checkpointed

# Amounts below 10^10 are whole numbers of cents below 10^12. Split by this factor
# twice, they have three parts, and no window below holds more than 2 * 10^4 rows.
_FACTOR = 10_000


def exact_quantiles(
    df: DataFrame, key: str, amount: str, fractions: dict[str, Decimal]
) -> DataFrame:
    """``key`` and, per entry of ``fractions``, that quantile of ``amount``, as
    ``decimal(18,4)``, interpolated linearly between the two nearest amounts.

    ``F.percentile`` gathers the distinct values of a group in one task. Here the
    rows are counted per price band of 10^4 cents, the counts tell which band holds
    each wanted rank, and only the rows of those bands are counted cent by cent.
    That reads the two columns twice and shuffles nothing but counts. Null amounts
    are left out; a group with nothing else gets nulls.
    """
    rows = df.select(key, hundredths(amount).alias("_cents")).withColumn(
        "_band", _floor_div("_cents", _FACTOR)
    )
    bands = rows.groupBy(key, "_band").agg(F.count("_cents").alias("_n"))
    wanted = checkpointed(_wanted_ranks(_rows_before(bands, key), fractions, key))

    counts = _counts_in_bands(rows, wanted.select(key, "_band"), key)
    in_band = (
        Window.partitionBy(key, "_band")
        .orderBy("_cents")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = counts.withColumn(
        "_start", F.coalesce(F.sum("_n").over(in_band), F.lit(0))
    ).withColumnsRenamed({key: "_key", "_band": "_in"})
    same_band = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_band") == F.col("_in"))
    offset = F.col("_rank") - F.col("_before")
    found = same_band & (
        offset.between(F.col("_start"), F.col("_start") + F.col("_n") - 1)
    )
    parts = wanted.join(placed, found, "left").select(
        key, "_name", (F.col("_cents") * F.col("_weight") / 100).alias("_part")
    )
    return parts.groupBy(key).agg(
        *(
            F.sum(F.when(F.col("_name") == name, F.col("_part")))
            .cast("decimal(18,4)")
            .alias(name)
            for name in fractions
        )
    )


def _floor_div(column: str, by: int) -> Column:
    return F.expr(f"({column} - pmod({column}, {by})) div {by}")


def _rows_before(bands: DataFrame, key: str) -> DataFrame:
    """Per band the rows of its key in lower bands, and all rows of the key.

    The running sum goes over groups of bands first, then over the bands of a
    group, so that neither window grows with the number of bands.
    """
    bands = bands.withColumn("_group", _floor_div("_band", _FACTOR))
    earlier = (Window.unboundedPreceding, -1)
    over_groups = Window.partitionBy(key).orderBy("_group").rowsBetween(*earlier)
    groups = (
        bands.groupBy(key, "_group")
        .agg(F.sum("_n").alias("_group_n"))
        .select(
            F.col(key).alias("_key"),
            F.col("_group").alias("_group_id"),
            F.coalesce(F.sum("_group_n").over(over_groups), F.lit(0)).alias("_lower"),
            F.sum("_group_n").over(Window.partitionBy(key)).alias("_total"),
        )
    )
    in_group = Window.partitionBy(key, "_group").orderBy("_band").rowsBetween(*earlier)
    return (
        bands.withColumn("_in_group", F.coalesce(F.sum("_n").over(in_group), F.lit(0)))
        .join(
            groups,
            F.col(key).eqNullSafe(F.col("_key"))
            & F.col("_group").eqNullSafe(F.col("_group_id")),
        )
        .select(
            key,
            "_band",
            "_n",
            "_total",
            (F.col("_lower") + F.col("_in_group")).alias("_before"),
        )
    )


def _wanted_ranks(bands: DataFrame, fractions: dict[str, Decimal], key: str) -> DataFrame:
    """The two ranks around each quantile, their weights, and the band each is in.

    A key without any amount keeps one row without a rank.
    """
    wanted = []
    for name, fraction in fractions.items():
        place = (F.col("_total") - 1).cast("decimal(19,0)") * F.lit(fraction)
        low, high = whole(F.floor(place)), whole(F.ceil(place))
        upper = place - F.floor(place)
        wanted.append(_rank(name, low, 1 - upper))
        wanted.append(_rank(name, high, upper))
    ranked = bands.select("*", F.explode(F.array(*wanted)).alias("_wanted")).select(
        key, "_band", "_n", "_before", "_total", "_wanted.*"
    )
    inside = F.col("_rank").between(
        F.col("_before"), F.col("_before") + F.col("_n") - 1
    )
    empty = F.col("_total") == 0
    return ranked.filter(inside | empty).drop("_n", "_total")


def _rank(name: str, rank: Column, weight: Column) -> Column:
    return F.struct(
        F.lit(name).alias("_name"),
        rank.alias("_rank"),
        weight.cast("decimal(12,10)").alias("_weight"),
    )


def _counts_in_bands(rows: DataFrame, bands: DataFrame, key: str) -> DataFrame:
    """Rows per cent within the given bands, which may be named more than once."""
    bands = bands.withColumnsRenamed({key: "_key", "_band": "_kept"})
    same_band = F.col("_band") == F.col("_kept")
    per_cent = [key, "_band", "_cents"]
    small = broadcast_if_small(bands)
    if small is not None:
        # Hashed to one number, the key and band are looked up without building a
        # row for each of ``rows``; they are compared where the number is found.
        # The coalesces keep Spark from making the comparisons hash keys as well.
        same_hash = F.xxhash64(key, "_band") == F.xxhash64("_key", "_kept")
        neither = F.col(key).isNull() & F.col("_key").isNull()
        same_key = F.coalesce(F.col(key) == F.col("_key"), neither)
        same = same_hash & F.coalesce(same_band, F.lit(False)) & same_key
        kept = rows.join(small, same, "left_semi")
        return kept.groupBy(*per_cent).agg(F.count(F.lit(1)).alias("_n"))
    # Too many keys to broadcast: count first, so that the join moves counts, not
    # rows, and a band holds at most 10^4 of them.
    counts = rows.groupBy(*per_cent).agg(F.count(F.lit(1)).alias("_n"))
    same_key = F.col(key).eqNullSafe(F.col("_key"))
    return counts.join(bands, same_band & same_key, "left_semi")
