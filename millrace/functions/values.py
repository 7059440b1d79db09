"""Column expressions shared by the operators."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


# Totals of whole units are kept as two ``bigint`` sums, of the units div and mod
# this number, so that they are exact and cannot overflow over trillions of rows.
_SPLIT = 1_000_000


def hundredths(column: str | Column) -> Column:
    """An amount or a rate with two decimals, stored as a double, as whole hundredths.

    Integers make sums exact and independent of row order, and cost a fraction of
    what casting each double to a decimal does. The query fails on a value that is no
    such amount: NaN, infinite, 10^12 or more, or with more decimals than two. What a
    double's own rounding may add is allowed for.
    """
    scaled = _col(column).cast("double") * 100
    whole = F.when(scaled < 0, -F.floor(0.5 - scaled)).otherwise(F.floor(scaled + 0.5))
    allowed = F.greatest(F.lit(1e-4), F.abs(scaled) * 4e-16)
    # NaN is larger than any number.
    fine = (F.abs(scaled) < 1e14) & (F.abs(scaled - whole) <= allowed)
    message = F.concat(F.lit("not an amount with two decimals: "), _col(column).cast("string"))
    failed = F.raise_error(message).cast("bigint")
    return F.when(scaled.isNull(), F.lit(None)).when(fine, whole).otherwise(failed)


def split_sum(units: Column, name: str) -> list[Column]:
    """The sum of whole ``units`` as the two columns ``<name>_high, <name>_low``."""
    high = F.call_function("div", units, F.lit(_SPLIT))
    return [
        F.sum(high).alias(f"{name}_high"),
        F.sum(units % _SPLIT).alias(f"{name}_low"),
    ]


def split_sum_again(name: str) -> list[Column]:
    """The sum over sums made by ``split_sum``."""
    return [F.sum(part).alias(part) for part in (f"{name}_high", f"{name}_low")]


def split_total(name: str, scale: int) -> Column:
    """The total of a ``split_sum`` as a decimal with ``scale`` decimals."""
    units = F.col(f"{name}_high").cast("decimal(19,0)") * _SPLIT + F.col(f"{name}_low")
    return (units * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def whole(column: str | Column) -> Column:
    """A count or a year as ``bigint``."""
    return _col(column).cast("bigint")


def interval(length: str) -> Column:
    """A fixed length of time such as ``30 minutes``."""
    return F.expr(f"INTERVAL '{length}'")


def time_bucket(ts: str | Column, length: str) -> Column:
    """Start of the bucket of ``length`` that holds ``ts``; Spark drops rows without."""
    return F.window(_col(ts), length)["start"]


def as_instant(wall: str | Column) -> Column:
    """A zoneless timestamp read as UTC, whatever the session's time zone.

    Watermarks need a zoned timestamp; a plain cast would read the session's zone.
    """
    seconds = (_col(wall) - F.expr(EPOCH)).cast("interval second")
    return F.timestamp_seconds(seconds.cast("decimal(20,6)"))


def as_wall(instant: str | Column) -> Column:
    """The reverse of ``as_instant``."""
    micros = F.unix_micros(_col(instant)).cast("decimal(18,0)")
    seconds = (micros * F.expr("0.000001BD")).cast("decimal(18,6)")
    return F.expr(EPOCH) + F.make_dt_interval(secs=seconds)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
