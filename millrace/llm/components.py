"""Connected components of a large graph, by alternating large and small stars.

Each round hangs every node's neighbours on the least of them: first the larger
neighbours, then the others. Rounds are logarithmic in practice, edges never grow in
number, and no neighbourhood is gathered: rounds are made of minima (reduced before
they are shuffled) and of joins that adaptive execution splits for hot nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of ``edges`` (bigint columns ``a`` and ``b``): the
    root is the least node of its component. Loops, repeats, either direction and
    nulls (which link nothing) are allowed."""
    pairs = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .filter("u > v")
        .distinct()
    )
    pairs = stored(pairs, "edges")
    before = None
    while True:
        state = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if state == before:
            break
        before = state
        pairs = stored(_small_star(_large_star(pairs)), "edges")
    found = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found.unionByName(
        found.select(F.col("root").alias("node"), "root").distinct()
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    """Hangs each node's larger neighbours on the least of the node and its own."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.filter("v > u").join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Hangs each node and its smaller neighbours on the least of those."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").filter("v > m")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
