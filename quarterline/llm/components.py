"""Connected components by alternating star steps, each a join and an aggregate that combines before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id on a link (a, b); loops and repeated links are harmless."""
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = stored(links.where("a <> b").select(high, low).distinct(), "links")
    before = None
    while (now := _signature(links)) != before:
        before = now
        # Each node hangs its larger neighbours, and itself, on the smallest one around.
        around = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stored(_hang(around, F.col("b") > F.col("a")), "large")
        # Then it hangs its smaller neighbours on the smallest of them.
        small = _hang(large, F.lit(True))
        links = stored(small.distinct(), "links")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def _hang(pairs: DataFrame, which) -> DataFrame:
    """(neighbour, smallest) for the pairs chosen, and (node, smallest)."""
    # Stored, so that the join deals out both of its sides anew and a hub's links can be split over tasks.
    smallest = stored(pairs.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least")), "least")
    moved = pairs.where(which).join(smallest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(smallest.select("a", F.col("least").alias("b"))).where("a <> b")


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31))).alias("s")).first()
    return tuple(row)
