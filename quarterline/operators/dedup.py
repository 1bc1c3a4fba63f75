"""Row selection per key. Every order is total, so reruns and repartitioning agree.

`row_number() <= n` filters plan as a group limit on both sides of the shuffle: a hot key sends at most
n rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _ranked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    # A hash in front of text keys lets the sorts compare one long instead of strings.
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    return hashed.withColumn("_rank", F.row_number().over(W.partitionBy("_hash", *keys).orderBy(*order)))


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    return _ranked(df, keys, order).where(F.col("_rank") <= n).drop("_rank", "_hash")


def nth_row(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return _ranked(df, keys, order).where(F.col("_rank") == n).drop("_rank", "_hash")


def keep_latest(df: DataFrame, keys: list[str], moment: str, ties: list[str]) -> DataFrame:
    """Newest row per key, missing dates last, ties by the largest tie columns."""
    order = [F.col(moment).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]]
    return top_rows(df, keys, order)


def keep_newer_source(old: DataFrame, new: DataFrame, keys: list[str], ties: list[str]) -> DataFrame:
    """Union where a new row replaces an old one with the same key."""
    both = old.withColumn("_source", F.lit(0)).unionByName(
        new.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    order = [F.col("_source").desc(), *[F.col(t).desc_nulls_last() for t in ties]]
    return top_rows(both, keys, order).drop("_source")


def last_periods(df: DataFrame, group: list[str], period: list[str], n: int = 8) -> DataFrame:
    """The n newest distinct periods of each group; repeats are removed before ranking."""
    distinct = df.select(*group, *period).distinct()
    return top_rows(distinct, group, [F.col(p).desc() for p in period], n)


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows repeat an earlier row's key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
