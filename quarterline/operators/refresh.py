"""Amendment-safe refresh of stored tables, for all firms or series in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions import quarters as Q
from quarterline.operators.dedup import keep_newer_source, last_periods


def refresh(stored: DataFrame, fetched: DataFrame, owner: list[str], period: list[str], keys: list[str], ties: list[str], n: int = 8) -> DataFrame:
    """Drop the owner's n newest stored periods, then add fetched rows of every period not kept.

    Old periods keep their stored values even when a source revises them; the newest ones are replaced.
    Owners that were not fetched stay as they are.
    """
    newest = last_periods(stored, owner, period, n)
    # The periods that leave are a few rows per owner; stored rows meet them in one join.
    gone = newest.join(fetched.select(*owner).distinct(), owner, "left_semi")
    kept = stored.join(gone, [*owner, *period], "left_anti")
    kept_periods = kept.select(*owner, *period).distinct()
    incoming = fetched.join(kept_periods, [*owner, *period], "left_anti")
    return keep_newer_source(kept, incoming, keys, ties)


def quarterly_last(series: DataFrame, owner: list[str], date: str, value: str, ties: list[Column]) -> DataFrame:
    """Last non-null observation per series and quarter, dated at the quarter's end."""
    moment = F.struct(F.col(date), *ties)
    present = series.where(F.col(value).isNotNull())
    return present.groupBy(*owner, Q.quarter_end_of(F.col(date)).alias("quarter_end")).agg(
        F.max(F.struct(moment.alias("at"), F.col(value).alias("value")))["value"].alias(value)
    )
