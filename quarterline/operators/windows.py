"""Per-firm windows.

They run on panels that are unique per (firm, quarter) inside the plausible years, so a firm holds at most
4 x 41 rows and no window partition can grow with the data. All columns of one call share a window spec:
one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.window import WindowSpec

from quarterline.functions.scalars import ratio
from quarterline.operators.joins import sized


def ordered(by: list[str], order: list) -> WindowSpec:
    return W.partitionBy(*by).orderBy(*order)


def last_rows(spec: WindowSpec, n: int) -> WindowSpec:
    return spec.rowsBetween(-(n - 1), 0)


def add_lags(df: DataFrame, columns: list[str], spec: WindowSpec, steps: tuple[int, ...] = (1, 4)) -> DataFrame:
    return df.withColumns({f"{c}_lag{k}": F.lag(c, k).over(spec) for c in columns for k in steps})


def day_gap(date: str, spec: WindowSpec) -> Column:
    return F.datediff(F.col(date), F.lag(date).over(spec))


def growth(value: Column, spec: WindowSpec, steps: int = 4, denominator: str = "abs") -> Column:
    old = F.lag(value, steps).over(spec)
    return ratio(value - old, F.abs(old) if denominator == "abs" else old)


def change(value: Column, spec: WindowSpec, steps: int = 1) -> Column:
    return value - F.lag(value, steps).over(spec)


def rolling_mean(column: str, spec: WindowSpec, n: int) -> Column:
    return F.avg(column).over(last_rows(spec, n))


def rolling_std(column: str, spec: WindowSpec, n: int) -> Column:
    return F.stddev_samp(column).over(last_rows(spec, n))


def fill_both_ways(df: DataFrame, columns: list[str], spec: WindowSpec) -> DataFrame:
    """Own value, else the latest earlier one, else the earliest later one.

    Without an earlier value the earliest later one is the first of the whole partition, which is found once and not once a row.
    """
    before = spec.rowsBetween(W.unboundedPreceding, 0)
    whole = spec.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(
                F.col(c), F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(whole)
            )
            for c in columns
        }
    )


def forward_fill(df: DataFrame, columns: list[str], spec: WindowSpec, rest: float | None = 0.0) -> DataFrame:
    before = spec.rowsBetween(W.unboundedPreceding, 0)
    filled = {}
    for c in columns:
        value = F.last(c, ignorenulls=True).over(before)
        filled[c] = value if rest is None else F.coalesce(value, F.lit(rest))
    return df.withColumns(filled)


def fill_by_date(df: DataFrame, columns: list[str], date: str) -> DataFrame:
    """Economy-wide fill: own value, else the same date's, else the latest earlier, else the earliest later.

    The series is first reduced to one row per calendar day (a few thousand, and never more than the calendar
    has), whatever the input size. Only that table meets an unpartitioned window; it is stored, and joined by its size.
    """
    day = F.to_date(F.col(date))
    per_day = df.groupBy(day.alias("_day")).agg(*[F.max(c).alias(c) for c in columns])
    spec = W.orderBy(F.col("_day").asc_nulls_first())
    filled = fill_both_ways(per_day, columns, spec).select("_day", *[F.col(c).alias(f"_day_{c}") for c in columns])
    joined = df.join(sized(filled), day.eqNullSafe(F.col("_day")), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_day_{c}")) for c in columns}).drop(
        "_day", *[f"_day_{c}" for c in columns]
    )


def held_for(condition: Column, spec: WindowSpec, n: int) -> Column:
    """True when the condition held on this row and the n-1 before it; NULL counts as false."""
    hits = F.sum(F.coalesce(condition.cast("int"), F.lit(0))).over(last_rows(spec, n))
    return F.coalesce(hits == n, F.lit(False))


def rose_by(value: Column, spec: WindowSpec, steps: int, share: float) -> Column:
    """Rise of at least `share` of the absolute old value over `steps` rows."""
    return F.coalesce(growth(value, spec, steps) >= share, F.lit(False))


def fell_for(step: Column, spec: WindowSpec, n: int = 3) -> Column:
    """All of the last n row-to-row changes are known and negative."""
    frame = last_rows(spec, n)
    return (F.count(step).over(frame) == n) & F.coalesce(F.max(step).over(frame) < 0, F.lit(False))


def ahead(flag: Column, spec: WindowSpec, horizon: int) -> Column:
    """The flag `horizon` rows later as 0/1, 0 beyond the end."""
    return F.coalesce(F.lead(flag.cast("int"), horizon).over(spec), F.lit(0))
