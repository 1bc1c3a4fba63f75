"""Row and column filters that depend on the schema or on one aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.operators.ranks import with_row_number


def plausible(df: DataFrame, date: str, first: str = "1993-01-01", last: str = "2030-12-31") -> tuple[DataFrame, DataFrame]:
    """Rows inside the date range, and a one-row count of the others (missing dates count as others)."""
    inside = F.coalesce(F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(False))
    return df.where(inside), df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~inside).alias("dropped"))


def evaluation_window(df: DataFrame, first: int, last: int) -> DataFrame:
    """By fiscal year, else by the first date column present, else everything."""
    if "fiscal_year" in df.columns:
        return df.where(F.col("fiscal_year").try_cast("int").between(first, last))
    for date in ("filing_date", "filed_date"):
        if date in df.columns:
            return df.where(F.year(F.col(date).try_cast("date")).between(first, last))
    return df


def drop_sparse_columns(df: DataFrame, candidates: list[str], limit: float = 0.9) -> DataFrame:
    """Drop candidate columns whose NULL share is above `limit` (one aggregate job)."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in candidates]).first()
    return df.drop(*[c for c in candidates if shares[c] is not None and shares[c] > limit])


def uninformative_columns(df: DataFrame, candidates: list[str] | None = None) -> list[str]:
    """Columns that are all NULL or hold one value; min = max needs no distinct (one aggregate job)."""
    names = [c for c in (candidates or df.columns) if c in df.columns]
    picks = [F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in names]
    row = df.agg(*picks).first()
    return [c for c in names if row[c]]


def drop_uninformative(df: DataFrame, candidates: list[str] | None = None) -> DataFrame:
    return df.drop(*uninformative_columns(df, candidates))


def active_firms(firms: DataFrame, filings: DataFrame, date: str, as_of, days: int = 18 * 30, status: str | None = None) -> DataFrame:
    """Firms whose newest filing is recent; firms whose lookup failed stay, firms without filings go."""
    newest = filings.groupBy("firm_id").agg(F.max(date).alias("last_filed"))
    joined = firms.join(newest, "firm_id", "left")
    recent = F.coalesce(F.to_date("last_filed") >= F.date_sub(as_of, days), F.lit(False))
    if status:
        recent = recent | (F.col(status) == "failed")
    return joined.where(recent)


def sharded(firms: DataFrame, order: list[str], shards: int, limit: int | None = None) -> DataFrame:
    """Number the universe in order, mark the first `limit` and deal rows round-robin to shards."""
    ranked = with_row_number(firms, order, "position")
    inside = F.lit(True) if limit is None else F.col("position") <= limit
    return ranked.withColumns({"shard": F.pmod(F.col("position") - 1, F.lit(shards)).cast("int"), "in_universe": inside})
