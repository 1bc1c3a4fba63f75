"""Joins, set checks and unions. Strategy and skew splitting are left to adaptive execution; only tables with a
fixed size bound are broadcast by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.session import fresh_folder


def by_quarter(filings: DataFrame, filed: str, indicators: DataFrame, observed: str) -> DataFrame:
    """Left join on the calendar quarter of two dates; several observations per quarter multiply rows."""
    left = filings.withColumn("_quarter", F.date_trunc("QUARTER", F.col(filed)))
    right = indicators.withColumn("_quarter", F.date_trunc("QUARTER", F.col(observed)))
    return left.join(right, "_quarter", "left").drop("_quarter")


def attach(scores: DataFrame, extra: DataFrame | None, keys: list[str], columns: list[str]) -> DataFrame:
    """Left join of extra columns; with no extra table the columns are NULL."""
    if extra is None:
        return scores.withColumns({c: F.lit(None).cast("string") for c in columns})
    return scores.join(extra.select(*keys, *columns), keys, "left")


def in_set(df: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose key is present; the keys are made distinct before they are shuffled."""
    return df.join(keys.select(*names).distinct(), names, "left_semi")


def not_in_set(df: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose key is absent; a NULL key counts as absent."""
    return df.join(keys.select(*names).distinct(), names, "left_anti")


def stacked(*tables: DataFrame) -> DataFrame:
    """Row concatenation over differing columns."""
    whole = tables[0]
    for other in tables[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole


def shared_keys(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    return left.select(*names).intersect(right.select(*names))


def missing_strata(df: DataFrame, split: str, stratum: str, splits: tuple[str, ...], base: str = "train") -> DataFrame:
    """Strata of the base split that another split lacks; one row per (stratum, split)."""
    flags = [F.max((F.col(split) == s).cast("int")).alias(f"_in_{i}") for i, s in enumerate(splits)]
    present = df.groupBy(stratum).agg(*flags).where(F.col(f"_in_{splits.index(base)}") == 1)
    lacking = F.array_compact(F.array(*[F.when(F.col(f"_in_{i}") == 0, F.lit(s)) for i, s in enumerate(splits)]))
    return present.select(stratum, F.explode(lacking).alias(split))


def sized(df: DataFrame) -> DataFrame:
    """A derived table, stored, so that joins with it are planned by its bytes (`spark.sql.autoBroadcastJoinThreshold`)."""
    path = fresh_folder(df.sparkSession, "sized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
