"""Long to wide and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def widen(df: DataFrame, keys: list[str], name: str, value: str, columns: dict[str, str] | list[str]) -> DataFrame:
    """One column per listed name, holding the largest value; one shuffle with map-side combine."""
    wanted = columns if isinstance(columns, dict) else {c: c for c in columns}
    picks = [F.max(F.when(F.col(name) == tag, F.col(value))).alias(out) for tag, out in wanted.items()]
    return df.groupBy(*keys).agg(*picks)


def lengthen(df: DataFrame, keys: list[str], columns: list[str], name: str = "feature", value: str = "value") -> DataFrame:
    typed = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(keys, columns, name, value)


def contingency(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts per (row value, column value), absent pairs as 0."""
    picks = [F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values]
    return df.groupBy(row).agg(*picks)


def indicators(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """One 0/1 column per fitted category plus one for NULL."""
    flags = {f"{column}_{c}": F.coalesce((F.col(column) == c).cast("int"), F.lit(0)) for c in categories}
    flags[f"{column}_nan"] = F.col(column).isNull().cast("int")
    return df.withColumns(flags)


def aligned(df: DataFrame, keep: list[str], reference: list[str]) -> DataFrame:
    """Exactly the reference columns: missing ones become 0, extra ones go."""
    present = set(df.columns)
    picks = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in present else F.lit(0.0).alias(c) for c in reference]
    return df.select(*keep, *picks)
