"""Decisions over a history of model runs (a metrics table)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.operators.ranks import with_row_number

# The acceptance gate and the tolerated loss against production.
BLOCK_BELOW, WARN_BELOW, TOLERANCE = 0.80, 0.85, 0.02


def gate(auc: Column) -> Column:
    return F.when(auc < BLOCK_BELOW, "block").when(auc < WARN_BELOW, "warn").otherwise("pass")


def promotion(new_auc: Column, production_auc: Column, recall_low: Column) -> Column:
    """rejected by the gate, kept back when worse than production by more than the tolerance, else promoted."""
    return (
        F.when((new_auc < BLOCK_BELOW) | recall_low, "rejected")
        .when(production_auc.isNotNull() & (new_auc < production_auc - TOLERANCE), "staged")
        .otherwise("promoted")
    )


def ranking_metric(df: DataFrame, candidates: list[str]) -> str:
    """The first candidate metric column the history has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"no ranking metric among {candidates}")


def run_order(runs: DataFrame, order: list) -> DataFrame:
    return with_row_number(runs, order, "trial_index")


def best_runs(runs: DataFrame, candidates: list[str], ties: list[str], secondary: list[str], n: int = 10) -> DataFrame:
    metric = ranking_metric(runs, candidates)
    extra = [c for c in secondary if c in runs.columns and c != metric]
    return runs.orderBy(F.col(metric).desc_nulls_last(), *ties).limit(n).select(*ties, metric, *extra)


def consistency(left: DataFrame, right: DataFrame, name: str, value: str, tolerance: float = 1e-4) -> DataFrame:
    """Side-by-side values per name with a verdict within the tolerance."""
    a = left.select(name, F.col(value).alias("left_value"))
    b = right.select(name, F.col(value).alias("right_value"))
    both = a.join(b, name, "full")
    close = F.abs(F.col("left_value") - F.col("right_value")) < tolerance
    return both.withColumn("consistent", F.coalesce(close, F.lit(False)))


def sensitivity(trials: DataFrame, parameters: list[str], metric: str, n: int = 3) -> DataFrame:
    """Spread of the mean metric over each parameter's values, largest first."""
    long = trials.select(metric, *[F.col(p).cast("string").alias(p) for p in parameters]).unpivot([metric], parameters, "parameter", "setting")
    means = long.groupBy("parameter", "setting").agg(F.avg(metric).alias("mean_metric"))
    spread = means.groupBy("parameter").agg((F.max("mean_metric") - F.min("mean_metric")).alias("spread"), F.count(F.lit(1)).alias("settings"))
    return spread.orderBy(F.col("spread").desc(), "parameter").limit(n)


def importance(long: DataFrame, n: int = 20) -> DataFrame:
    """Mean size, mean and population deviation of each feature's attributions, ranked, with a direction."""
    stats = long.groupBy("feature").agg(
        F.avg(F.abs("shap_value")).alias("mean_abs_shap"), F.avg("shap_value").alias("mean_shap"), F.stddev_pop("shap_value").alias("std_shap")
    )
    top = stats.orderBy(F.col("mean_abs_shap").desc(), "feature").limit(n)
    ranked = with_row_number(top, [F.col("mean_abs_shap").desc(), F.col("feature")], "rank")
    return ranked.withColumn("direction", F.when(F.col("mean_shap") > 0, "increases_risk").otherwise("protective"))
