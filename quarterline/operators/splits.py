"""Time-based splits, strata, imputation and scaling fitted on the training part only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.operators.joins import sized
from quarterline.operators.quality import numeric_columns
from quarterline.operators import folds
from quarterline.operators.ranks import group_quantiles
from quarterline.operators.reshape import lengthen

# Columns that identify or label a row and never become features.
IDENTITY = ("firm_id", "fiscal_year", "fiscal_period", "filed_date", "date", "quarter_key", "distress_label", "split", "_strat_key")


def with_strata(df: DataFrame, parts: list[str], least: int = 10, name: str = "_strat_key") -> DataFrame:
    """size__sector strata; those with fewer than `least` rows become "other".

    Strata are counted first (one row per combination), then joined back.
    """
    raw = F.concat_ws("__", *[F.coalesce(F.col(p).cast("string"), F.lit("nan")) for p in parts])
    keyed = df.withColumn("_raw_key", raw)
    rare = keyed.groupBy("_raw_key").agg((F.count(F.lit(1)) < least).alias("_rare"))
    joined = keyed.join(sized(rare), "_raw_key")
    return joined.withColumn(name, F.when(F.col("_rare"), "other").otherwise(F.col("_raw_key"))).drop("_raw_key", "_rare")


def by_years(
    df: DataFrame,
    train: tuple[int, int],
    val: tuple[int, int],
    test: tuple[int, int],
    exclude: tuple[int, ...] = (),
    year: str = "fiscal_year",
) -> DataFrame:
    """Add `split`; excluded years and years outside all ranges leave."""
    y = F.col(year)
    kept = df.where(~y.isin(list(exclude))) if exclude else df
    name = F.when(y.between(*train), "train").when(y.between(*val), "val").when(y.between(*test), "test")
    return kept.withColumn("split", name).where(F.col("split").isNotNull())


def leakage(df: DataFrame, year: str = "fiscal_year") -> DataFrame:
    """One row: the last and first years of neighbouring splits and whether they overlap."""
    def bound(fn, split):
        return fn(F.when(F.col("split") == split, F.col(year)))

    row = df.agg(
        bound(F.max, "train").alias("max_train"),
        bound(F.min, "val").alias("min_val"),
        bound(F.max, "val").alias("max_val"),
        bound(F.min, "test").alias("min_test"),
    )
    leak = (F.col("max_train") >= F.col("min_val")) | (F.col("max_val") >= F.col("min_test"))
    return row.withColumn("leaks", F.coalesce(leak, F.lit(False)))


def require_no_leakage(df: DataFrame, year: str = "fiscal_year") -> DataFrame:
    row = leakage(df, year).first()
    if row["leaks"]:
        raise ValueError(f"temporal leakage between splits: {row.asDict()}")
    return df


def feature_columns(df: DataFrame) -> list[str]:
    return numeric_columns(df, IDENTITY)


def fit_scaler(train: DataFrame, columns: list[str], accuracy: int | None = None) -> DataFrame:
    """(feature, median, mean, std): exact medians, then mean and population deviation of the imputed values.

    Runs a job; the result has one row per feature and can be kept as a table.
    """
    if accuracy is not None or (fitted := folds.group_summaries(train, [], columns, {"median": 0.5})) is None:
        fitted = group_quantiles(lengthen(train, [], columns), ["feature"], "value", {"median": 0.5}, accuracy)
    medians = {m["feature"]: m["median"] for m in fitted.collect()}
    imputed = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))) for c in columns}
    row = train.agg(
        *[F.avg(v).alias(f"m_{c}") for c, v in imputed.items()], *[F.stddev_pop(v).alias(f"s_{c}") for c, v in imputed.items()]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(medians.get(c)).cast("double").alias("median"),
                F.col(f"m_{c}").alias("mean"),
                F.col(f"s_{c}").alias("std"),
            )
            for c in columns
        ]
    )
    return row.select(F.inline(entries))


def apply_scaler(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Impute and standardise with fitted values (one row per feature); a zero deviation divides by 1."""
    changed = {}
    for f in fitted.collect():
        if f["median"] is None:
            continue
        filled = F.coalesce(F.col(f["feature"]).cast("double"), F.lit(f["median"]))
        changed[f["feature"]] = (filled - F.lit(f["mean"])) / F.lit(f["std"] or 1.0)
    return df.withColumns(changed)


def split_report(df: DataFrame, label: str = "distress_label") -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
        F.count_if(F.col(label) == 0).alias("n_negative"),
        F.avg(label).alias("positive_rate"),
    )


def without_label(df: DataFrame, label: str = "distress_label") -> tuple[DataFrame, DataFrame]:
    if label not in df.columns:
        raise ValueError(f"label column {label} is absent")
    return df.drop(label), df.select(label)
