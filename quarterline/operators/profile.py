"""Profiling aggregates: shares, histograms, correlations, summaries by group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.operators import folds
from quarterline.operators.ranks import group_quantiles
from quarterline.operators.reshape import lengthen

FIVE_NUMBERS = {"low": 0.0, "q25": 0.25, "median": 0.5, "q75": 0.75, "high": 1.0}


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """(label, rows, share)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("share", F.col("rows") / df.agg(F.count(F.lit(1))).scalar())


def distinct_counts(named: dict[str, tuple[DataFrame, str]], rsd: float | None = None) -> DataFrame:
    """(name, distinct_values) for a column of each table; with `rsd` a sketch of that relative error."""
    parts = []
    for name, (df, column) in named.items():
        count = F.count_distinct(column) if rsd is None else F.approx_count_distinct(column, rsd)
        parts.append(df.agg(count.alias("distinct_values")).select(F.lit(name).alias("name"), "distinct_values"))
    return reduce(DataFrame.unionByName, parts)


def class_weight(df: DataFrame, label: str, groups: list[str] | None = None) -> DataFrame:
    """Negatives per positive in both usual forms: rounded to 4 places (1.0 without positives), and at least 1."""
    counts = df.groupBy(*groups or []).agg(
        F.count_if(F.col(label) == 1).alias("n_positive"), F.count_if(F.col(label) == 0).alias("n_negative")
    )
    weight = F.coalesce(F.try_divide(F.col("n_negative"), F.col("n_positive")), F.lit(1.0))
    return counts.withColumns({"scale_pos_weight": F.round(weight, 4), "clamped_weight": F.greatest(weight, F.lit(1.0))})


def rate_by(df: DataFrame, label: str, groups: list[str]) -> DataFrame:
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.avg(label).alias("positive_rate"),
    )


def label_summary(df: DataFrame, label: str, definition: str) -> DataFrame:
    row = df.agg(F.count(label).alias("total_rows"), F.count_if(F.col(label) == 1).alias("positives"))
    return row.select(
        F.lit(definition).alias("label_definition"),
        "total_rows",
        "positives",
        (F.col("total_rows") - F.col("positives")).alias("negatives"),
        F.coalesce(F.try_divide(F.col("positives"), F.col("total_rows")), F.lit(0.0)).alias("positive_rate"),
    )


def signal_rates(df: DataFrame, signals: list[str]) -> DataFrame:
    row = df.agg(
        *[F.count_if(F.col(s)).alias(f"f_{s}") for s in signals],
        *[F.avg(F.coalesce(F.col(s), F.lit(False)).cast("int")).alias(f"r_{s}") for s in signals],
    )
    entries = F.array(
        *[
            F.struct(F.lit(s).alias("signal"), F.col(f"f_{s}").alias("fires"), (F.col(f"r_{s}") * 100).alias("fire_rate_pct"))
            for s in signals
        ]
    )
    return row.select(F.inline(entries))


def count_histogram(df: DataFrame, count: str, needed: int = 2) -> DataFrame:
    bars = df.groupBy(count).agg(F.count(F.lit(1)).alias("firm_quarters"))
    return bars.withColumns(
        {
            "pct": F.col("firm_quarters") * 100.0 / df.agg(F.count(F.lit(1))).scalar(),
            "labeled_distressed": F.col(count) >= needed,
        }
    )


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1, the last one closed on the right; a single point falls in bin 0."""
    place = F.floor((value - low) / F.nullif(high - low, F.lit(0.0)) * bins)
    return F.when(value.isNotNull(), F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0))).cast("int")


def ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """Smallest and largest value of each column (runs one aggregate job, returns two numbers a column)."""
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"l_{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"h_{c}") for c in columns],
    ).first()
    return {c: (row[f"l_{c}"], row[f"h_{c}"]) for c in columns}


def histograms(df: DataFrame, columns: list[str], bins: int, groups: list[str] | None = None) -> DataFrame:
    """(groups, feature, bin, rows) over each column's whole range; empty bins have no row."""
    groups = groups or []
    limits = ranges(df, columns)
    binned = df.select(
        *groups, *[bin_of(F.col(c).cast("double"), F.lit(limits[c][0]), F.lit(limits[c][1]), bins).alias(c) for c in columns]
    )
    long = binned.unpivot(groups, columns, "feature", "bin").where(F.col("bin").isNotNull())
    return long.groupBy(*groups, "feature", "bin").agg(F.count(F.lit(1)).alias("rows"))


def score_summary(df: DataFrame, score: str, high: float = 0.7) -> DataFrame:
    """(rows, mean, high_risk) joined with the exact median."""
    base = df.agg(F.count(score).alias("rows"), F.avg(score).alias("mean"), F.count_if(F.col(score) >= high).alias("high_risk"))
    median = folds.group_summaries(df, [], [score], {"median": 0.5}).first()
    return base.withColumn("median", F.lit(median["median"] if median else None).cast("double"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature_a, feature_b, correlation), pairwise complete; a table without rows has no pairs.

    Sums of products come from matrix products per batch of rows, one small row per pair and task. A column that is constant where the other
    has values correlates with none: NaN; with under two rows in common: null.
    """
    named = F.array(*[F.lit(c) for c in columns])
    sums = folds.comoments(df, columns).where(F.col("n") > 0)
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    # What rounding leaves of a constant's squares is nothing.
    vx, vy = (F.when(F.abs(v) > 1e-13 * whole, v).otherwise(0.0) for v, whole in ((F.col("xx") - x * x / n, F.col("xx")), (F.col("yy") - y * y / n, F.col("yy"))))
    both = F.when((vx > 0) & (vy > 0), (F.col("xy") - x * y / n) / (F.sqrt(vx) * F.sqrt(vy))).otherwise(F.lit(float("nan")))
    return sums.select(
        F.element_at(named, F.col("i") + 1).alias("feature_a"), F.element_at(named, F.col("k") + 1).alias("feature_b"), F.when(n > 1, both).alias("correlation")
    )


def strongest_pairs(correlated: DataFrame, n: int = 20) -> DataFrame:
    apart = correlated.where((F.col("feature_a") != F.col("feature_b")) & F.col("correlation").isNotNull())
    return apart.orderBy(F.abs("correlation").desc(), "feature_a", "feature_b").limit(n)


def five_numbers(df: DataFrame, columns: list[str], groups: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """(groups, feature, low, q25, median, q75, high); exact by refinement of bins, or sketches with `accuracy`."""
    groups = groups or []
    if accuracy is None and (made := folds.group_summaries(df, groups, columns, {k: FIVE_NUMBERS[k] for k in ("q25", "median", "q75")})) is not None:
        return made.select(*groups, "feature", *FIVE_NUMBERS)
    return group_quantiles(lengthen(df, groups, columns), [*groups, "feature"], "value", FIVE_NUMBERS, accuracy)


def widest_columns(df: DataFrame, columns: list[str], n: int = 6) -> DataFrame:
    row = df.agg(*[F.var_samp(c).alias(c) for c in columns])
    long = row.unpivot([], columns, "feature", "variance").where(F.col("variance").isNotNull())
    return long.orderBy(F.col("variance").desc(), "feature").limit(n)


def row_sample(df: DataFrame, keys: list[str], n: int = 500, seed: int = 42) -> DataFrame:
    """n rows picked by a hash of their key, the same ones on every run."""
    ticket = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.withColumn("_ticket", ticket).orderBy("_ticket", *keys).limit(n).drop("_ticket")


def means_by(df: DataFrame, columns: list[str], group: str) -> DataFrame:
    wide = df.groupBy(group).agg(*[F.avg(c).alias(c) for c in columns])
    return wide.unpivot([group], columns, "feature", "mean")


def freshness(df: DataFrame, year: str, score: str) -> DataFrame:
    return df.agg(F.max(year).alias("latest_year"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(score).isNull()).alias("null_scores"))


def missing_matrix(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c).isNull().cast("int").alias(c) for c in columns])
