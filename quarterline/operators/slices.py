"""Slices, drift between them and fairness across them."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterline.operators import folds
from quarterline.operators.joins import sized
from quarterline.operators.profile import bin_of
from quarterline.operators.ranks import group_quantiles, with_running_totals
from quarterline.operators.reshape import contingency

SMOOTHING = 1e-6
DRIFT_HIGH, DRIFT_MODERATE = 0.25, 0.10
ALERT_GAP = 0.10


def slice_members(df: DataFrame, split_year: int = 2016, rate_limit: float = 2.0) -> folds.Members:
    """(dimension, slice) of a row for each dimension whose column the table has; a null slice is none."""
    members = []
    if "company_size_bucket" in df.columns:
        members.append(("company_size", F.col("company_size_bucket")))
    if "sector_proxy" in df.columns:
        members.append(("sector_proxy", F.col("sector_proxy")))
    if "fiscal_year" in df.columns:
        year = F.col("fiscal_year")
        members.append(("time_period", F.when(year < split_year, f"pre_{split_year}").when(year >= split_year, f"post_{split_year}")))
    if "fed_funds" in df.columns:
        rate = F.col("fed_funds")
        members.append(("macro_regime", F.when(rate <= rate_limit, "low_rate").when(rate > rate_limit, "high_rate")))
    if "distress_label" in df.columns:
        label = F.col("distress_label")
        members.append(("distress_label", F.when(label == 0, "healthy (label=0)").when(label == 1, "distressed (label=1)")))
    return [(F.lit(dimension), name) for dimension, name in members]


def slice_entries(df: DataFrame, split_year: int = 2016, rate_limit: float = 2.0) -> Column:
    """Array of (dimension, slice) for a row."""
    members = slice_members(df, split_year, rate_limit)
    return F.array_compact(F.array(*[F.when(name.isNotNull(), F.struct(dimension.alias("dimension"), name.alias("slice"))) for dimension, name in members]))


def sliced(df: DataFrame, split_year: int = 2016, rate_limit: float = 2.0) -> DataFrame:
    """Every row once per dimension, in one scan."""
    marked = df.withColumn("_slices", slice_entries(df, split_year, rate_limit))
    return marked.select("*", F.inline("_slices")).drop("_slices")


def slice_values(rows: DataFrame, columns: list[str]) -> DataFrame:
    typed = rows.select("dimension", "slice", *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(["dimension", "slice"], columns, "feature", "value")


def _members(members: folds.Members | None) -> folds.Members:
    return [(F.col("dimension"), F.col("slice"))] if members is None else members


def slice_stats(rows: DataFrame, columns: list[str], accuracy: int | None = None, members: folds.Members | None = None) -> DataFrame:
    """Count, moments, quartiles, missing rate and 3-sigma outlier rate per (dimension, slice, feature).

    `rows` are sliced rows, or a table whose `members` name the slices of a row; the latter reads each row once for all its slices. Exact;
    with `accuracy` the quartiles are sketches.
    """
    quartiles = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    members = _members(members)
    if accuracy is None and (made := folds.summaries(rows, members, columns, quartiles, spread=True)) is not None:
        return made.select(
            "dimension", "slice", "feature", F.col("rows").alias("sample_count"), "mean", "std",
            (1 - F.col("present") / F.col("rows")).alias("missing_rate"), "outlier_rate", *quartiles,
        )
    # Very many slices, or sketches: rows are made long and ranked.
    exploded = rows.withColumn("_in", F.array(*[F.struct(d.alias("dimension"), s.alias("slice")) for d, s in members])).select(*columns, F.inline("_in"))
    return long_stats(slice_values(exploded.where("dimension IS NOT NULL AND slice IS NOT NULL"), columns), quartiles, accuracy)


def long_stats(long: DataFrame, quartiles: dict[str, float], accuracy: int | None = None) -> DataFrame:
    """`slice_stats` of (dimension, slice, feature, value) rows, for any number of slices."""
    keys = ["dimension", "slice", "feature"]
    moments = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.avg(F.col("value").isNull().cast("int")).alias("missing_rate"),
    )
    moments = sized(moments)
    limits = moments.select(*keys, F.col("mean").alias("_m"), F.col("std").alias("_s"))
    far = (F.col("value") < F.col("_m") - 3 * F.col("_s")) | (F.col("value") > F.col("_m") + 3 * F.col("_s"))
    outliers = (
        long.join(limits, keys)
        .groupBy(*keys)
        .agg(F.avg(F.when(F.col("_s") > 0, F.coalesce(far, F.lit(False)).cast("double")).otherwise(0.0)).alias("outlier_rate"))
    )
    return moments.join(outliers, keys, "left").join(group_quantiles(long, keys, "value", quartiles, accuracy), keys, "left")


def _psi(first: list[str], second: list[str], bins: int) -> Column:
    terms = []
    for a, b in zip(first, second):
        p = (F.col(a) + SMOOTHING) / (F.col("n_a") + bins * SMOOTHING)
        q = (F.col(b) + SMOOTHING) / (F.col("n_b") + bins * SMOOTHING)
        terms.append((q - p) * F.log(q / p))
    return reduce(lambda a, b: a + b, terms)


def _js(first: list[str], second: list[str]) -> Column:
    """Jensen-Shannon distance: square root of the divergence in natural logarithms."""
    terms = []
    for a, b in zip(first, second):
        p, q = F.col(a) / F.col("n_a"), F.col(b) / F.col("n_b")
        middle = (p + q) / 2
        for share in (p, q):
            terms.append(F.when(share > 0, share * F.log(share / middle)).otherwise(0.0))
    total = reduce(lambda a, b: a + b, terms)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _rated(folded: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """psi and js_divergence from counters _a0.., _b0.., counts n_a, n_b and the range low, high."""
    first, second = [f"_a{i}" for i in range(bins)], [f"_b{i}" for i in range(bins)]
    small = (F.col("n_a") < 10) | (F.col("n_b") < 10)
    flat = F.col("low") == F.col("high")

    def guarded(measure: Column) -> Column:
        return F.when(small, None).when(flat, 0.0).otherwise(measure)

    return folded.select(*keys, guarded(_psi(first, second, bins)).alias("psi"), guarded(_js(first, second)).alias("js_divergence"))


def pair_drift(long: DataFrame, groups: list[str], side: str, bins: int = 10) -> DataFrame:
    """PSI and JS distance between every two sides of each group, over their combined range: `long` has (groups, side, value)."""
    made = _member_drift(long, [(folds.as_text(groups), F.col(side))], ["value"], bins)
    return long_drift(long, groups, side, bins) if made is None else folds.opened(made.drop("feature"), "dimension", long, groups)


def _member_drift(df: DataFrame, members: folds.Members, columns: list[str], bins: int) -> DataFrame | None:
    """Drift of every column between every two slices of a dimension, in two passes over the wide rows.

    A row's value is binned once for each other slice of its dimension, in an array of counters; None if those would be more than a task
    holds. The ranges of pairs come from the extents, one row per slice and column.
    """
    if (found := folds.extents(df, members, columns)) is None:
        return None
    others = [[k for k, key in enumerate(found.keys) if key[0] == own[0] and k != i] for i, own in enumerate(found.keys)]
    ranges = max(map(len, others), default=0)
    if found.present.size * ranges * bins > folds.CELLS:
        return None
    low, high = (np.full((*found.present.shape, ranges), np.nan) for _ in range(2))
    for i, partners in enumerate(others):
        for j, k in enumerate(partners):
            # NaN where one of the two has no values.
            low[i, :, j], high[i, :, j] = np.minimum(found.low[i], found.low[k]), np.maximum(found.high[i], found.high[k])
    counts = np.zeros((*low.shape, bins), np.int64)
    if ranges:
        ((cells, amounts, _, _),) = folds.fold(df, members, found, [folds.EqualBins(low, high, bins)])
        counts.reshape(-1)[cells] = amounts.astype(np.int64)
    rows = []
    for i, partners in enumerate(others):
        for j, k in enumerate(partners):
            if i < k:
                back = others[k].index(i)
                for f, name in enumerate(columns):
                    if found.present[i, f] and found.present[k, f]:
                        sizes = int(found.present[i, f]), int(found.present[k, f])
                        rows.append((found.keys[i][0], name, found.keys[i][1], found.keys[k][1], *sizes, float(low[i, f, j]), float(high[i, f, j]), *counts[i, f, j].tolist(), *counts[k, f, back].tolist()))
    counters = ", ".join(f"_{side}{i} long" for side in "ab" for i in range(bins))
    table = df.sparkSession.createDataFrame(rows, f"dimension string, feature string, slice_a string, slice_b string, n_a long, n_b long, low double, high double, {counters}")
    return _rated(table, ["dimension", "feature", "slice_a", "slice_b"], bins)


def long_drift(long: DataFrame, groups: list[str], side: str, bins: int = 10) -> DataFrame:
    """`pair_drift` for any number of sides.

    Pairs are formed on the table of ranges, one row per side, never on rows; each row is then binned once per pair its side belongs to and
    folded into counters before the shuffle.
    """
    present = long.where(F.col("value").isNotNull())
    extent = present.groupBy(*groups, side).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("n")
    )
    extent = sized(extent)
    a = extent.select(*groups, F.col(side).alias("slice_a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.col("n").alias("n_a"))
    b = extent.select(*groups, F.col(side).alias("slice_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("n").alias("n_b"))
    pairs = a.join(b, groups).where(F.col("slice_a") < F.col("slice_b"))
    pairs = pairs.select(
        *groups, "slice_a", "slice_b", "n_a", "n_b",
        F.least("low_a", "low_b").alias("low"), F.greatest("high_a", "high_b").alias("high"),
    )
    sides = pairs.select("*", F.explode(F.array("slice_a", "slice_b")).alias(side))
    joined = present.join(sized(sides), [*groups, side])
    place = joined.withColumn("_bin", bin_of(F.col("value"), F.col("low"), F.col("high"), bins))
    counters = []
    for letter in ("a", "b"):
        for i in range(bins):
            counters.append(F.count_if((F.col(side) == F.col(f"slice_{letter}")) & (F.col("_bin") == i)).alias(f"_{letter}{i}"))
    keys = [*groups, "slice_a", "slice_b"]
    folded = place.groupBy(*keys).agg(
        F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"), F.max("low").alias("low"), F.max("high").alias("high"), *counters
    )
    return _rated(folded, keys, bins)


def drift_matrix(rows: DataFrame, columns: list[str], members: folds.Members | None = None) -> DataFrame:
    """PSI and JS distance per (dimension, slice pair, feature); `rows` and `members` as in `slice_stats`."""
    members = _members(members)
    if (made := _member_drift(rows, members, columns, 10)) is not None:
        return made
    exploded = rows.withColumn("_in", F.array(*[F.struct(d.alias("dimension"), s.alias("slice")) for d, s in members])).select(*columns, F.inline("_in"))
    return long_drift(slice_values(exploded.where("dimension IS NOT NULL AND slice IS NOT NULL"), columns), ["dimension", "feature"], "slice")


def slice_pairs(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(dimension, slice_a, slice_b) for slices that share a column with values; pairs are formed on one row per slice."""
    held = rows.groupBy("dimension", "slice").agg(F.array(*[F.count(c) > 0 for c in columns]).alias("held"))
    a = held.select("dimension", F.col("slice").alias("slice_a"), F.col("held").alias("held_a"))
    b = held.select("dimension", F.col("slice").alias("slice_b"), F.col("held").alias("held_b"))
    both = F.exists(F.zip_with("held_a", "held_b", lambda x, y: x & y), lambda x: x)
    return a.join(b, "dimension").where((F.col("slice_a") < F.col("slice_b")) & both).select("dimension", "slice_a", "slice_b")


def drift_alerts(matrix: DataFrame) -> DataFrame:
    high = matrix.where(F.col("psi") > DRIFT_HIGH)
    # Fixed value: the text of an alert.
    text = F.format_string("HIGH DRIFT: %s between %s and %s (PSI=%.3f)", "feature", "slice_a", "slice_b", "psi")
    return high.withColumn("alert", text)


def drift_bands(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("dimension").agg(
        F.count_if(F.col("psi") > DRIFT_HIGH).alias("high"),
        F.count_if((F.col("psi") > DRIFT_MODERATE) & (F.col("psi") <= DRIFT_HIGH)).alias("moderate"),
        F.count_if(F.col("psi") <= DRIFT_MODERATE).alias("stable"),
    )


def slice_shares(rows: DataFrame, total: DataFrame) -> DataFrame:
    """Rows per slice as a percentage of the whole table (one row joined by its only value)."""
    n = total.count()
    counted = rows.groupBy("dimension", "slice").agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("pct", F.col("rows") * 100.0 / F.lit(n))


def effect_sizes(df: DataFrame, columns: list[str], label: str = "distress_label") -> DataFrame:
    """Cohen's d of each feature between the two classes, with a signal band; under 10 values gives no row."""
    long = df.select(label, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot([label], columns, "feature", "value")
    picks = []
    for name, cls in (("healthy", 0), ("distressed", 1)):
        value = F.when(F.col(label) == cls, F.col("value"))
        picks += [F.count(value).alias(f"n_{name}"), F.avg(value).alias(f"mean_{name}"), F.var_samp(value).alias(f"_v_{name}")]
    stats = long.groupBy("feature").agg(*picks).where((F.col("n_healthy") >= 10) & (F.col("n_distressed") >= 10))
    n_h, n_d = F.col("n_healthy"), F.col("n_distressed")
    pooled = F.sqrt(((n_h - 1) * F.col("_v_healthy") + (n_d - 1) * F.col("_v_distressed")) / (n_h + n_d - 2))
    d = F.when(pooled > 0, (F.col("mean_distressed") - F.col("mean_healthy")) / pooled).otherwise(0.0)
    size = F.abs(F.col("cohens_d"))
    band = F.when(size >= 0.8, "LARGE").when(size >= 0.5, "MEDIUM").when(size >= 0.2, "SMALL").otherwise("NEGLIGIBLE")
    return stats.withColumn("cohens_d", d).withColumn("signal", band).drop("_v_healthy", "_v_distressed")


def effect_summary(effects: DataFrame) -> DataFrame:
    bands = ("LARGE", "MEDIUM", "SMALL", "NEGLIGIBLE")
    return effects.agg(*[F.count_if(F.col("signal") == b).alias(b.lower()) for b in bands], F.count(F.lit(1)).alias("features"))


def ks_p_value(statistic: Column, n_a: Column, n_b: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the two-sample Kolmogorov-Smirnov statistic."""
    reach = F.sqrt(n_a * n_b / (n_a + n_b)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * reach * reach),
    )
    # Below 0.2 the series needs more terms than it has, and the value is 1 to many places.
    return F.when(reach < 0.2, 1.0).otherwise(F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0)))


def ks_test(long: DataFrame, first: Column) -> DataFrame:
    """Largest gap of the two distribution functions per feature; `first` marks the rows of one sample."""
    counted = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count_if(first).alias("a"), F.count_if(~first).alias("b")
    )
    running = with_running_totals(counted, ["feature"], ["value"], ["a", "b"])
    gap = F.abs(F.try_divide(F.col("a_upto"), F.col("a_total")) - F.try_divide(F.col("b_upto"), F.col("b_total")))
    tested = running.groupBy("feature").agg(F.max("a_total").alias("n_a"), F.max("b_total").alias("n_b"), F.max(gap).alias("ks_stat"))
    return tested.withColumn("p_value", ks_p_value(F.col("ks_stat"), F.col("n_a"), F.col("n_b")))


def _log_gamma_after(dof: Column) -> Column:
    """ln gamma(dof / 2 + 1): the factors dof / 2, dof / 2 - 1, ... end at 1 or at 1/2, where the square root of pi is left."""
    half = dof / 2
    rest = F.when(dof % 2 == 1, 0.5 * math.log(math.pi)).otherwise(0.0)
    return F.aggregate(F.sequence(F.lit(0), F.ceil(half).cast("int") - 1), rest, lambda total, j: total + F.log(half - j))


def chi_square_log_p(statistic: Column, dof: Column) -> Column:
    """Natural logarithm of the upper tail of the chi-square distribution, to full relative precision however small the tail is.

    Left of the mean one minus the power series of the lower incomplete gamma function, right of it the continued fraction of the upper one,
    evaluated from the front by Lentz' method. Without freedom, or at a statistic of 0, the tail is 1.
    """
    half, x = dof / 2, statistic / 2
    edge = half * F.log(x) - x - _log_gamma_after(dof)

    def more(state, n):
        term = state["term"] * x / (half + n)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    one = F.lit(1.0)
    # At most one beyond the mean there, so the terms fall off soon.
    series = F.aggregate(F.sequence(F.lit(1), (40 + 12 * F.sqrt(half)).cast("int")), F.struct(one.alias("term"), one.alias("total")), more)["total"]
    left = F.log1p(-F.least(F.exp(edge) * series, one - 1e-16))

    def further(state, i):
        a = -i * (i - half)
        b = state["b"] + 2.0
        d = 1 / (a * state["d"] + b)
        c = b + a / state["c"]
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    b0 = x + 1 - half
    start = F.struct(b0.alias("b"), F.lit(1e300).alias("c"), (1 / b0).alias("d"), (1 / b0).alias("h"))
    fraction = F.aggregate(F.sequence(F.lit(1), (60 + 12 * F.sqrt(half)).cast("int")), start, further)["h"]
    # gamma(half) is gamma(half + 1) / half.
    right = edge + F.log(half) + F.log(fraction)
    return F.when((dof < 1) | (statistic <= 0), 0.0).when(x < half + 1, left).otherwise(right)


def chi_square_p_value(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution; 0 only where a double can't hold it."""
    return F.exp(chi_square_log_p(statistic, dof))


def chi_square(df: DataFrame, dimension: str, label: str, labels: tuple = (0, 1), alpha: float = 0.05) -> DataFrame:
    """Chi-square statistic, degrees of freedom, p-value with its logarithm, and verdict; Yates' correction with one degree of freedom."""
    names = [f"n_{v}" for v in labels]
    table = contingency(df.where(F.col(dimension).isNotNull()), dimension, label, list(labels))
    row_total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    cells = table.withColumn("_row", row_total).unpivot([dimension, "_row"], names, "_label", "n").where(F.col("_row") > 0)
    # One row per cell from here on: categories x labels.
    columns = cells.groupBy("_label").agg(F.sum("n").alias("_column"))
    sums = cells.join(columns, "_label").withColumn("_total", cells.agg(F.sum("n")).scalar())
    sums = sums.where(F.col("_column") > 0)
    expected = F.col("_row") * F.col("_column") / F.col("_total")
    distance = F.abs(F.col("n") - expected)
    shaped = sums.agg(
        ((F.count_distinct(dimension) - 1) * (F.count_distinct("_label") - 1)).cast("int").alias("dof"),
        F.sum(distance * distance / expected).alias("_plain"),
        F.sum(F.pow(distance - F.least(F.lit(0.5), distance), 2) / expected).alias("_yates"),
    )
    statistic = F.when(F.col("dof") == 1, F.col("_yates")).otherwise(F.col("_plain"))
    tested = shaped.select(F.lit(dimension).alias("dimension"), statistic.alias("chi2"), "dof")
    log_p = chi_square_log_p(F.col("chi2"), F.col("dof"))
    tested = tested.withColumn("log10_p", log_p / math.log(10)).withColumn("p_value", F.exp(F.col("log10_p") * math.log(10)))
    return tested.withColumn("independent", F.col("p_value") >= alpha)


def disparate_impact(df: DataFrame, dimension: str, label: str) -> DataFrame:
    """Rate per group against the highest group rate; fair inside [0.8, 1.25]."""
    rates = df.where(F.col(dimension).isNotNull()).groupBy(F.col(dimension).alias("group")).agg(F.avg(label).alias("rate"))
    share = F.coalesce(F.try_divide(F.col("rate"), rates.agg(F.max("rate")).scalar()), F.lit(0.0))
    rated = rates.withColumn("impact_ratio", share)
    return rated.select(F.lit(dimension).alias("dimension"), "group", "rate", "impact_ratio", F.col("impact_ratio").between(0.8, 1.25).alias("fair"))


def dataset_drift(reference: DataFrame, current: DataFrame, columns: list[str], alpha: float = 0.05) -> DataFrame:
    """Per-feature KS test between two tables: statistic, p-value, drifted."""
    def long(df: DataFrame, mark: bool) -> DataFrame:
        typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        return typed.unpivot([], columns, "feature", "value").withColumn("_reference", F.lit(mark))

    both = long(reference, True).unionByName(long(current, False))
    return ks_test(both, F.col("_reference")).withColumn("drifted", F.col("p_value") <= alpha)


def drift_decision(tested: DataFrame, share: float = 0.5, top: int = 10) -> DataFrame:
    """One row: share drifted, decision, the first names. Input is one row per feature."""
    names = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature"))))
    row = tested.agg(
        F.count(F.lit(1)).alias("n_features_analyzed"),
        F.count_if("drifted").alias("n_drifted_features"),
        F.concat_ws(",", F.slice(names, 1, top)).alias("drifted_features"),
    )
    part = F.coalesce(F.try_divide(F.col("n_drifted_features"), F.col("n_features_analyzed")), F.lit(0.0))
    return row.withColumns({"drift_share": F.round(part, 4), "dataset_drift": part >= share})


def fairness(performance: DataFrame, metrics: list[str], threshold: float = ALERT_GAP) -> DataFrame:
    """Each slice's metric against the sample-weighted mean over slices. Input is one row per slice."""
    long = performance.select("dimension", "slice", "sample_count", *[F.col(m).cast("double").alias(m) for m in metrics])
    long = long.unpivot(["dimension", "slice", "sample_count"], metrics, "metric", "slice_value").where(F.col("slice_value").isNotNull())
    by_metric = W.partitionBy("metric")
    overall = F.sum(F.col("slice_value") * F.col("sample_count")).over(by_metric) / F.sum("sample_count").over(by_metric)
    gap = F.col("overall_value") - F.col("slice_value")
    rated = long.withColumn("overall_value", overall).withColumn("bias_alert", gap > threshold).withColumn("gap", F.round(gap, 4))
    return rated.withColumns({"slice_value": F.round("slice_value", 4), "overall_value": F.round("overall_value", 4)})


def threshold_suggestions(
    fair: DataFrame, metric: str = "recall_at_5pct", base: float = 0.5, step: float = 0.05, limit: float = ALERT_GAP
) -> DataFrame:
    """Lower decision thresholds for slices with an alert, never under 0.1; `limit` is the gap that `fairness` alerted on."""
    alerted = fair.where(F.col("bias_alert") & (F.col("metric") == metric))
    steps = F.greatest(F.lit(1), F.floor(F.col("gap") / 0.05))
    suggested = F.greatest(F.lit(0.1), F.round(F.lit(base) - F.lit(step) * steps, 3))
    return alerted.select(
        "dimension",
        "slice",
        F.lit(base).alias("current_threshold"),
        suggested.alias("suggested_threshold"),
        F.format_string(f"{metric} is %.4f under the mean of all slices (limit {limit:g})", "gap").alias("reason"),
    )


def report_rows(section: str, df: DataFrame, name: list[str], values: list[str]) -> DataFrame:
    """A result as (section, name, measure, value) rows for one long report."""
    typed = df.select(F.concat_ws(" / ", *name).alias("name"), *[F.col(v).cast("double").alias(v) for v in values])
    return typed.unpivot(["name"], values, "measure", "value").select(F.lit(section).alias("section"), "name", "measure", "value")
