"""Slices, drift, statistics and fairness."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes, r
from quarterline.operators import slices as SL
from quarterline.plans import features
from quarterline.session import materialise

SPLIT_YEAR, RATE_LIMIT = 1998, 4.95
KEY = features.KEY_FEATURES
_COLS = ", ".join(KEY)
_DIMENSIONS = [
    ("company_size", "company_size_bucket"),
    ("sector_proxy", "sector_proxy"),
    ("time_period", f"CASE WHEN fiscal_year < {SPLIT_YEAR} THEN 'pre_{SPLIT_YEAR}' ELSE 'post_{SPLIT_YEAR}' END"),
    ("macro_regime", f"CASE WHEN fed_funds <= {RATE_LIMIT} THEN 'low_rate' WHEN fed_funds > {RATE_LIMIT} THEN 'high_rate' END"),
    ("distress_label", "CASE WHEN distress_label = 0 THEN 'healthy (label=0)' ELSE 'distressed (label=1)' END"),
]
_SLICED = (
    "sliced AS MATERIALIZED (SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{d}' AS dimension, {e} AS slice, firm_id, fiscal_year, fiscal_period, {_COLS} FROM features" for d, e in _DIMENSIONS)
    + ") WHERE slice IS NOT NULL)"
)
_LONG = f"{_SLICED}, long AS MATERIALIZED (SELECT dimension, slice, feature, value FROM (SELECT dimension, slice, {_COLS} FROM sliced) UNPIVOT INCLUDE NULLS (value FOR feature IN ({_COLS})))"


def _stored(spark, folder):
    """The features that slices need as a stored table, because drift and statistics read it repeatedly."""
    needed = [*features.FIRM_QUARTER, "company_size_bucket", "sector_proxy", "fed_funds", "distress_label", *KEY]
    return materialise(X.engineered(spark, folder).select(*needed))


def rows_of(spark, folder):
    return SL.sliced(_stored(spark, folder), SPLIT_YEAR, RATE_LIMIT)


def _stats(spark, folder):
    stored = _stored(spark, folder)
    return SL.slice_stats(stored, KEY, members=SL.slice_members(stored, SPLIT_YEAR, RATE_LIMIT))


@query("s1_slices", ctes("features", extra=_SLICED) + "SELECT dimension, slice, firm_id, fiscal_year, fiscal_period FROM sliced")
def slices(spark, folder):
    return rows_of(spark, folder).select("dimension", "slice", "firm_id", "fiscal_year", "fiscal_period")


_STATS = ["mean", "std", "q25", "median", "q75", "missing_rate", "outlier_rate"]


@query(
    "s2_slice_stats",
    ctes("features", extra=_LONG)
    + f"""SELECT l.dimension, l.slice, l.feature, count(*) AS sample_count, {r('any_value(m)', 3)} AS mean, {r('any_value(s)', 3)} AS std,
 {r('quantile_cont(value, 0.25)', 3)} AS q25, {r('quantile_cont(value, 0.5)', 3)} AS median, {r('quantile_cont(value, 0.75)', 3)} AS q75,
 {r('avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END)', 6)} AS missing_rate,
 {r('avg(CASE WHEN s > 0 AND (value < m - 3 * s OR value > m + 3 * s) THEN 1.0 ELSE 0.0 END)', 6)} AS outlier_rate
 FROM long l JOIN (SELECT dimension, slice, feature, avg(value) AS m, stddev_samp(value) AS s FROM long GROUP BY ALL) USING (dimension, slice, feature) GROUP BY ALL""",
)
def slice_stats(spark, folder):
    stats = _stats(spark, folder)
    places = {c: 6 if c.endswith("rate") else 3 for c in _STATS}
    return stats.select("dimension", "slice", "feature", "sample_count", *[F.round(c, n).alias(c) for c, n in places.items()])


def drift_sql(groups: str, side: str, source: str = "long") -> str:
    """Views `matrix` with psi and js per pair, from `source`(groups, side, value)."""
    return f"""extent AS (SELECT {groups}, {side}, min(value) AS lo, max(value) AS hi, count(value) AS n FROM {source} WHERE value IS NOT NULL GROUP BY ALL),
 pairs AS (SELECT {groups}, a.{side} AS slice_a, b.{side} AS slice_b, a.n AS n_a, b.n AS n_b, least(a.lo, b.lo) AS lo, greatest(a.hi, b.hi) AS hi
  FROM extent a JOIN extent b USING ({groups}) WHERE a.{side} < b.{side}),
 hits AS (SELECT {groups}, slice_a, slice_b, coalesce(least(floor((value - lo) / nullif(hi - lo, 0) * 10), 9), 0) AS bin,
  count(*) FILTER ({side} = slice_a) AS ca, count(*) FILTER ({side} = slice_b) AS cb
  FROM pairs JOIN {source} USING ({groups}) WHERE value IS NOT NULL AND ({side} = slice_a OR {side} = slice_b) GROUP BY ALL),
 bins AS (SELECT {groups}, slice_a, slice_b, n_a, n_b, lo, hi, coalesce(ca, 0) AS ca, coalesce(cb, 0) AS cb
  FROM (SELECT * FROM pairs, (SELECT CAST(unnest(range(10)) AS DOUBLE) AS bin)) LEFT JOIN hits USING ({groups}, slice_a, slice_b, bin)),
 matrix AS (SELECT {groups}, slice_a, slice_b, CASE WHEN n_a < 10 OR n_b < 10 THEN NULL WHEN lo = hi THEN 0.0 ELSE
   sum(((cb + 1e-6) / (n_b + 1e-5) - (ca + 1e-6) / (n_a + 1e-5)) * ln(((cb + 1e-6) / (n_b + 1e-5)) / ((ca + 1e-6) / (n_a + 1e-5)))) END AS psi,
  CASE WHEN n_a < 10 OR n_b < 10 THEN NULL WHEN lo = hi THEN 0.0 ELSE sqrt(greatest(sum(CASE WHEN ca > 0 THEN ca / n_a * ln((ca / n_a) / ((ca / n_a + cb / n_b) / 2)) ELSE 0 END
   + CASE WHEN cb > 0 THEN cb / n_b * ln((cb / n_b) / ((ca / n_a + cb / n_b) / 2)) ELSE 0 END) / 2, 0)) END AS js_divergence
  FROM bins GROUP BY {groups}, slice_a, slice_b, n_a, n_b, lo, hi)"""


_MATRIX = f"{_LONG}, {drift_sql('dimension, feature', 'slice')}"


def _matrix(spark, folder):
    stored = _stored(spark, folder)
    return SL.drift_matrix(stored, KEY, SL.slice_members(stored, SPLIT_YEAR, RATE_LIMIT))


@query(
    "s5_drift_matrix",
    ctes("features", extra=_MATRIX) + f"SELECT dimension, feature, slice_a, slice_b, {r('psi', 6)} AS psi, {r('js_divergence', 6)} AS js_divergence FROM matrix",
)
def drift_matrix(spark, folder):
    return _matrix(spark, folder).withColumns({"psi": F.round("psi", 6), "js_divergence": F.round("js_divergence", 6)})


_EVENT_LONG = "long AS (SELECT 'value' AS feature, event_type AS side, value FROM events), " + drift_sql("feature", "side")


@query("s3_psi_events", f"WITH {_EVENT_LONG} SELECT slice_a, slice_b, {r('psi', 6)} AS psi FROM matrix")
def psi_events(spark, folder):
    long = X.table(spark, folder, "events").select(F.lit("value").alias("feature"), F.col("event_type").alias("side"), "value")
    return SL.pair_drift(long, ["feature"], "side").select("slice_a", "slice_b", F.round("psi", 6).alias("psi"))


_PRICE_LONG = "long AS (SELECT l_returnflag AS flag, l_linestatus AS side, l_extendedprice AS value FROM lineitem), " + drift_sql("flag", "side")


@query("s4_js_prices", f"WITH {_PRICE_LONG} SELECT flag, slice_a, slice_b, {r('js_divergence', 6)} AS js_divergence FROM matrix")
def js_prices(spark, folder):
    long = X.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("side"), F.col("l_extendedprice").alias("value")
    )
    return SL.pair_drift(long, ["flag"], "side").select("flag", "slice_a", "slice_b", F.round("js_divergence", 6).alias("js_divergence"))


@query(
    "s6_drift_alerts",
    ctes("features", extra=_MATRIX)
    + "SELECT dimension, feature, slice_a, slice_b, printf('HIGH DRIFT: %s between %s and %s (PSI=%.3f)', feature, slice_a, slice_b, psi) AS alert FROM matrix WHERE psi > 0.25",
)
def drift_alerts(spark, folder):
    return SL.drift_alerts(_matrix(spark, folder)).select("dimension", "feature", "slice_a", "slice_b", "alert")


@query(
    "s7_drift_bands",
    ctes("features", extra=_MATRIX)
    + "SELECT dimension, count(*) FILTER (psi > 0.25) AS high, count(*) FILTER (psi > 0.10 AND psi <= 0.25) AS moderate, count(*) FILTER (psi <= 0.10) AS stable FROM matrix GROUP BY dimension",
)
def drift_bands(spark, folder):
    return SL.drift_bands(_matrix(spark, folder))


@query(
    "s8_slice_shares",
    ctes("features", extra=_SLICED)
    + f"SELECT dimension, slice, count(*) AS rows, {r('count(*) * 100.0 / (SELECT count(*) FROM features)', 6)} AS pct FROM sliced GROUP BY ALL",
)
def slice_shares(spark, folder):
    whole = _stored(spark, folder)
    return SL.slice_shares(SL.sliced(whole, SPLIT_YEAR, RATE_LIMIT), whole).withColumn("pct", F.round("pct", 6))


_EFFECT = f"""base AS (SELECT distress_label, feature, value FROM (SELECT distress_label, {_COLS} FROM features) UNPIVOT INCLUDE NULLS (value FOR feature IN ({_COLS}))),
 effect AS (SELECT *, CASE WHEN pooled > 0 THEN (mean_distressed - mean_healthy) / pooled ELSE 0.0 END AS d FROM (
  SELECT *, sqrt(((n_healthy - 1) * v_h + (n_distressed - 1) * v_d) / (n_healthy + n_distressed - 2)) AS pooled FROM (
   SELECT feature, count(value) FILTER (distress_label = 0) AS n_healthy, count(value) FILTER (distress_label = 1) AS n_distressed,
    avg(value) FILTER (distress_label = 0) AS mean_healthy, avg(value) FILTER (distress_label = 1) AS mean_distressed,
    var_samp(value) FILTER (distress_label = 0) AS v_h, var_samp(value) FILTER (distress_label = 1) AS v_d FROM base GROUP BY feature)
  WHERE n_healthy >= 10 AND n_distressed >= 10)),
 banded AS (SELECT *, CASE WHEN abs(d) >= 0.8 THEN 'LARGE' WHEN abs(d) >= 0.5 THEN 'MEDIUM' WHEN abs(d) >= 0.2 THEN 'SMALL' ELSE 'NEGLIGIBLE' END AS signal FROM effect)"""


@query(
    "s9_effect_sizes",
    ctes("features", extra=_EFFECT)
    + f"SELECT feature, n_healthy, n_distressed, {r('mean_healthy', 3)} AS mean_healthy, {r('mean_distressed', 3)} AS mean_distressed, {r('d', 6)} AS cohens_d, signal FROM banded",
)
def effect_sizes(spark, folder):
    effects = SL.effect_sizes(X.engineered(spark, folder), KEY)
    return effects.withColumns(
        {"mean_healthy": F.round("mean_healthy", 3), "mean_distressed": F.round("mean_distressed", 3), "cohens_d": F.round("cohens_d", 6)}
    )


@query(
    "s13_effect_summary",
    ctes("features", extra=_EFFECT)
    + "SELECT "
    + ", ".join(f"count(*) FILTER (signal = '{b}') AS {b.lower()}" for b in ("LARGE", "MEDIUM", "SMALL", "NEGLIGIBLE"))
    + ", count(*) AS features FROM banded",
)
def effect_summary(spark, folder):
    return SL.effect_summary(SL.effect_sizes(X.engineered(spark, folder), KEY))


def ks_sql(source: str) -> str:
    """KS statistic per feature from `source`(feature, value, first)."""
    return f"""SELECT feature, max(n_a) AS n_a, max(n_b) AS n_b, max(abs(ca / nullif(n_a, 0) - cb / nullif(n_b, 0))) AS ks_stat FROM (
 SELECT feature, CAST(sum(CASE WHEN first THEN 1 ELSE 0 END) OVER (PARTITION BY feature) AS BIGINT) AS n_a, CAST(sum(CASE WHEN first THEN 0 ELSE 1 END) OVER (PARTITION BY feature) AS BIGINT) AS n_b,
  sum(CASE WHEN first THEN 1 ELSE 0 END) OVER (PARTITION BY feature ORDER BY value) AS ca, sum(CASE WHEN first THEN 0 ELSE 1 END) OVER (PARTITION BY feature ORDER BY value) AS cb
 FROM {source} WHERE value IS NOT NULL) GROUP BY feature"""


_KOLMOGOROV = "2 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * reach * reach)))"


def with_p(tested: str) -> str:
    p = f"CASE WHEN reach < 0.2 THEN 1.0 ELSE least(greatest({_KOLMOGOROV}, 0.0), 1.0) END"
    return f"""SELECT feature, n_a, n_b, {r('ks_stat', 8)} AS ks_stat, {r(p, 6)} AS p_value
 FROM (SELECT *, sqrt(n_a * n_b / (n_a + n_b)) * ks_stat AS reach FROM ({tested}))"""


@query(
    "s10_ks_by_label",
    ctes("features", extra=_EFFECT)
    + with_p(ks_sql("(SELECT feature, value, distress_label = 0 AS first FROM base)")),
)
def ks_by_label(spark, folder):
    rows = X.engineered(spark, folder)
    long = rows.select("distress_label", *KEY).unpivot(["distress_label"], KEY, "feature", "value")
    tested = SL.ks_test(long, F.col("distress_label") == 0)
    return tested.select("feature", "n_a", "n_b", F.round("ks_stat", 8).alias("ks_stat"), F.round("p_value", 6).alias("p_value"))


def chi_sql(dimension: str, expression: str) -> str:
    return f"""SELECT '{dimension}' AS dimension, CASE WHEN any_value(dof) = 1 THEN sum(pow(abs(n - e) - least(0.5, abs(n - e)), 2) / e) ELSE sum(pow(n - e, 2) / e) END AS chi2, any_value(dof) AS dof FROM (
 SELECT n, rn * cn / total AS e, CAST((count(DISTINCT d) OVER () - 1) * (count(DISTINCT l) OVER () - 1) AS INTEGER) AS dof FROM (
  SELECT d, l, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY d) AS rn, sum(coalesce(n, 0)) OVER (PARTITION BY l) AS cn, sum(coalesce(n, 0)) OVER () AS total
  FROM (SELECT DISTINCT {expression} AS d FROM features) CROSS JOIN (SELECT DISTINCT distress_label AS l FROM features) LEFT JOIN (SELECT {expression} AS d, distress_label AS l, count(*) AS n FROM features GROUP BY 1, 2) USING (d, l)))"""


# The tail by another route: a finite sum for an even number of degrees of freedom; for an odd one the complementary error function, as a
# trapezoidal integral (or its own series near 0), and a finite sum. exp(-chi2 / 2) is kept apart, so logarithms stay exact.
_ERFC = """CASE WHEN z < 0.6 THEN exp(z * z) * (1 - 2 / sqrt(pi()) * list_sum([(CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END) * pow(z, 2 * n + 1) / (gamma(n + 1) * (2 * n + 1)) FOR n IN range(0, 25)]))
 ELSE z / pi() * 0.05 * list_sum([exp(-pow(0.05 * k, 2)) / (z * z + pow(0.05 * k, 2)) FOR k IN range(-160, 161)]) END"""
_LOG_P = f"""CASE WHEN dof < 1 OR chi2 <= 0 THEN 0.0
 WHEN dof % 2 = 0 THEN -chi2 / 2 + ln(list_sum([exp(k * ln(chi2 / 2) - lgamma(k + 1)) FOR k IN range(0, dof // 2)]))
 ELSE -chi2 / 2 + ln({_ERFC} + coalesce(list_sum([exp((k - 0.5) * ln(chi2 / 2) - lgamma(k + 0.5)) FOR k IN range(1, (dof - 1) // 2 + 1)]), 0.0)) END / ln(10)"""
_PERIOD = f"CASE WHEN fiscal_year >= {SPLIT_YEAR} THEN 'post' ELSE 'pre' END"


@query(
    "s11_chi_square",
    ctes("features")
    + f"SELECT dimension, {r('chi2', 5)} AS chi2, dof, {r('log_p', 5)} AS log10_p, {r('pow(10, log_p)', 6)} AS p_value, pow(10, log_p) >= 0.05 AS independent FROM (SELECT *, {_LOG_P} AS log_p FROM (SELECT *, sqrt(greatest(chi2, 0) / 2) AS z FROM ("
    + " UNION ALL ".join(chi_sql(d, e) for d, e in (("company_size_bucket", "company_size_bucket"), ("sector_proxy", "sector_proxy"), ("time_period", _PERIOD)))
    + ")))",
)
def chi_square(spark, folder):
    rows = _stored(spark, folder).withColumn("time_period", F.when(F.col("fiscal_year") >= SPLIT_YEAR, "post").otherwise("pre"))
    parts = [SL.chi_square(rows, d, "distress_label") for d in ("company_size_bucket", "sector_proxy", "time_period")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumns(
        {"chi2": F.round("chi2", 5), "log10_p": F.round("log10_p", 5), "p_value": F.round("p_value", 6)}
    )


@query(
    "s12_disparate_impact",
    ctes("features")
    + " UNION ALL ".join(
        f"""SELECT '{d}' AS dimension, {d} AS "group", {r('avg(distress_label)', 6)} AS rate, {r('avg(distress_label) / max(avg(distress_label)) OVER ()', 6)} AS impact_ratio,
 avg(distress_label) / max(avg(distress_label)) OVER () BETWEEN 0.8 AND 1.25 AS fair FROM features GROUP BY {d}"""
        for d in ("company_size_bucket", "sector_proxy")
    ),
)
def disparate_impact(spark, folder):
    rows = _stored(spark, folder)
    parts = [SL.disparate_impact(rows, d, "distress_label") for d in ("company_size_bucket", "sector_proxy")]
    return parts[0].unionByName(parts[1]).withColumns({"rate": F.round("rate", 6), "impact_ratio": F.round("impact_ratio", 6)})


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]
_BOTH = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, year(l_shipdate) < 1999 AS first FROM lineitem" for c in _MEASURES)


@query(
    "s14_dataset_drift",
    f"SELECT *, p_value <= 0.05 AS drifted FROM ({with_p(ks_sql('(' + _BOTH + ')'))})",
)
def dataset_drift(spark, folder):
    line = X.table(spark, folder, "lineitem")
    tested = SL.dataset_drift(line.where(F.year("l_shipdate") < 1999), line.where(F.year("l_shipdate") >= 1999), _MEASURES)
    return tested.withColumns({"ks_stat": F.round("ks_stat", 8), "p_value": F.round("p_value", 6)})


@query(
    "s14_drift_decision",
    f"""SELECT count(*) AS n_features_analyzed, count(*) FILTER (drifted) AS n_drifted_features, string_agg(feature, ',' ORDER BY feature) FILTER (drifted) AS drifted_features,
 {r('count(*) FILTER (drifted) / count(*)', 4)} AS drift_share, count(*) FILTER (drifted) / count(*) >= 0.5 AS dataset_drift
 FROM (SELECT feature, CASE WHEN reach < 0.2 THEN 1.0 ELSE {_KOLMOGOROV} END <= 0.05 AS drifted
  FROM (SELECT feature, sqrt(n_a * n_b / (n_a + n_b)) * ks_stat AS reach FROM ({ks_sql('(' + _BOTH.replace('year(l_shipdate) < 1999', "l_returnflag = 'A' AND l_quantity < 30") + ')')})))""",
)
def drift_decision(spark, folder):
    line = X.table(spark, folder, "lineitem")
    first = (F.col("l_returnflag") == "A") & (F.col("l_quantity") < 30)
    return SL.drift_decision(SL.dataset_drift(line.where(first), line.where(~first), _MEASURES))


_SUMMED = f"""SELECT l.dimension, l.slice, l.feature, avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS missing_rate,
 avg(CASE WHEN s > 0 AND (value < m - 3 * s OR value > m + 3 * s) THEN 1.0 ELSE 0.0 END) AS outlier_rate
 FROM long l JOIN (SELECT dimension, slice, feature, avg(value) AS m, stddev_samp(value) AS s FROM long GROUP BY ALL) USING (dimension, slice, feature) GROUP BY ALL"""


@query(
    "s19_concentration",
    ctes("features", extra=f"{_LONG}, summed AS ({_SUMMED})")
    + f"""SELECT dimension, slice, feature, 'missing_rate' AS measure, {r('missing_rate', 6)} AS value FROM summed
 UNION ALL SELECT dimension, slice, feature, 'outlier_rate', {r('outlier_rate', 6)} FROM summed""",
)
def concentration(spark, folder):
    stats = _stats(spark, folder)
    long = stats.select("dimension", "slice", "feature", "missing_rate", "outlier_rate").unpivot(
        ["dimension", "slice", "feature"], ["missing_rate", "outlier_rate"], "measure", "value"
    )
    return long.withColumn("value", F.round("value", 6))


@query(
    "j7_slice_pairs",
    ctes("features", extra=_MATRIX) + "SELECT DISTINCT dimension, slice_a, slice_b FROM matrix",
)
def slice_pairs(spark, folder):
    return SL.slice_pairs(rows_of(spark, folder), KEY)


@query(
    "r4_psi_matrix",
    ctes("features", extra=_MATRIX)
    + "SELECT dimension, slice_a, slice_b, "
    + ", ".join(f"{r(f'''max(CASE WHEN feature = '{f}' THEN psi END)''', 6)} AS {f}" for f in KEY)
    + " FROM matrix GROUP BY ALL",
)
def psi_matrix(spark, folder):
    from quarterline.operators.reshape import widen

    wide = widen(_matrix(spark, folder), ["dimension", "slice_a", "slice_b"], "feature", "psi", KEY)
    return wide.withColumns({f: F.round(f, 6) for f in KEY})


def _long_sql(section: str, source: str, name: list[str], values: list[str]) -> str:
    """A result as (section, name, measure, value) rows."""
    picked = ", ".join(f"CAST({v} AS DOUBLE) AS {v}" for v in values)
    return f"""SELECT '{section}' AS section, name, measure, {r('value', 3)} AS value FROM (
 SELECT {" || ' / ' || ".join(name)} AS name, {picked} FROM ({source})) UNPIVOT INCLUDE NULLS (value FOR measure IN ({", ".join(values)}))"""


def _report_sql() -> str:
    from quarterline.catalog.registry import ORACLE

    alerts = ctes("features", extra=_MATRIX) + "SELECT printf('HIGH DRIFT: %s between %s and %s (PSI=%.3f)', feature, slice_a, slice_b, psi) AS alert, psi FROM matrix WHERE psi > 0.25"
    return " UNION ALL ".join(
        [
            _long_sql("slice statistics", ORACLE["s2_slice_stats"], ["dimension", "slice", "feature"], ["sample_count", *_STATS]),
            _long_sql("drift", ORACLE["s5_drift_matrix"], ["dimension", "slice_a", "slice_b", "feature"], ["psi", "js_divergence"]),
            _long_sql("drift alerts", alerts, ["alert"], ["psi"]),
            _long_sql("effect sizes", ORACLE["s9_effect_sizes"], ["feature", "signal"], ["cohens_d"]),
            _long_sql("fairness", ORACLE["s16_model_fairness"], ["dimension", "slice", "metric"], ["slice_value", "overall_value", "gap"]),
            _long_sql("thresholds", ORACLE["s17_threshold_suggestions"], ["dimension", "slice"], ["suggested_threshold"]),
        ]
    )


@query("s18_bias_report", _report_sql())
def bias_report(spark, folder):
    """Slice statistics, drift, effect sizes and fairness as one long table."""
    from quarterline.catalog.evaluation import _fair
    from quarterline.operators.joins import stacked

    engineered = _stored(spark, folder)
    members = SL.slice_members(engineered, SPLIT_YEAR, RATE_LIMIT)
    matrix = SL.drift_matrix(engineered, KEY, members)
    fair = materialise(_fair(spark, folder))
    report = stacked(
        SL.report_rows("slice statistics", SL.slice_stats(engineered, KEY, members=members), ["dimension", "slice", "feature"], ["sample_count", *_STATS]),
        SL.report_rows("drift", matrix, ["dimension", "slice_a", "slice_b", "feature"], ["psi", "js_divergence"]),
        SL.report_rows("drift alerts", SL.drift_alerts(matrix), ["alert"], ["psi"]),
        SL.report_rows("effect sizes", SL.effect_sizes(engineered, KEY), ["feature", "signal"], ["cohens_d"]),
        SL.report_rows("fairness", fair, ["dimension", "slice", "metric"], ["slice_value", "overall_value", "gap"]),
        SL.report_rows("thresholds", SL.threshold_suggestions(fair), ["dimension", "slice"], ["suggested_threshold"]),
    )
    return report.withColumn("value", F.round("value", 3))
