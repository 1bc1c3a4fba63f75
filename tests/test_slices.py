import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarterline.operators import slices as SL


def normals(n, mean, seed):
    rng = random.Random(seed)
    return [rng.gauss(mean, 1) for _ in range(n)]


def long(spark, **sides):
    data = [("x", name, float(v)) for name, values in sides.items() for v in values]
    return spark.createDataFrame(data, "feature string, side string, value double")


def drift(spark, a, b):
    return SL.pair_drift(long(spark, a=a, b=b), ["feature"], "side").first()


def test_identical_and_shifted_distributions(spark):
    base = normals(1000, 0, 1)
    same, moved = drift(spark, base, base), drift(spark, base, normals(1000, 3, 2))
    assert same["psi"] == pytest.approx(0, abs=1e-9) and same["js_divergence"] == pytest.approx(0, abs=1e-6)
    assert moved["psi"] > 0.25 and 0.3 < moved["js_divergence"] <= math.sqrt(math.log(2)) + 1e-9


def test_small_and_constant_sides(spark):
    few = drift(spark, [1.0, 2.0, 3.0], normals(20, 0, 1))
    assert few["psi"] is None and few["js_divergence"] is None
    flat = drift(spark, [5.0] * 100, [5.0] * 100)
    assert flat["psi"] == 0.0 and flat["js_divergence"] == 0.0


def test_psi_by_hand(spark):
    a, b = [0.0] * 10 + [10.0] * 10, [0.0] * 5 + [10.0] * 15
    p, q = [0.5, 0.5], [0.25, 0.75]
    assert drift(spark, a, b)["psi"] == pytest.approx(sum((y - x) * math.log(y / x) for x, y in zip(p, q)), abs=1e-4)


def engineered(spark):
    rng = random.Random(5)
    data = []
    for firm in range(10):
        for year in range(2014, 2019):
            data.append((str(firm), year, ["small", "mid", "large", "mega"][firm % 4], "tech_pharma" if firm % 2 else "services_other", rng.uniform(0, 4) if firm else None, rng.gauss(0, 1), rng.gauss(1, 2)))
    return spark.createDataFrame(data, "firm_id string, fiscal_year int, company_size_bucket string, sector_proxy string, fed_funds double, roa double, roe double")


def test_each_dimension_covers_all_rows_once(spark):
    counts = dict(rows(SL.sliced(engineered(spark)).groupBy("dimension").agg(F.count("*"))))
    # one firm has no rate and so no macro slice
    assert counts == {"company_size": 50, "sector_proxy": 50, "time_period": 50, "macro_regime": 45}


def test_slice_stats_match_plain_aggregates(spark):
    df = engineered(spark)
    stats = SL.slice_stats(SL.sliced(df), ["roa", "roe", "fed_funds"])
    row = stats.where("slice = 'small' AND feature = 'roa'").first()
    values = [r["roa"] for r in df.where("company_size_bucket = 'small'").collect()]
    assert row["sample_count"] == len(values) and row["mean"] == pytest.approx(sum(values) / len(values))
    missing = stats.where("slice = 'small' AND feature = 'fed_funds'").first()
    assert missing["missing_rate"] == pytest.approx(5 / 15)


def test_grouping_sets_agree_with_the_exploded_form(spark):
    df = engineered(spark)
    df.createOrReplaceTempView("engineered")
    want = spark.sql(
        """SELECT coalesce(company_size_bucket, sector_proxy) AS slice, avg(roa) AS m FROM engineered
        GROUP BY GROUPING SETS ((company_size_bucket), (sector_proxy))"""
    )
    got = SL.sliced(df).where("dimension IN ('company_size', 'sector_proxy')").groupBy("slice").agg(F.avg("roa").alias("m"))
    for (s1, m1), (s2, m2) in zip(rows(got), rows(want)):
        assert s1 == s2 and m1 == pytest.approx(m2)


def test_ks_statistic_and_p_value(spark):
    data = [("x", float(v), True) for v in range(100)] + [("x", float(v) + 20, False) for v in range(100)]
    df = spark.createDataFrame(data, "feature string, value double, first boolean")
    row = SL.ks_test(df, F.col("first")).first()
    assert row["ks_stat"] == pytest.approx(0.20)
    # published asymptotic value: Q(sqrt(50) * 0.2) with Q(1.41421) = 0.0366
    assert row["p_value"] == pytest.approx(0.0366, abs=5e-4)


def test_kolmogorov_critical_values(spark):
    # classic table: Q(1.2238) = 0.10, Q(1.3581) = 0.05, Q(1.6276) = 0.01
    table = spark.createDataFrame([(1.2238, 0.10), (1.3581, 0.05), (1.6276, 0.01), (0.05, 1.0)], "reach double, p double")
    got = table.select(SL.ks_p_value(F.col("reach"), F.lit(2.0), F.lit(2.0)).alias("q"), "p").collect()
    for row in got:
        assert row["q"] == pytest.approx(row["p"], abs=2e-4)


def test_chi_square(spark):
    data = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 40
    df = spark.createDataFrame(data, "d string, y int")
    row = SL.chi_square(df, "d", "y").first()
    assert row["dof"] == 1 and row["chi2"] == pytest.approx(0.4464, abs=1e-3)  # with Yates' correction
    three = spark.createDataFrame(data + [("c", 1)] * 10, "d string, y int")
    expected = {("a", 0): 30 * 40 / 110, ("a", 1): 30 * 70 / 110, ("b", 0): 70 * 40 / 110, ("b", 1): 70 * 70 / 110, ("c", 0): 400 / 110, ("c", 1): 700 / 110}
    seen = {("a", 0): 10, ("a", 1): 20, ("b", 0): 30, ("b", 1): 40, ("c", 0): 0, ("c", 1): 10}
    want = sum((seen[k] - e) ** 2 / e for k, e in expected.items())
    row = SL.chi_square(three, "d", "y").first()
    assert row["dof"] == 2 and row["chi2"] == pytest.approx(want)


def test_effect_sizes(spark):
    data = [(0, float(i % 10)) for i in range(100)] + [(1, float(i % 10) + 5) for i in range(100)]
    df = spark.createDataFrame(data, "distress_label int, x double").withColumn("few", F.when(F.col("x") > 13, 1.0))
    got = SL.effect_sizes(df, ["x", "few"]).collect()
    assert len(got) == 1 and got[0]["signal"] == "LARGE" and got[0]["cohens_d"] == pytest.approx(5 / math.sqrt(825 / 99), abs=1e-9)


def performance(spark):
    data = [
        ("company_size", "small", 100, 0.72, 0.60), ("company_size", "mid", 200, 0.85, 0.80), ("company_size", "large", 150, 0.88, 0.82),
        ("company_size", "mega", 50, 0.90, 0.85), ("sector_proxy", "tech_pharma", 120, 0.86, 0.78), ("sector_proxy", "financial", 130, 0.65, 0.45),
        ("sector_proxy", "unknown", 10, None, None),
    ]
    return spark.createDataFrame(data, "dimension string, slice string, sample_count int, roc_auc double, recall_at_5pct double")


def test_fairness_alerts_and_threshold_floor(spark):
    fair = SL.fairness(performance(spark), ["roc_auc", "recall_at_5pct"])
    assert fair.count() == 12
    alerts = rows(fair.where("bias_alert").select("slice", "metric"))
    assert ("financial", "roc_auc") in alerts and ("financial", "recall_at_5pct") in alerts and ("mega", "roc_auc") not in alerts
    suggested = {r["slice"]: r for r in SL.threshold_suggestions(fair).collect()}
    gap = fair.where("slice = 'financial' AND metric = 'recall_at_5pct'").first()["gap"]
    assert suggested["financial"]["suggested_threshold"] == pytest.approx(max(0.1, round(0.5 - 0.05 * max(1, int(gap / 0.05)), 3)))
    assert "(limit 0.1)" in suggested["financial"]["reason"]
    floor = SL.threshold_suggestions(fair, base=0.15).where("slice = 'financial'").first()
    assert floor["suggested_threshold"] == 0.1


def test_dataset_drift_decision(spark):
    a = spark.createDataFrame([(float(i), float(i % 7)) for i in range(200)], "moved double, same double")
    b = spark.createDataFrame([(float(i) + 150, float(i % 7)) for i in range(200)], "moved double, same double")
    tested = SL.dataset_drift(a, b, ["moved", "same"])
    row = SL.drift_decision(tested).first()
    assert row["drifted_features"] == "moved" and row["drift_share"] == 0.5 and row["dataset_drift"]


def test_chi_square_p_values_of_the_printed_tables(spark):
    cases = [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (18.307038, 10, 0.05), (0.0, 3, 1.0), (0.015791, 1, 0.9), (5000.0, 4, 0.0)]
    df = spark.createDataFrame(cases, "chi2 double, dof int, p double")
    for row in df.withColumn("got", SL.chi_square_p_value(F.col("chi2"), F.col("dof"))).collect():
        assert abs(row["got"] - row["p"]) < 1e-5


@pytest.mark.parametrize(("statistic", "dof"), [(0.3, 1), (3.84, 1), (18.0, 1), (68.6, 1), (91.8, 1), (0.7, 2), (25.0, 2), (1.0, 3), (12.0, 3), (1381.0, 3), (5000.0, 4), (90.0, 100), (101.0, 100), (160.0, 100), (700.0, 501)])
def test_chi_square_tail_by_closed_forms(spark, statistic, dof):
    """Finite sums and the complementary error function, in logarithms."""
    x = statistic / 2
    if dof % 2 == 0:
        terms = [k * math.log(x) - math.lgamma(k + 1) for k in range(dof // 2)]
    else:
        # exp(x) erfc(sqrt(x)) by its continued fraction, which needs no small numbers.
        z, f = math.sqrt(x), 0.0
        for k in range(4000, 0, -1):
            f = k / 2 / (z + f)
        scaled = 1 / (math.sqrt(math.pi) * (z + f)) if x > 1 else math.exp(x) * math.erfc(z)
        terms = [math.log(scaled)] + [(k - 0.5) * math.log(x) - math.lgamma(k + 0.5) for k in range(1, (dof - 1) // 2 + 1)]
    top = max(terms)
    want = -x + top + math.log(sum(math.exp(t - top) for t in terms))
    got = spark.range(1).select(SL.chi_square_log_p(F.lit(statistic), F.lit(dof))).first()[0]
    assert got == pytest.approx(want, rel=1e-10, abs=1e-10)


def test_chi_square_tail_falls_and_never_rises(spark):
    grid = spark.range(1, 4000).select((F.col("id") / 2.0).alias("x"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(7), F.lit(30))).alias("dof"))
    tails = {}
    for x, dof, p in grid.select("x", "dof", SL.chi_square_log_p(F.col("x"), F.col("dof"))).orderBy("dof", "x").collect():
        assert p <= tails.get(dof, 0.0)
        tails[dof] = p
    assert all(p < -900 for p in tails.values())
