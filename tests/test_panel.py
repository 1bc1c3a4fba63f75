from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarterline.operators import windows as WN
from quarterline.plans import cleaning, features, panel

PANEL = "firm_id string, date date, net_income double, operating_cash_flow double, total_liabilities double, total_equity double, operating_income double, interest_expense double, retained_earnings double"


def ladder(spark, n=10, **series):
    """One firm, n quarters; unspecified measures are harmless."""
    calm = {"net_income": 1.0, "operating_cash_flow": 1.0, "total_liabilities": 1.0, "total_equity": 1.0, "operating_income": 9.0, "interest_expense": 1.0, "retained_earnings": 1.0}
    data = []
    for i in range(n):
        day = date(2018 + i // 4, 3 * (i % 4) + 1, 1)
        picked = [series[k][i] if k in series else v for k, v in calm.items()]
        data.append(("f", day, *[None if v is None else float(v) for v in picked]))
    return spark.createDataFrame(data, PANEL)


def column(df, name):
    return [r[name] for r in df.orderBy("date").collect()]


def test_two_losses_in_a_row(spark):
    df = panel.with_signals(ladder(spark, net_income=[1, -1, -1, 1, -1, 1, None, -1, -1, -1]))
    assert column(df, "s1_neg_income") == [False, False, True, False, False, False, False, False, True, True]


def test_leverage_needs_a_fifth_more(spark):
    debt = [5.0, 5.0, 5.0, 5.0, 5.95, 6.0, 6.25, 0.0, 6.5, 6.5]
    equity = [1.0] * 8 + [0.0, 1.0]
    df = panel.with_signals(ladder(spark, total_liabilities=debt, total_equity=equity))
    assert column(df, "s3_leverage") == [False] * 5 + [True, True] + [False] * 3


def test_coverage_ignores_unknown_ratios(spark):
    income = [1.0] * 10
    interest = [1.0, 1.0, 0.0, 1.0, 0.5, 1.0, 1.0, None, 1.0, 1.0]
    df = panel.with_signals(ladder(spark, operating_income=income, interest_expense=interest))
    assert column(df, "s4_low_coverage") == [False, True, False, False, False, False, True, False, False, True]


def test_retained_earnings_need_three_falls(spark):
    df = panel.with_signals(ladder(spark, retained_earnings=[9, 8, 7, 6, 6, 5, 4, 3, None, 1]))
    assert column(df, "s5_declining_re") == [False, False, False, True, False, False, False, True, False, False]


def test_label_looks_forward_and_never_back(spark):
    losses = [1, -1, -1, 1, 1, -1, -1, -1, 1, 1]
    df = panel.label(ladder(spark, net_income=losses, operating_cash_flow=losses), keep_signals=True)
    fired = [c >= 2 for c in column(df, "signal_count")]
    assert column(df, "distress_label") == [int(x) for x in fired[1:]] + [0]
    two = panel.label(ladder(spark, net_income=losses, operating_cash_flow=losses), horizon=2)
    assert column(two, "distress_label") == [int(x) for x in fired[2:]] + [0, 0]
    assert "signal_count" not in two.columns


def test_old_rule_uses_one_signal(spark):
    df = panel.two_loss_label(ladder(spark, net_income=[1, -1, -1, 1, 1, 1, 1, 1, 1, 1]))
    assert column(df, "distress_label_old") == [0, 1] + [0] * 8


def test_build_panel_checks_dates_and_duplicates(spark):
    names = {v: k for k, v in panel.PANEL_NAMES.items()}
    measures = ", ".join(f"{names[m]} double" for m in panel.MEASURES)
    data = [
        ("f", "2020-03-31", "2020-05-01", *[1.0] * 8),
        ("f", "2020-03-31", "2020-05-15", *[2.0] * 8),
        ("f", "2020-12-31", "2021-02-01", *[3.0] * 8),
        ("f", "1992-12-31", "1993-02-01", *[4.0] * 8),
        ("f", "never", "1993-02-01", *[5.0] * 8),
    ]
    df = panel.build_panel(spark.createDataFrame(data, f"cik string, end_date string, filed_date string, {measures}"))
    got = df.orderBy("date").select("firm_id", "total_assets", "days_since_previous", "net_income_lag1", "net_income_lag4").collect()
    assert [tuple(r) for r in got] == [("f", 2.0, None, None, None), ("f", 3.0, 275, 2.0, None)]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="retained_earnings"):
        panel.require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "retained_earnings"])


def test_fills(spark):
    data = [("f", i, v) for i, v in enumerate([None, 1.0, None, 3.0, None])] + [("g", 0, None), ("g", 1, None)]
    df = spark.createDataFrame(data, "firm_id string, t int, v double")
    spec = WN.ordered(["firm_id"], ["t"])
    both = [r["v"] for r in WN.fill_both_ways(df, ["v"], spec).orderBy("firm_id", "t").collect()]
    assert both == [1.0, 1.0, 1.0, 3.0, 3.0, None, None]
    ahead = [r["v"] for r in WN.forward_fill(df, ["v"], spec).orderBy("firm_id", "t").collect()]
    assert ahead == [0.0, 1.0, 1.0, 3.0, 3.0, 0.0, 0.0]


def test_backward_fill_looks_at_a_partition_once(spark):
    spec = WN.ordered(["firm_id"], ["t"])
    df = spark.createDataFrame([("f", 1, None), ("f", 2, None), ("f", 3, 5.0), ("f", 4, None), ("g", 1, None)], "firm_id string, t int, v double")
    filled = WN.fill_both_ways(df, ["v"], spec)
    assert rows(filled) == [("f", 1, 5.0), ("f", 2, 5.0), ("f", 3, 5.0), ("f", 4, 5.0), ("g", 1, None)]
    # A frame from the row to the end is read again for every row.
    assert "currentrow$(), unboundedfollowing$()" not in filled._jdf.queryExecution().executedPlan().toString()


def test_fill_by_date_is_global(spark):
    data = [(1, "2020-01-01", None), (2, "2020-01-02", 5.0), (3, "2020-01-02", None), (4, "2020-01-03", None), (5, None, None)]
    df = spark.createDataFrame(data, "k int, d string, v double").withColumn("d", F.to_date("d"))
    assert rows(WN.fill_by_date(df, ["v"], "d").select("k", "v")) == [(k, 5.0) for k in range(1, 6)]


def test_identity_repair_uses_original_sides(spark):
    data = [(None, 2.0, 3.0), (5.0, None, 3.0), (5.0, 2.0, None), (None, None, 3.0)]
    df = spark.createDataFrame(data, "Assets double, Liabilities double, StockholdersEquity double")
    assert rows(cleaning.repair_identity(df)) == [(5.0, 2.0, 3.0)] * 3 + [(None, None, 3.0)]


def feature_panel(spark, n=20):
    data = []
    for firm in ("a", "b"):
        for i in range(n // 2):
            data.append((firm, 2020 + i // 4, f"Q{i % 4 + 1}", date(2020 + i // 4, 3 * (i % 4) + 1, 1), 100.0 + i, 40.0, 60.0, 10.0 + i, 5.0, 20.0, 1.5 if i < 5 else None))
    return spark.createDataFrame(
        data,
        "firm_id string, fiscal_year int, fiscal_period string, filed_date date, total_assets double, total_liabilities double, total_equity double, net_income double, AssetsCurrent double, ProfitLoss double, FedFundsRate double",
    )


def test_engineered_features(spark):
    df = features.engineer(feature_panel(spark))
    assert df.count() == 20
    first = df.where("firm_id = 'a' AND fiscal_year = 2020 AND fiscal_period = 'Q1'").first()
    assert first["roa"] == pytest.approx(0.1) and first["debt_to_equity"] == pytest.approx(40 / 60)
    assert first["current_ratio"] is None  # no current liabilities
    growth = [r["net_income_growth_yoy"] for r in df.where("firm_id = 'a'").orderBy("fiscal_year", "fiscal_period").collect()]
    assert growth[:4] == [None] * 4 and growth[4] == pytest.approx(0.4)
    assert {r["fed_funds"] for r in df.collect()} == {1.5}
    assert sorted(r["n"] for r in df.groupBy("company_size_bucket").agg(F.count("*").alias("n")).collect()) == [5, 5, 5, 5]
    assert set(features.feature_names()) <= set(df.columns) and len(features.feature_names()) == 53


def test_rolling_std_needs_two_values(spark):
    df = features.add_rolling(features.add_growth(features.add_ratios(features.statement_view(feature_panel(spark)))))
    std = [r["roa_rolling_4q_std"] for r in df.where("firm_id = 'a'").orderBy("fiscal_year", "fiscal_period").collect()]
    assert std[0] is None and std[1] is not None


def test_clip(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in (1, 2, 3, 4, 5, 100)] + [(None, 1.0)], "x double, y double")
    got = [r["x"] for r in features.clip_spread(df, ["x", "y"], 2.0).collect()]
    assert max(v for v in got if v is not None) < 100 and None in got


def test_size_cuts_never_part_equal_values(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)], "Assets double")
    got = features.size_by_cuts(df, features.size_cuts(df))
    assert got.where("Assets = 1").select("company_size_bucket").distinct().count() == 1


def test_one_shuffle_for_the_whole_firm_chain(spark, small):
    """After the pivot, fills, lags and label signals share one exchange on the firm."""
    from quarterline import fixtures as X

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    plan = X.labeled_panel(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(firm_id") == 2  # pivot key, firm
    assert "SinglePartition" not in plan


def test_yearly_rows_and_own_dates_reach_the_panel(spark):
    from quarterline.plans import cleaning

    data = [("f", 2019, "FY", "Assets", 5.0, "2020-02-01", "2019-09-30"), ("f", 2020, "Q1", "Assets", 6.0, "2020-05-01", None), ("g", 2019, "FY", "Assets", 7.0, "2020-02-01", None)]
    facts = spark.createDataFrame(data, "firm_id string, fiscal_year int, fiscal_period string, tag string, value double, filed_date string, end_date string")
    series = spark.createDataFrame([], "series_id string, date date, value double")
    out = {(r.firm_id, r.fiscal_period): str(r.end_date) for r in cleaning.clean(facts, series).collect()}
    assert out == {("f", "FY"): "2019-09-30", ("f", "Q1"): "2020-03-31", ("g", "FY"): "2019-12-31"}


def test_the_row_of_a_date_does_not_depend_on_the_order_of_rows(spark):
    """Q4 and FY end on one day and are filed on one: the quarter stays; equal filings are told apart by their values."""
    names = {v: k for k, v in panel.PANEL_NAMES.items()}
    measures = ", ".join(f"{names[m]} double" for m in panel.MEASURES)
    data = [
        ("f", 2020, "FY", "2020-12-31", "2021-02-01", *[4.0] * 8),
        ("f", 2020, "Q4", "2020-12-31", "2021-02-01", *[1.0] * 8),
        ("f", 2020, "Q4", "2020-12-31", "2021-02-01", *[2.0] * 8),
        ("g", 2020, "Q4", "2020-12-31", None, *[9.0] * 8),
        ("g", 2020, "FY", "2020-12-31", "2021-03-01", *[3.0] * 8),
    ]
    schema = f"cik string, fiscal_year int, fiscal_period string, end_date string, filed_date string, {measures}"
    for turn in range(5):
        turned = data[turn:] + data[:turn]
        got = panel.build_panel(spark.createDataFrame(turned, schema).coalesce(1)).select("firm_id", "total_assets").collect()
        assert sorted(map(tuple, got)) == [("f", 2.0), ("g", 3.0)]


def test_filings_of_a_quarter_keep_their_own_rows(spark):
    facts = spark.createDataFrame(
        [
            ("f", 2020, "Q1", "Assets", "2020-05-01", 10.0, "2020-03-31"), ("f", 2020, "Q1", "Liabilities", "2020-05-01", 4.0, "2020-03-31"),
            ("f", 2020, "Q1", "Assets", "2020-06-01", 20.0, "2020-03-31"), ("f", 2020, "Q2", "Assets", "2020-08-01", 30.0, None),
        ],
        "firm_id string, fiscal_year int, fiscal_period string, tag string, filed_date string, value double, end_date string",
    )
    series = spark.createDataFrame([("DFF", date(2020, 2, 1), 1.5)], "series_id string, date date, value double")
    tags = ["Assets", "Liabilities", "StockholdersEquity", "NetIncomeLoss", "NetCashProvidedByUsedInOperatingActivities", "InterestExpense", "OperatingIncomeLoss", "RetainedEarningsAccumulatedDeficit"]
    filed = cleaning.clean(facts, series, tags, grain="filing")
    assert rows(filed.select("filed_date", "end_date", "Assets", "Liabilities", "StockholdersEquity", "FedFundsRate")) == [
        ("2020-05-01", date(2020, 3, 31), 10.0, 4.0, 6.0, 1.5), ("2020-06-01", date(2020, 3, 31), 20.0, 0.0, 0.0, 1.5), ("2020-08-01", date(2020, 6, 30), 30.0, 0.0, 0.0, 1.5),
    ]
    made = panel.build_panel(filed).orderBy("date").select("date", "total_assets", "total_liabilities").collect()
    assert [tuple(r) for r in made] == [(date(2020, 3, 31), 20.0, 0.0), (date(2020, 6, 30), 30.0, 0.0)]
    merged = cleaning.clean(facts, series, tags)
    assert rows(merged.select("fiscal_period", "Assets", "Liabilities")) == [("Q1", 20.0, 4.0), ("Q2", 30.0, 0.0)]
    with pytest.raises(ValueError, match="grain"):
        cleaning.clean(facts, series, tags, grain="page")


def test_typed_facts_read_years_and_names_as_they_come(spark):
    raw = spark.createDataFrame(
        [
            ("17", "2019.0", " q1", "Assets", "2020-05-01", 1.0, None), ("17", "2019", "Q1", "Assets", "2020-06-01", 2.0, None), ("17", "2019", "Q5", "Assets", "2020-06-01", 3.0, None),
            ("17", "x", "Q1", "Assets", "2020-06-01", 4.0, None), ("17", "nan", "Q1", "Assets", "2020-06-01", 5.0, None), ("17", "2031", "FY", "Assets", "soon", 6.0, None),
            ("17", "2030", "fy", "Assets", "soon", 7.0, None),
        ],
        "` CIK` string, Fiscal_Year string, fiscal_period string, TAG string, filed_date string, value double, quarter_end_date string",
    )
    typed = cleaning.typed_facts(raw, ["value"], "cik")
    assert "quarter_end_date" not in typed.columns
    assert rows(typed.select("cik", "fiscal_year", "fiscal_period", "quarter_key", "value")) == [("0000000017", 2019, "Q1", "2019_Q1", 2.0), ("0000000017", 2030, "FY", "2030_FY", 7.0)]
