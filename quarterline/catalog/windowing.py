"""Window operators over firm panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import FISCAL, ctes, r
from quarterline.operators import windows as WN
from quarterline.operators.ranks import with_row_number
from quarterline.plans import cleaning, features, panel
from quarterline.session import materialise

_LAGS = [f"{m}_lag{k}" for m in panel.MEASURES for k in (1, 4)]


@query("w1_lags", ctes("panel") + f"SELECT firm_id, date, {', '.join(_LAGS)} FROM panel")
def lags(spark, folder):
    return X.firm_panel(spark, folder).select("firm_id", "date", *_LAGS)


@query(
    "w2_day_gap",
    ctes("sparse")
    + """SELECT firm_id, date, gap, coalesce(gap > 120, false) AS missing_quarter FROM (SELECT *, CAST(date_diff('day', lag(date) OVER (PARTITION BY firm_id ORDER BY date), date) AS INTEGER) AS gap FROM sparse)""",
)
def gap(spark, folder):
    rows = X.sparse(spark, folder).withColumn("gap", WN.day_gap("date", panel.firm_dates()))
    return rows.select("firm_id", "date", "gap", F.coalesce(F.col("gap") > 120, F.lit(False)).alias("missing_quarter"))


@query("w3_row_number", ctes("panel") + f"SELECT firm_id, quarter_key, CAST(row_number() OVER ({FISCAL}) AS INTEGER) AS row_num FROM panel")
def row_number(spark, folder):
    return X.firm_panel(spark, folder).select("firm_id", "quarter_key", F.row_number().over(features.fiscal_order()).alias("row_num"))


_GROWN = list(features.GROWTH)


@query("w4_growth", ctes("growth") + f"SELECT firm_id, fiscal_year, fiscal_period, {', '.join(r(g) + ' AS ' + g for g in _GROWN)} FROM growth")
def growth(spark, folder):
    view = features.add_growth(features.statement_view(X.labeled_panel(spark, folder)))
    return view.select(*features.FIRM_QUARTER, *[F.round(g, 4).alias(g) for g in _GROWN])


@query(
    "w4_growth_signed",
    ctes("inputs")
    + f"""SELECT firm_id, fiscal_year, fiscal_period, {r('("NetIncomeLoss" - lag("NetIncomeLoss", 4) OVER w) / nullif(lag("NetIncomeLoss", 4) OVER w, 0)')} AS net_income_growth_yoy
 FROM inputs WINDOW w AS ({FISCAL})""",
)
def growth_signed(spark, folder):
    view = features.add_growth(features.statement_view(X.labeled_panel(spark, folder)), denominator="signed")
    return view.select(*features.FIRM_QUARTER, F.round("net_income_growth_yoy", 4).alias("net_income_growth_yoy"))


_MEANS = [n for n in features.rolling_names() if n.endswith("mean")]
_STDS = [n for n in features.rolling_names() if n.endswith("std")]


def _rolled(spark, folder, names):
    view = features.add_ratios(features.statement_view(X.labeled_panel(spark, folder)))
    rolled = features.add_rolling(features.add_growth(view))
    return rolled.select(*features.FIRM_QUARTER, *[F.round(n, 4).alias(n) for n in names])


@query("w5_rolling_mean", ctes("rolling") + f"SELECT firm_id, fiscal_year, fiscal_period, {', '.join(r(n) + ' AS ' + n for n in _MEANS)} FROM rolling")
def rolling_mean(spark, folder):
    return _rolled(spark, folder, _MEANS)


@query("w6_rolling_std", ctes("rolling") + f"SELECT firm_id, fiscal_year, fiscal_period, {', '.join(r(n) + ' AS ' + n for n in _STDS)} FROM rolling")
def rolling_std(spark, folder):
    return _rolled(spark, folder, _STDS)


_CASH = '"CashAndCashEquivalentsAtCarryingValue"'


@query("w7_cash_change", ctes("panel") + f"SELECT firm_id, quarter_key, {r(f'{_CASH} - lag({_CASH}) OVER ({FISCAL})')} AS cash_change FROM panel")
def cash_change(spark, folder):
    step = WN.change(F.col("CashAndCashEquivalentsAtCarryingValue"), features.fiscal_order())
    return X.firm_panel(spark, folder).select("firm_id", "quarter_key", F.round(step, 4).alias("cash_change"))


_W = "PARTITION BY firm_id ORDER BY date"


@query(
    "w8_fill_both_ways",
    ctes("sparse")
    + f"""SELECT firm_id, date, coalesce(total, last_value(total IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 first_value(total IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS total FROM sparse""",
)
def both_ways(spark, folder):
    return WN.fill_both_ways(X.sparse(spark, folder), ["total"], panel.firm_dates())


@query(
    "w9_fill_by_date",
    """WITH base AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice END AS rate FROM orders),
 filled AS (SELECT day, coalesce(max(rate), last_value(max(rate) IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(max(rate) IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS day_rate FROM base GROUP BY day)
 SELECT o_orderkey, coalesce(rate, day_rate) AS rate FROM base JOIN filled USING (day)""",
)
def by_date(spark, folder):
    known = (F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    rows = X.table(spark, folder, "orders").select("o_orderkey", "o_orderdate", F.when(known, F.col("o_totalprice")).alias("rate"))
    return WN.fill_by_date(rows, ["rate"], "o_orderdate").select("o_orderkey", "rate")


@query(
    "w10_forward_fill",
    ctes("sparse") + f"SELECT firm_id, date, coalesce(last_value(total IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS total FROM sparse",
)
def forward(spark, folder):
    return WN.forward_fill(X.sparse(spark, folder), ["total"], panel.firm_dates())


@query(
    "w11_size_ntile",
    ctes("inputs")
    + """SELECT firm_id, fiscal_year, fiscal_period, CASE ntile(4) OVER (ORDER BY "Assets", firm_id, fiscal_year, fiscal_period)
 WHEN 1 THEN 'small' WHEN 2 THEN 'mid' WHEN 3 THEN 'large' WHEN 4 THEN 'mega' END AS company_size_bucket FROM inputs""",
)
def size_ntile(spark, folder):
    view = materialise(features.statement_view(X.labeled_panel(spark, folder)).select(*features.FIRM_QUARTER, "Assets"))
    return features.size_by_rank(view).drop("Assets")


@query("w12_size_cuts", ctes("cut_features") + "SELECT firm_id, fiscal_year, fiscal_period, company_size_bucket FROM cut_features")
def size_cuts(spark, folder):
    view = materialise(features.statement_view(X.labeled_panel(spark, folder)).select(*features.FIRM_QUARTER, "Assets"))
    return features.size_by_cuts(view, features.size_cuts(view)).drop("Assets")


def _signals(spark, folder, *names):
    return X.labeled_panel(spark, folder, keep_signals=True).select("firm_id", "quarter_key", *names)


@query("w13_two_in_a_row", ctes("signals") + "SELECT firm_id, quarter_key, s1_neg_income, s2_neg_ocf, s4_low_coverage FROM signals")
def two_in_a_row(spark, folder):
    return _signals(spark, folder, "s1_neg_income", "s2_neg_ocf", "s4_low_coverage")


@query("w14_ratio_rise", ctes("signals") + "SELECT firm_id, quarter_key, s3_leverage FROM signals")
def ratio_rise(spark, folder):
    return _signals(spark, folder, "s3_leverage")


@query("w15_strictly_falling", ctes("signals") + "SELECT firm_id, quarter_key, s5_declining_re FROM signals")
def falling(spark, folder):
    return _signals(spark, folder, "s5_declining_re")


@query("w16_forward_label", ctes("labeled") + "SELECT firm_id, quarter_key, distress_label FROM labeled")
def forward_label(spark, folder):
    return _signals(spark, folder, "distress_label")


@query(
    "w17_score_change",
    ctes("qscores")
    + f"""SELECT firm_id, fiscal_year, fiscal_period, {r('coalesce(score - lag(score) OVER (' + FISCAL + '), 0.0)')} AS change FROM qscores""",
)
def score_change(spark, folder):
    from quarterline.operators import lookups

    rows = lookups.best_per_quarter(X.scores(spark, folder), "score", ["o_orderkey"])
    step = F.coalesce(WN.change(F.col("score"), features.fiscal_order()), F.lit(0.0))
    return rows.select(*features.FIRM_QUARTER, F.round(step, 4).alias("change"))


@query("w18_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders")
def rank(spark, folder):
    rows = X.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return with_row_number(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], "rank").select("o_orderkey", "rank")


@query(
    "w19_running_counts",
    ctes("scores")
    + """SELECT segment, score, CAST(sum(sum(label)) OVER w AS BIGINT) AS pos_upto, CAST(sum(sum(1 - label)) OVER w AS BIGINT) AS neg_upto FROM scores GROUP BY segment, score
 WINDOW w AS (PARTITION BY segment ORDER BY score)""",
)
def running_counts(spark, folder):
    from quarterline.operators import metrics

    return metrics.ladder(X.scores(spark, folder), ["segment"]).select("segment", "score", "pos_upto", "neg_upto")


@query(
    "h0a_cleaning_stage",
    ctes("inputs")
    + 'SELECT firm_id, fiscal_year, fiscal_period, "Assets", "NetIncomeLoss", "Revenues", fed_funds, unemployment, inflation FROM inputs',
)
def cleaning_stage(spark, folder):
    view = features.statement_view(X.labeled_panel(spark, folder))
    filled = WN.fill_by_date(view, list(features.MACRO_INPUTS), "filed_date")
    return filled.select(*features.FIRM_QUARTER, "Assets", "NetIncomeLoss", "Revenues", *features.MACRO_INPUTS)


_STOCKS = ["Assets", "Liabilities", "NetIncomeLoss", "InventoryNet"]
_FLOWS = ["NetCashProvidedByUsedInOperatingActivities", "DepreciationDepletionAndAmortization"]


@query(
    "h0b_fill_by_kind",
    ctes("wide")
    + "SELECT firm_id, fiscal_year, fiscal_period, "
    + ", ".join(f'coalesce(last_value("{c}" IGNORE NULLS) OVER ({FISCAL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS "{c}"' for c in _STOCKS)
    + ", "
    + ", ".join(f'coalesce("{c}", 0.0) AS "{c}"' for c in _FLOWS)
    + " FROM wide",
)
def fill_by_kind(spark, folder):
    from quarterline.operators import filters as FL
    from quarterline.operators import quality

    wide = cleaning.widen_statements(X.latest_facts(spark, folder), cleaning.QUARTER_KEY, _STOCKS + _FLOWS)
    padded = wide.withColumns({"quality_check_flag": F.lit("Valid"), "EarningsPerShareBasic": F.lit(None).cast("double")})
    dropped = FL.drop_uninformative(padded, ["quality_check_flag", "EarningsPerShareBasic"])
    filled = features.fill_by_kind(dropped)
    return quality.require_finite(filled, absent=["quality_check_flag", "EarningsPerShareBasic"])


@query(
    "h1_build_panel",
    ctes("panel") + f"SELECT firm_id, date, {', '.join(panel.MEASURES)}, days_since_previous, \"CPI\" FROM panel",
)
def build_panel(spark, folder):
    return X.firm_panel(spark, folder).select("firm_id", "date", *panel.MEASURES, "days_since_previous", "CPI")


@query(
    "h1_filing_panel",
    ctes("clean_filings")
    + """SELECT firm_id, date, filed_date, total_assets, net_income, lag(total_assets) OVER (PARTITION BY firm_id ORDER BY date) AS total_assets_lag1 FROM (
 SELECT firm_id, end_date AS date, filed_date, "Assets" AS total_assets, "NetIncomeLoss" AS net_income, row_number() OVER (PARTITION BY firm_id, end_date ORDER BY filed_date DESC) AS rn
 FROM clean_filings WHERE end_date BETWEEN DATE '1993-01-01' AND DATE '2030-12-31') WHERE rn = 1""",
)
def filing_panel(spark, folder):
    """The panel of the table with a row per filing: the last filing of each quarter stays."""
    return panel.build_panel(X.filings(spark, folder)).select("firm_id", "date", "filed_date", "total_assets", "net_income", "total_assets_lag1")


@query(
    "h0_typed_facts",
    ctes("facts")
    + f"""SELECT firm_id, fiscal_year, fiscal_period, quarter_key, tag, value, filed_date, l_orderkey FROM (
 SELECT *, CAST(fiscal_year AS VARCHAR) || '_' || fiscal_period AS quarter_key, row_number() OVER (PARTITION BY firm_id, fiscal_year, fiscal_period, tag
  ORDER BY filed_date DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, value DESC) AS rn FROM (
  SELECT * REPLACE (CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE date_trunc('day', filed_date)::TIMESTAMP END AS filed_date) FROM facts
  WHERE l_orderkey % 53 <> 0 AND l_orderkey % 59 <> 0 AND l_orderkey % 61 <> 0)) WHERE rn = 1""",
)
def typed_facts(spark, folder):
    """Raw text facts typed, filtered and cut to the latest filing of each."""
    typed = cleaning.typed_facts(X.raw_facts(spark, folder), X.FACT_TIES, "cik").withColumnRenamed("cik", "firm_id")
    return typed.select(*cleaning.QUARTER_KEY, "quarter_key", "tag", "value", "filed_date", "l_orderkey")


def _features(names):
    return f"SELECT firm_id, fiscal_year, fiscal_period, {', '.join(r(n) + ' AS ' + n for n in names)} FROM features"


def _engineered(spark, folder, names):
    return X.engineered(spark, folder).select(*features.FIRM_QUARTER, *[F.round(n, 4).alias(n) for n in names])


@query("h2_ratios", ctes("features") + _features(features.RATIOS))
def ratios(spark, folder):
    view = features.add_ratios(features.statement_view(X.labeled_panel(spark, folder)))
    return view.select(*features.FIRM_QUARTER, *[F.round(n, 4).alias(n) for n in features.RATIOS])


@query("h5_h6_interactions", ctes("features") + _features(features.INTERACTIONS))
def interactions(spark, folder):
    return _engineered(spark, folder, features.INTERACTIONS)


@query("h7_macro_interactions", ctes("features") + _features(features.MACRO_INTERACTIONS))
def macro_interactions(spark, folder):
    return _engineered(spark, folder, features.MACRO_INTERACTIONS)


@query("h8_sector_proxy", ctes("features") + "SELECT sector_proxy, company_size_bucket, count(*) AS firm_quarters FROM features GROUP BY ALL")
def sector(spark, folder):
    return X.engineered(spark, folder).groupBy("sector_proxy", "company_size_bucket").agg(F.count(F.lit(1)).alias("firm_quarters"))


_CLIPPED = ["current_ratio", "debt_to_equity", "net_margin", "roa"]


@query(
    "h9_clip",
    ctes("features")
    + "SELECT firm_id, fiscal_year, fiscal_period, "
    + ", ".join(r(f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, m_{c} - 2 * s_{c}), m_{c} + 2 * s_{c}) END") + f" AS {c}" for c in _CLIPPED)
    + " FROM features, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _CLIPPED)
    + " FROM features)",
)
def clip(spark, folder):
    view = features.add_ratios(features.statement_view(X.labeled_panel(spark, folder)))
    clipped = features.clip_spread(view, _CLIPPED, 2.0)
    return clipped.select(*features.FIRM_QUARTER, *[F.round(c, 4).alias(c) for c in _CLIPPED])


_ALL = features.feature_names()


@query(
    "h10_engineer_features",
    ctes("features")
    + f"""SELECT firm_id, fiscal_year, fiscal_period, distress_label, company_size_bucket, sector_proxy, {r('fed_funds')} AS fed_funds,
 {', '.join(r(f'coalesce({n}, 0.0)') + ' AS ' + n for n in _ALL)} FROM features""",
)
def engineer(spark, folder):
    done = features.zero_missing_features(X.engineered(spark, folder))
    return done.select(
        *features.FIRM_QUARTER,
        "distress_label",
        "company_size_bucket",
        "sector_proxy",
        *[F.round(n, 4).alias(n) for n in ["fed_funds", *_ALL]],
    )


@query(
    "h11_label",
    ctes("labeled") + f"SELECT firm_id, date, {', '.join(panel.SIGNALS)}, signal_count, distress_label FROM labeled",
)
def label(spark, folder):
    return X.labeled_panel(spark, folder, keep_signals=True).select("firm_id", "date", *panel.SIGNALS, "signal_count", "distress_label")


@query(
    "h12_two_loss_label",
    ctes("signals")
    + "SELECT firm_id, date, CAST(coalesce(lead(CASE WHEN s1_neg_income THEN 1 ELSE 0 END) OVER (PARTITION BY firm_id ORDER BY date), 0) AS INTEGER) AS distress_label_old FROM signals",
)
def two_loss(spark, folder):
    return panel.two_loss_label(X.firm_panel(spark, folder)).select("firm_id", "date", "distress_label_old")


_STORED = "fiscal_year < 2000"
_FETCHED = "(fiscal_year >= 1996 AND firm_id <> '0000000003')"


@query(
    "h13_quarterly_last",
    ctes("macro")
    + """SELECT series_id, CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
 arg_max(value, (epoch_us(date), o_orderkey)) FILTER (value > 1.0) AS value FROM macro WHERE value > 1.0 GROUP BY ALL""",
)
def quarterly_last(spark, folder):
    from quarterline.operators import refresh

    series = X.macro(spark, folder).withColumn("value", F.when(F.col("value") > 1.0, F.col("value")))
    return refresh.quarterly_last(series, ["series_id"], "date", "value", [F.col("o_orderkey")])


@query(
    "h14_amendment_refresh",
    ctes("latest")
    + f""", stored AS (SELECT firm_id, fiscal_year, fiscal_period, tag, value FROM latest WHERE {_STORED}),
 fetched AS (SELECT firm_id, fiscal_year, fiscal_period, tag, value * 2 AS value FROM latest WHERE {_FETCHED}),
 newest AS (SELECT DISTINCT firm_id, fiscal_year, fiscal_period FROM (SELECT *, dense_rank() OVER (PARTITION BY firm_id ORDER BY fiscal_year DESC, fiscal_period DESC) AS d FROM stored) WHERE d <= 8),
 kept AS (SELECT * FROM stored WHERE firm_id NOT IN (SELECT firm_id FROM fetched) OR (firm_id, fiscal_year, fiscal_period) NOT IN (SELECT (firm_id, fiscal_year, fiscal_period) FROM newest)),
 incoming AS (SELECT * FROM fetched WHERE (firm_id, fiscal_year, fiscal_period) NOT IN (SELECT (firm_id, fiscal_year, fiscal_period) FROM kept))
 SELECT * FROM kept UNION ALL SELECT * FROM incoming""",
)
def amendment_refresh(spark, folder):
    from quarterline.operators import refresh

    rows = materialise(X.latest_facts(spark, folder).select(*cleaning.FACT_KEY, "value"))  # the stored table
    fetched = rows.where(_FETCHED).withColumn("value", F.col("value") * 2)
    return refresh.refresh(rows.where(_STORED), fetched, ["firm_id"], ["fiscal_year", "fiscal_period"], cleaning.FACT_KEY, ["value"])


@query(
    "h15_revision_refresh",
    ctes("macro")
    + """, quarterly AS (SELECT series_id, CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end, arg_max(value, (epoch_us(date), o_orderkey)) AS value FROM macro GROUP BY ALL),
 stored AS (SELECT * FROM quarterly WHERE quarter_end < DATE '2000-01-01'), fetched AS (SELECT series_id, quarter_end, value + 1 AS value FROM quarterly),
 newest AS (SELECT series_id, quarter_end FROM (SELECT *, dense_rank() OVER (PARTITION BY series_id ORDER BY quarter_end DESC) AS d FROM stored) WHERE d <= 8),
 kept AS (SELECT * FROM stored WHERE (series_id, quarter_end) NOT IN (SELECT (series_id, quarter_end) FROM newest))
 SELECT * FROM kept UNION ALL SELECT * FROM fetched WHERE (series_id, quarter_end) NOT IN (SELECT (series_id, quarter_end) FROM kept)""",
)
def revision_refresh(spark, folder):
    from quarterline.operators import refresh

    quarterly = refresh.quarterly_last(X.macro(spark, folder), ["series_id"], "date", "value", [F.col("o_orderkey")])
    stored = quarterly.where("quarter_end < date '2000-01-01'")
    fetched = quarterly.withColumn("value", F.col("value") + 1)
    return refresh.refresh(stored, fetched, ["series_id"], ["quarter_end"], ["series_id", "quarter_end"], ["value"])
