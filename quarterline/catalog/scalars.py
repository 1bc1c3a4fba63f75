"""Projection, typing and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import FISCAL, ctes, quarter_end_of, quarter_of, r
from quarterline.functions import quarters as Q
from quarterline.functions import scalars as S
from quarterline.plans import cleaning, features, panel


@query("p1_rename", "SELECT c_custkey AS firm_key, c_name AS company_name, c_mktsegment AS segment, c_nationkey, c_acctbal FROM customer")
def rename(spark, folder):
    names = {"c_custkey": "firm_key", "c_name": "company_name", "c_mktsegment": "segment"}
    return X.table(spark, folder, "customer").withColumnsRenamed(names)


@query("p2_lower_names", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def lower(spark, folder):
    supplier = X.table(spark, folder, "supplier")
    return S.lower_names(supplier.toDF(*[f" {c.upper()} " for c in supplier.columns]))


@query(
    "p3_alias_map",
    ctes("clean")
    + 'SELECT firm_id, quarter_key, "NetCashProvidedByUsedInOperatingActivities" AS operating_cash_flow, "StockholdersEquity" AS total_equity FROM clean',
)
def alias_map(spark, folder):
    df = X.cleaned(spark, folder)
    return df.select(
        "firm_id",
        "quarter_key",
        S.first_present(df, ["operating_cash_flow", "NetCashProvidedByUsedInOperatingActivities"]).alias("operating_cash_flow"),
        S.first_present(df, ["total_equity", "StockholdersEquity"]).alias("total_equity"),
    )


@query(
    "p4_zero_pad",
    "SELECT o_orderkey, CASE WHEN length(k) < 3 THEN lpad(k, 3, '0') ELSE k END AS key3, lpad(k, 10, '0') AS key10 FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS k FROM orders)",
)
def pad(spark, folder):
    key = F.col("o_custkey")
    return X.table(spark, folder, "orders").select("o_orderkey", S.zero_pad(key, 3).alias("key3"), S.zero_pad(key).alias("key10"))


@query(
    "p5_number_cast",
    "SELECT p_partkey, TRY_CAST(p_brand AS DOUBLE) AS whole, TRY_CAST(substr(p_brand, 7) AS DOUBLE) AS tail FROM part",
)
def number_cast(spark, folder):
    part = X.table(spark, folder, "part")
    return part.select("p_partkey", S.to_number(F.col("p_brand")).alias("whole"), S.to_number(F.substring("p_brand", 7, 10)).alias("tail"))


@query(
    "p6_date_parse",
    """SELECT TRY_CAST(strftime(l_shipdate, '%Y-%m-') || CAST(26 + l_linenumber AS VARCHAR) AS DATE) AS day, count(*) AS lines
 FROM lineitem GROUP BY 1""",
)
def date_parse(spark, folder):
    text = F.concat(F.date_format("l_shipdate", "yyyy-MM-"), (F.col("l_linenumber") + 26).cast("string"))
    return X.table(spark, folder, "lineitem").groupBy(S.to_day(text).alias("day")).agg(F.count(F.lit(1)).alias("lines"))


@query("p7_normal_code", "SELECT upper(trim('  ' || lower(p_type) || ' ')) AS code, count(*) AS parts FROM part GROUP BY 1")
def normal_code(spark, folder):
    raw = F.concat(F.lit("  "), F.lower("p_type"), F.lit(" "))
    return X.table(spark, folder, "part").groupBy(S.normal_code(raw).alias("code")).agg(F.count(F.lit(1)).alias("parts"))


@query(
    "p8_quarter_key",
    f"SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '_' || {quarter_of('o_orderdate')} AS quarter_key FROM orders",
)
def quarter_key(spark, folder):
    return X.table(spark, folder, "orders").select("o_orderkey", Q.quarter_key_of(F.col("o_orderdate")).alias("quarter_key"))


@query("p9_quarter_end", f"SELECT o_orderkey, {quarter_end_of('o_orderdate')} AS quarter_end FROM orders")
def quarter_end(spark, folder):
    return X.table(spark, folder, "orders").select("o_orderkey", Q.quarter_end_of(F.col("o_orderdate")).alias("quarter_end"))


@query(
    "p10_period_end",
    ctes("wide")
    + """SELECT firm_id, fiscal_year, fiscal_period, CAST(CAST(fiscal_year AS VARCHAR) || CASE fiscal_period WHEN 'Q1' THEN '-03-31' WHEN 'Q2' THEN '-06-30'
 WHEN 'Q3' THEN '-09-30' ELSE '-12-31' END AS DATE) AS end_date FROM wide""",
)
def period_end(spark, folder):
    rows = X.latest_facts(spark, folder).select("firm_id", "fiscal_year", "fiscal_period").distinct()
    return rows.withColumn("end_date", Q.quarter_end(F.col("fiscal_year"), F.col("fiscal_period")))


@query(
    "p11_run_period",
    f"SELECT event_id, CAST(year(ts) AS INTEGER) AS run_year, {quarter_of('ts')} AS run_quarter, strftime(ts, '%m') AS run_month FROM events",
)
def run_period(spark, folder):
    year, quarter = Q.run_quarter(F.col("ts"))
    _, month = Q.run_month(F.col("ts"))
    return X.table(spark, folder, "events").select(
        "event_id", year.alias("run_year"), quarter.alias("run_quarter"), month.alias("run_month")
    )


@query(
    "p12_period_order",
    f"""SELECT o_orderkey, CASE WHEN p = 'FY' THEN NULL ELSE CAST(substr(p, 2) AS INTEGER) END AS period_no,
 CAST(y * 10 + CASE WHEN p = 'FY' THEN 0 ELSE CAST(substr(p, 2) AS INTEGER) END AS INTEGER) AS sort_no, p || ' ' || CAST(y AS VARCHAR) AS label
 FROM (SELECT o_orderkey, year(o_orderdate) AS y, CASE WHEN o_orderstatus = 'P' THEN 'FY' ELSE {quarter_of('o_orderdate')} END AS p FROM orders)""",
)
def period_order(spark, folder):
    period = F.when(F.col("o_orderstatus") == "P", "FY").otherwise(Q.period_of(F.col("o_orderdate")))
    rows = X.table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), period.alias("p"))
    y, p = F.col("y"), F.col("p")
    return rows.select(
        "o_orderkey", Q.period_number(p).alias("period_no"), Q.sort_number(y, p).alias("sort_no"), Q.quarter_label(y, p).alias("label")
    )


@query(
    "p13_safe_divide",
    f"SELECT l_tax, l_discount, {r('l_tax / nullif(l_discount, 0)', 6)} AS ratio, count(*) AS lines FROM lineitem GROUP BY 1, 2",
)
def safe_divide(spark, folder):
    counted = X.table(spark, folder, "lineitem").groupBy("l_tax", "l_discount").agg(F.count(F.lit(1)).alias("lines"))
    return counted.withColumn("ratio", F.round(S.ratio(F.col("l_tax"), F.col("l_discount")), 6))


@query(
    "p14_identity_repair",
    ctes("wide")
    + """SELECT firm_id, fiscal_year, fiscal_period, coalesce("Assets", "Liabilities" + "StockholdersEquity") AS "Assets",
 coalesce("Liabilities", "Assets" - "StockholdersEquity") AS "Liabilities", coalesce("StockholdersEquity", "Assets" - "Liabilities") AS "StockholdersEquity" FROM wide""",
)
def identity_repair(spark, folder):
    wide = cleaning.widen_statements(X.latest_facts(spark, folder), cleaning.QUARTER_KEY, ["Assets", "Liabilities", "StockholdersEquity"])
    return cleaning.repair_identity(wide)


_FILLED = ["NetIncomeLoss", "Goodwill", "InterestExpense", "GrossProfit"]


@query(
    "p15_zero_fill",
    ctes("wide")
    + """SELECT firm_id, fiscal_year, fiscal_period, coalesce("NetIncomeLoss", 0.0) AS "NetIncomeLoss", 0.0::DOUBLE AS "Goodwill",
 coalesce("InterestExpense", 0.0) AS "InterestExpense", "GrossProfit" FROM wide""",
)
def zero_fill(spark, folder):
    wide = cleaning.widen_statements(X.latest_facts(spark, folder), cleaning.QUARTER_KEY, _FILLED)
    return cleaning.zero_fill(wide, _FILLED[:3])


@query(
    "p16_zero_fill_report",
    ctes("wide")
    + " UNION ALL ".join(
        f"""SELECT '{t}' AS column_name, CAST(count(*) FILTER ("{t}" IS NULL) AS BIGINT) AS filled FROM wide""" for t in X.FACT_TAGS
    ),
)
def zero_fill_report(spark, folder):
    wide = cleaning.widen_statements(X.latest_facts(spark, folder), cleaning.QUARTER_KEY, X.FACT_TAGS)
    filled = features.zero_missing_features(wide)
    counts = wide.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in filled.columns if c in X.FACT_TAGS])
    return counts.unpivot([], X.FACT_TAGS, "column_name", "filled")


@query(
    "p17_nan_to_null",
    "SELECT l_discount, l_tax, CASE WHEN l_discount <> 0 AND l_tax <> 0 THEN l_discount END AS cleaned, CASE WHEN l_discount <> 0 AND l_tax <> 0 THEN l_discount ELSE 0.0 END AS filled, count(*) AS lines FROM lineitem GROUP BY ALL",
)
def nan_to_null(spark, folder):
    counted = X.table(spark, folder, "lineitem").groupBy("l_discount", "l_tax").agg(F.count(F.lit(1)).alias("lines"))
    dirty = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).when(F.col("l_tax") == 0, F.lit(float("-inf"))).otherwise(F.col("l_discount"))
    return counted.withColumns({"cleaned": S.nan_to_null(dirty), "filled": S.nan_to_null(dirty, 0.0)})


@query(
    "p18_default_columns",
    ctes("labeled")
    + """SELECT firm_id, fiscal_year, fiscal_period, total_assets AS "Assets", "ProfitLoss" AS "Revenues", 0.0::DOUBLE AS "LongTermDebt", 0.0::DOUBLE AS "Goodwill" FROM labeled""",
)
def default_columns(spark, folder):
    view = features.statement_view(X.labeled_panel(spark, folder))
    return view.select("firm_id", "fiscal_year", "fiscal_period", "Assets", "Revenues", "LongTermDebt", "Goodwill")


@query("p19_all_except", "SELECT * EXCLUDE (o_orderstatus, o_totalprice) FROM orders")
def all_except(spark, folder):
    return X.table(spark, folder, "orders").drop("o_orderstatus", "o_totalprice")


@query("p20_epoch", "SELECT event_id, epoch_us(ts) * 1000 AS nanos FROM events")
def epoch(spark, folder):
    return X.table(spark, folder, "events").select("event_id", S.epoch_nanos(F.col("ts")).alias("nanos"))


@query(
    "p21_risk_level",
    ctes("scores") + "SELECT o_orderkey, CASE WHEN score >= 0.7 THEN 'High' WHEN score >= 0.3 THEN 'Medium' ELSE 'Low' END AS risk FROM scores",
)
def risk(spark, folder):
    return X.scores(spark, folder).select("o_orderkey", S.risk_level(F.col("score")).alias("risk"))


@query("p22_display_score", ctes("scores") + f"SELECT o_orderkey, {r('least(pow(score, 0.35), 1.0)', 6)} AS shown FROM scores")
def display(spark, folder):
    return X.scores(spark, folder).select("o_orderkey", F.round(S.display_score(F.col("score")), 6).alias("shown"))


@query(
    "p23_confidence_band",
    ctes("scores") + f"SELECT o_orderkey, {r('greatest(score - 0.05, 0.0)', 9)} AS low, {r('least(score + 0.05, 1.0)', 9)} AS high FROM scores",
)
def band(spark, folder):
    low, high = S.confidence_band(F.col("score"))
    return X.scores(spark, folder).select("o_orderkey", F.round(low, 9).alias("low"), F.round(high, 9).alias("high"))


_AMOUNT = "CASE o_orderstatus WHEN 'O' THEN o_totalprice * 10000.0 WHEN 'F' THEN -o_totalprice * 37.0 ELSE o_totalprice / 700.0 END"


@query(
    "p24_money_text",
    f"""SELECT o_orderkey, CASE WHEN amount < 0 THEN '-' ELSE '' END || CASE WHEN abs(amount) >= 1e9 THEN printf('$%.1fB', abs(amount) / 1e9)
 WHEN abs(amount) >= 1e6 THEN printf('$%.1fM', abs(amount) / 1e6) WHEN abs(amount) >= 1e3 THEN printf('$%.0fK', abs(amount) / 1e3)
 ELSE printf('$%.0f', abs(amount)) END AS shown FROM (SELECT o_orderkey, {_AMOUNT} AS amount FROM orders)""",
)
def money(spark, folder):
    price = F.col("o_totalprice")
    amount = F.when(F.col("o_orderstatus") == "O", price * 10000.0).when(F.col("o_orderstatus") == "F", -price * 37.0).otherwise(price / 700.0)
    return X.table(spark, folder, "orders").select("o_orderkey", S.money_text(amount).alias("shown"))


@query(
    "p25_signal_text",
    ctes("signals")
    + """SELECT firm_id, quarter_key, CASE WHEN signal_count = 0 THEN '—' ELSE concat_ws(' · ', CASE WHEN s1_neg_income THEN 'Neg. income' END,
 CASE WHEN s2_neg_ocf THEN 'Neg. cash flow' END, CASE WHEN s3_leverage THEN 'Leverage spike' END, CASE WHEN s4_low_coverage THEN 'Low coverage' END,
 CASE WHEN s5_declining_re THEN 'Falling earnings' END) END AS signals FROM signals""",
)
def signal_text(spark, folder):
    texts = ["Neg. income", "Neg. cash flow", "Leverage spike", "Low coverage", "Falling earnings"]
    flags = [(F.col(s), t) for s, t in zip(panel.SIGNALS, texts)]
    df = X.labeled_panel(spark, folder, keep_signals=True)
    return df.select("firm_id", "quarter_key", S.joined_text(flags).alias("signals"))


@query(
    "p26_display_name",
    ctes("companies", "looked_up")
    + """SELECT o_orderkey, CASE WHEN name IS NULL THEN 'CIK ' || s.firm_id WHEN ticker = '' THEN name ELSE name || ' (' || ticker || ')' END AS shown
 FROM looked_up s LEFT JOIN companies c ON s.firm_id = c.firm_id""",
)
def shown_name(spark, folder):
    joined = X.looked_up(spark, folder).join(X.companies(spark, folder), "firm_id", "left")
    return joined.select("o_orderkey", S.display_name(F.col("firm_id"), F.col("name"), F.col("ticker")).alias("shown"))


@query(
    "p27_trend_text",
    ctes("qscores")
    + f"""SELECT firm_id, fiscal_year, fiscal_period, CASE WHEN step > 0.01 THEN 'up' WHEN step < -0.01 THEN 'down' ELSE 'flat' END AS trend
 FROM (SELECT *, coalesce(score - lag(score) OVER ({FISCAL}), 0.0) AS step FROM qscores)""",
)
def trend(spark, folder):
    from quarterline.operators import lookups, windows

    rows = lookups.best_per_quarter(X.scores(spark, folder), "score", ["o_orderkey"])
    step = F.coalesce(windows.change(F.col("score"), features.fiscal_order()), F.lit(0.0))
    return rows.withColumn("step", step).select("firm_id", "fiscal_year", "fiscal_period", S.trend_text(F.col("step")).alias("trend"))


@query(
    "p28_version_stamp",
    ctes("scores") + "SELECT o_orderkey, score, 'v3' AS model_version, 'run-7' AS run_id, '2001-08-01T00:00:00' AS scored_at FROM scores",
)
def stamp(spark, folder):
    rows = X.scores(spark, folder).select("o_orderkey", "score")
    return S.stamped(rows, model_version="v3", run_id="run-7", scored_at="2001-08-01T00:00:00")


