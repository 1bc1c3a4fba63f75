"""Lookup queries: alerts, histories, watchlists, snapshots, status."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.nested import _SHAP, _TOP
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import FISCAL, ctes, r
from quarterline.functions import quarters as Q
from quarterline.operators import lookups as L
from quarterline.operators import nested as N
from quarterline.operators.dedup import top_rows

_NAME = "CASE WHEN name IS NULL THEN 'CIK ' || firm_id WHEN ticker = '' THEN name ELSE name || ' (' || ticker || ')' END"


@query(
    "v1_alerts",
    ctes("scores", "companies")
    + f"""SELECT firm_id, o_orderkey, score, {_NAME} AS company_name, CASE WHEN score >= 0.7 THEN 'High' WHEN score >= 0.3 THEN 'Medium' ELSE 'Low' END AS risk_level
 FROM (SELECT *, row_number() OVER (PARTITION BY firm_id ORDER BY score DESC, o_orderkey) AS rn FROM scores) LEFT JOIN companies USING (firm_id) WHERE rn = 1 AND score >= 0.7""",
)
def alerts(spark, folder):
    found = L.alerts(X.scores(spark, folder), X.companies(spark, folder), "score", ["o_orderkey"])
    return found.select("firm_id", "o_orderkey", "score", "company_name", "risk_level").orderBy(F.col("score").desc(), "firm_id")


@query(
    "v2_history",
    ctes("qscores")
    + """SELECT firm_id, fiscal_year, fiscal_period, score, CAST(fiscal_year * 10 + CAST(substr(fiscal_period, 2) AS INTEGER) AS INTEGER) AS sort_number,
 fiscal_period || ' ' || CAST(fiscal_year AS VARCHAR) AS quarter_label FROM qscores""",
)
def history(spark, folder):
    rows = L.history(X.scores(spark, folder), "score", ["o_orderkey"])
    return rows.select(*L.QUARTER, "score", "sort_number", "quarter_label").orderBy("firm_id", "sort_number")


@query(
    "v3_top_features",
    ctes("attr", extra=_TOP)
    + f"""SELECT firm_id, CAST(fiscal_year AS VARCHAR) || '-' || fiscal_period AS quarter, CAST(rk AS INTEGER) AS rank, feature, {r('v', 6)} AS shap_value
 FROM attr_long WHERE rk <= 3 AND fiscal_period <> 'Q4'""",
)
def top_features(spark, folder):
    """Requests for every firm-quarter, those of the fourth quarters malformed."""
    wide = X.attributions(spark, folder)
    table = wide.select(*L.QUARTER, N.contributions_json(wide, _SHAP, 5).alias("top_features_json"))
    text = F.when(F.col("fiscal_period") == "Q4", "soon").otherwise(F.concat_ws("-", "fiscal_year", "fiscal_period"))
    requests = wide.select("firm_id", text.alias("quarter"))
    return L.top_features(table, requests).select("firm_id", "quarter", F.inline("features"))


def supplier_scores(spark, folder):
    """Scores per firm-quarter of the panel's firms: the share of discounted value, by line items."""
    facts = X.facts(spark, folder)
    rows = facts.groupBy(*L.QUARTER).agg(F.count_if(F.col("value") < 0).alias("_neg"), F.count(F.lit(1)).alias("_n"))
    return rows.select(*L.QUARTER, F.least(F.col("_neg") * 4.0 / F.col("_n"), F.lit(1.0)).alias("score"))


_SUPPLIER = "sscores AS (SELECT firm_id, fiscal_year, fiscal_period, least(count(*) FILTER (value < 0) * 4.0 / count(*), 1.0) AS score FROM facts GROUP BY ALL)"
_WATCH = f"""{_SUPPLIER}, watch AS (SELECT firm_id, distress_label, score AS risk_score, coalesce(score - prev, 0.0) AS change, coalesce(nullif(concat_ws(' · ',
 CASE WHEN net_income < 0 THEN 'Neg. income' END, CASE WHEN operating_cash_flow < 0 THEN 'Neg. cash flow' END, CASE WHEN retained_earnings < 0 THEN 'Retained earnings deficit' END,
 CASE WHEN total_assets > 0 AND total_liabilities / total_assets > 0.8 THEN 'High leverage' END), ''), '—') AS signals, fiscal_period || ' ' || CAST(fiscal_year AS VARCHAR) AS quarter
 FROM (SELECT *, lag(score) OVER ({FISCAL}) AS prev, row_number() OVER (PARTITION BY firm_id ORDER BY fiscal_year DESC, fiscal_period DESC) AS rn FROM sscores)
 JOIN (SELECT firm_id, distress_label, net_income, operating_cash_flow, retained_earnings, total_assets, total_liabilities FROM labeled QUALIFY row_number() OVER (PARTITION BY firm_id ORDER BY date DESC) = 1) USING (firm_id) WHERE rn = 1)"""


def _watch(spark, folder):
    return L.watchlist(supplier_scores(spark, folder), X.labeled_panel(spark, folder), "score")


@query(
    "v4_watchlist",
    ctes("labeled", extra=_WATCH)
    + f"SELECT firm_id, distress_label, {r('risk_score', 6)} AS risk_score, {r('change', 6)} AS change, signals, quarter FROM watch WHERE distress_label = 1 OR risk_score >= 0.1",
)
def watchlist(spark, folder):
    rows = L.watchlist_filter(_watch(spark, folder))
    return rows.withColumns({"risk_score": F.round("risk_score", 6), "change": F.round("change", 6)})


@query(
    "g14_watchlist_counts",
    ctes("labeled", extra=_WATCH)
    + "SELECT count(*) FILTER (risk_score >= 0.5) AS above_half, count(*) FILTER (distress_label = 1 OR risk_score >= 0.1) AS shown, count(*) AS total FROM watch",
)
def watchlist_counts(spark, folder):
    return L.watchlist_summary(_watch(spark, folder))


@query(
    "v5_snapshot",
    ctes("panel", extra=f"{_SUPPLIER}, best AS (SELECT * FROM sscores QUALIFY row_number() OVER (PARTITION BY firm_id ORDER BY score DESC, fiscal_year, fiscal_period) = 1)")
    + """SELECT p.firm_id, p.fiscal_year, p.fiscal_period, p.total_assets, p.net_income, coalesce(p.fiscal_year = b.fiscal_year AND p.fiscal_period = b.fiscal_period, false) AS matches_score
 FROM panel p LEFT JOIN best b USING (firm_id)
 QUALIFY row_number() OVER (PARTITION BY p.firm_id ORDER BY coalesce(p.fiscal_year = b.fiscal_year AND p.fiscal_period = b.fiscal_period, false) DESC, p.fiscal_year DESC, p.fiscal_period DESC) = 1""",
)
def snapshot(spark, folder):
    best = top_rows(supplier_scores(spark, folder), ["firm_id"], [F.col("score").desc(), F.col("fiscal_year"), F.col("fiscal_period")])
    return L.snapshot(X.firm_panel(spark, folder), best).select(*L.QUARTER, "total_assets", "net_income", "matches_score")


@query(
    "v6_firm_attributions",
    ctes("attr", extra=_TOP)
    + f"""SELECT firm_id, feature, {r('v', 6)} AS shap_value, CAST(rk AS INTEGER) AS rank FROM (
 SELECT *, rank() OVER (PARTITION BY firm_id ORDER BY fiscal_year DESC, fiscal_period DESC) AS newest FROM attr_long) WHERE newest = 1 AND rk <= 4""",
)
def firm_attributions(spark, folder):
    """The four largest contributions on each firm's newest row."""
    newest = L.latest_per_firm(X.attributions(spark, folder))
    return newest.select("firm_id", F.inline(N.top_contributions(newest, _SHAP, 4)))


@query(
    "v7_status",
    """SELECT event_type, event_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def status(spark, folder):
    """The newest report row of each kind."""
    events = X.table(spark, folder, "events")
    newest = top_rows(events, ["event_type"], [F.col("ts").desc(), F.col("event_id").desc()])
    return newest.select("event_type", "event_id", "ts", "value")


@query(
    "v8_trend",
    ctes("labeled", extra=_SUPPLIER)
    + f"""SELECT firm_id, 'score' AS basis, fiscal_period || ' ' || CAST(fiscal_year AS VARCHAR) AS quarter, {r('score', 6)} AS value FROM sscores WHERE firm_id IN (SELECT firm_id FROM sscores GROUP BY firm_id HAVING max(score) >= 0.9)
 UNION ALL SELECT firm_id, 'label', fiscal_period || ' ' || CAST(fiscal_year AS VARCHAR), CAST(distress_label AS DOUBLE) FROM labeled
 WHERE firm_id NOT IN (SELECT firm_id FROM sscores GROUP BY firm_id HAVING max(score) >= 0.9) QUALIFY row_number() OVER (PARTITION BY firm_id ORDER BY date DESC) <= 8""",
)
def trend(spark, folder):
    """Score trend of scored firms; the last eight labels of the others."""
    rows = supplier_scores(spark, folder)
    scored = rows.groupBy("firm_id").agg(F.max("score").alias("_top")).where(F.col("_top") >= 0.9).select("firm_id")
    label = Q.quarter_label(F.col("fiscal_year"), F.col("fiscal_period")).alias("quarter")
    first = rows.join(scored, "firm_id", "left_semi").select("firm_id", F.lit("score").alias("basis"), label, F.round("score", 6).alias("value"))
    unscored = L.latest_per_firm(X.labeled_panel(spark, folder).join(scored, "firm_id", "left_anti"), 8)
    return first.unionByName(unscored.select("firm_id", F.lit("label").alias("basis"), label, F.col("distress_label").cast("double").alias("value")))
