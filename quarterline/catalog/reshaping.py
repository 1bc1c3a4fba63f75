"""Pivots, melts, contingency tables and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes
from quarterline.functions import quarters as Q
from quarterline.operators import reshape as R
from quarterline.plans import cleaning
from quarterline.plans.panel import MEASURES

_PIVOT = ", ".join(f"max(CASE WHEN tag = '{t}' THEN value END) AS \"{t}\"" for t in cleaning.STATEMENT_TAGS)


@query(
    "r1_pivot_tags",
    ctes("facts")
    + f"SELECT firm_id, fiscal_year, fiscal_period, CAST(fiscal_year AS VARCHAR) || '_' || fiscal_period AS quarter_key, filed_date, {_PIVOT} FROM facts GROUP BY ALL",
)
def pivot_tags(spark, folder):
    keyed = X.facts(spark, folder).withColumn("quarter_key", Q.quarter_key(F.col("fiscal_year"), F.col("fiscal_period")))
    return cleaning.widen_statements(keyed, ["firm_id", "fiscal_year", "fiscal_period", "quarter_key", "filed_date"])


@query("r2_pivot_series", ctes("macro_wide") + "SELECT * FROM macro_wide")
def pivot_series(spark, folder):
    return cleaning.widen_macro(X.macro(spark, folder))


@query(
    "r3_melt",
    ctes("panel") + " UNION ALL ".join(f"SELECT firm_id, quarter_key, '{m}' AS feature, {m} AS value FROM panel" for m in MEASURES),
)
def melt(spark, folder):
    return R.lengthen(X.firm_panel(spark, folder), ["firm_id", "quarter_key"], MEASURES)


@query(
    "r5_contingency",
    ctes("scores") + "SELECT segment, count(*) FILTER (label = 0) AS n_0, count(*) FILTER (label = 1) AS n_1 FROM scores GROUP BY segment",
)
def contingency(spark, folder):
    return R.contingency(X.scores(spark, folder), "segment", "label", [0, 1])


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


@query(
    "r6_indicators",
    ctes("scores")
    + "SELECT o_orderkey, "
    + ", ".join(f"CASE WHEN p = '{p}' THEN 1 ELSE 0 END AS \"priority_{p}\"" for p in _PRIORITIES)
    + ", CASE WHEN p IS NULL THEN 1 ELSE 0 END AS priority_nan FROM (SELECT o_orderkey, CASE WHEN priority <> '5-LOW' THEN priority END AS p FROM scores)",
)
def indicators(spark, folder):
    rows = X.scores(spark, folder).select("o_orderkey", F.when(F.col("priority") != "5-LOW", F.col("priority")).alias("priority"))
    return R.indicators(rows, "priority", _PRIORITIES).drop("priority")


@query(
    "j11_align_columns",
    ctes("panel") + "SELECT firm_id, quarter_key, total_assets, coalesce(net_income_lag4, 0.0) AS net_income_lag4, 0.0::DOUBLE AS unseen_feature FROM panel",
)
def align(spark, folder):
    return R.aligned(X.firm_panel(spark, folder), ["firm_id", "quarter_key"], ["total_assets", "net_income_lag4", "unseen_feature"])
