"""SQL building blocks: the fixture views as common table expressions, written independently of the Spark code."""

from __future__ import annotations

from quarterline.fixtures import FACT_TAGS, SERIES_OF, SIGNED_TAGS, SPENDING_TAGS, TAG_OF
from quarterline.plans.features import GROWTH, ROLLED
from quarterline.plans.panel import MEASURES, PANEL_NAMES


def r(expression: str, places: int = 4) -> str:
    """Rounded, with negative zero turned into zero."""
    return f"(round({expression}, {places}) + 0.0)"


def quoted(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif(({b}), 0))"


_TAG_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TAG_OF.items())
_SERIES_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SERIES_OF.items())
_PIVOT = ", ".join(f'max(CASE WHEN tag = \'{t}\' THEN value END) AS "{t}"' for t in FACT_TAGS)

PERIOD_NO = "CASE fiscal_period WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'Q4' THEN 4 END"
FISCAL = f"PARTITION BY firm_id ORDER BY fiscal_year, {PERIOD_NO}"
QUARTER_END = (
    "CAST(make_date(fiscal_year, (CAST(substr(fiscal_period, 2, 1) AS INTEGER) * 3), 1) "
    "+ INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE)"
)


def quarter_of(column: str) -> str:
    return f"'Q' || CAST(quarter({column}) AS VARCHAR)"


def quarter_end_of(column: str) -> str:
    return f"CAST(date_trunc('quarter', {column}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"


_FACTS = f"""
SELECT lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS firm_id, CAST(year(l_shipdate) AS INTEGER) AS fiscal_year,
  {quarter_of('l_shipdate')} AS fiscal_period, tag, l_shipdate AS filed_date, l_orderkey, l_linenumber, l_partkey,
  CASE WHEN tag IN ({quoted(SIGNED_TAGS)}) THEN CAST(price * (discount - 0.05) AS DOUBLE)
       WHEN tag IN ({quoted(SPENDING_TAGS)}) THEN CAST(price * discount AS DOUBLE)
       WHEN tag = 'InterestExpense' THEN CAST(price * tax AS DOUBLE)
       ELSE CAST(price AS DOUBLE) END AS value
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_discount AS DECIMAL(4,2)) AS discount,
        CAST(l_tax AS DECIMAL(4,2)) AS tax,
        CASE l_returnflag || l_linestatus || CAST(l_linenumber % 3 AS VARCHAR) {_TAG_CASE} END AS tag FROM lineitem)
"""
_LATEST = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY firm_id, fiscal_year, fiscal_period, tag
  ORDER BY filed_date DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, value DESC) AS rn FROM facts)
WHERE rn = 1
"""
_MACRO = f"""
SELECT CASE o_orderpriority {_SERIES_CASE} END AS series_id, o_orderdate AS date, o_totalprice / 100000.0 AS value, o_orderkey
FROM orders
"""
_MACRO_WIDE = f"""
SELECT CAST(year(date) AS VARCHAR) || '_' || {quarter_of('date')} AS quarter_key,
  CAST(NULL AS DOUBLE) AS "BBB_spread",
  max(CASE WHEN series_id = 'CPIAUCSL' THEN value END) AS "CPI",
  max(CASE WHEN series_id = 'DFF' THEN value END) AS "FedFundsRate",
  max(CASE WHEN series_id = 'GDP' THEN value END) AS "GDP",
  max(CASE WHEN series_id = 'UNRATE' THEN value END) AS "UnemploymentRate",
  max(CASE WHEN series_id = 'VIXCLS' THEN value END) AS "VIX"
FROM macro GROUP BY ALL
"""
_WIDE = f"SELECT firm_id, fiscal_year, fiscal_period, max(filed_date) AS filed_date, {_PIVOT} FROM latest GROUP BY ALL"
_MACROS = ["BBB_spread", "CPI", "FedFundsRate", "GDP", "UnemploymentRate", "VIX"]
_BY_FILING = "PARTITION BY firm_id ORDER BY filed_date NULLS FIRST, fiscal_year, fiscal_period"
_FILLS = ", ".join(
    f'coalesce("{m}", last_value("{m}" IGNORE NULLS) OVER ({_BY_FILING} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '
    f'first_value("{m}" IGNORE NULLS) OVER ({_BY_FILING} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS "{m}"'
    for m in _MACROS
)
_OTHERS = [t for t in FACT_TAGS if t not in ("Assets", "Liabilities", "StockholdersEquity")]
_CLEAN_OF = f"""
SELECT firm_id, fiscal_year, fiscal_period, quarter_key, {QUARTER_END} AS end_date, filed_date,
  coalesce("Assets", "Liabilities" + "StockholdersEquity", 0.0) AS "Assets",
  coalesce("Liabilities", "Assets" - "StockholdersEquity", 0.0) AS "Liabilities",
  coalesce("StockholdersEquity", "Assets" - "Liabilities", 0.0) AS "StockholdersEquity",
  {", ".join(f'coalesce("{t}", 0.0) AS "{t}"' for t in _OTHERS)}, {_FILLS}
FROM (SELECT *, CAST(fiscal_year AS VARCHAR) || '_' || fiscal_period AS quarter_key FROM WIDE_TABLE)
LEFT JOIN macro_wide USING (quarter_key)
"""
_CLEAN = _CLEAN_OF.replace("WIDE_TABLE", "wide")
# A row per filing: the filing date is part of the key.
_WIDE_FILINGS = f"SELECT firm_id, fiscal_year, fiscal_period, filed_date, {_PIVOT} FROM latest GROUP BY ALL"
_CLEAN_FILINGS = _CLEAN_OF.replace("WIDE_TABLE", "wide_filings")
_NAMES = {k: v for k, v in PANEL_NAMES.items() if v in MEASURES}
_BY_DATE = "PARTITION BY firm_id ORDER BY date"
_LAGS = ", ".join(
    f"lag({m}, {k}) OVER ({_BY_DATE}) AS {m}_lag{k}" for m in _NAMES.values() for k in (1, 4)
)
_PANEL = f"""
SELECT *, CAST(date_diff('day', lag(date) OVER ({_BY_DATE}), date) AS INTEGER) AS days_since_previous, {_LAGS}
FROM (SELECT firm_id, fiscal_year, fiscal_period, quarter_key, end_date AS date, filed_date,
        {", ".join(f'"{k}" AS {v}' for k, v in _NAMES.items())},
        {", ".join(f'"{t}"' for t in FACT_TAGS if t not in _NAMES)}, {", ".join(f'"{m}"' for m in _MACROS)}
      FROM clean WHERE end_date BETWEEN DATE '1993-01-01' AND DATE '2030-12-31')
"""
_TWO = f"OVER ({_BY_DATE} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)"
_THREE = f"OVER ({_BY_DATE} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
_SIGNALS = f"""
SELECT *, CAST(s1_neg_income AS INTEGER) + CAST(s2_neg_ocf AS INTEGER) + CAST(s3_leverage AS INTEGER)
  + CAST(s4_low_coverage AS INTEGER) + CAST(s5_declining_re AS INTEGER) AS signal_count
FROM (SELECT * EXCLUDE (leverage, old_leverage, coverage, re_step),
  sum(CASE WHEN net_income < 0 THEN 1 ELSE 0 END) {_TWO} = 2 AS s1_neg_income,
  sum(CASE WHEN operating_cash_flow < 0 THEN 1 ELSE 0 END) {_TWO} = 2 AS s2_neg_ocf,
  coalesce((leverage - old_leverage) / nullif(abs(old_leverage), 0) >= 0.20, false) AS s3_leverage,
  sum(CASE WHEN coverage < 1.5 THEN 1 ELSE 0 END) {_TWO} = 2 AS s4_low_coverage,
  coalesce(count(re_step) {_THREE} = 3 AND max(re_step) {_THREE} < 0, false) AS s5_declining_re
 FROM (SELECT *, lag(leverage, 4) OVER ({_BY_DATE}) AS old_leverage FROM (
   SELECT *, total_liabilities / nullif(total_equity, 0) AS leverage, operating_income / nullif(interest_expense, 0) AS coverage,
     retained_earnings - lag(retained_earnings) OVER ({_BY_DATE}) AS re_step FROM panel)))
"""
_LABELED = f"SELECT *, CAST(coalesce(lead(CASE WHEN signal_count >= 2 THEN 1 ELSE 0 END, 1) OVER ({_BY_DATE}), 0) AS INTEGER) AS distress_label FROM signals"
_CARRIED = [
    "AssetsCurrent", "CashAndCashEquivalentsAtCarryingValue", "LiabilitiesCurrent", "DepreciationDepletionAndAmortization",
    "InventoryNet", "CostOfGoodsAndServicesSold", "GrossProfit", "ResearchAndDevelopmentExpense",
    "SellingGeneralAndAdministrativeExpense",
]


def _global_fill(column: str, new: str) -> str:
    return (
        f'coalesce(max("{column}"), last_value(max("{column}") IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '
        f'first_value(max("{column}") IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS day_{new}'
    )


_DAY_FILL = f"""
SELECT day, {_global_fill('FedFundsRate', 'fed_funds')}, {_global_fill('UnemploymentRate', 'unemployment')}, {_global_fill('CPI', 'inflation')}
FROM (SELECT *, CAST(filed_date AS DATE) AS day FROM labeled) GROUP BY day
"""
_INPUTS = f"""
SELECT firm_id, fiscal_year, fiscal_period, filed_date, distress_label, total_assets AS "Assets", total_liabilities AS "Liabilities",
  total_equity AS "StockholdersEquity", retained_earnings AS "RetainedEarningsAccumulatedDeficit", net_income AS "NetIncomeLoss",
  operating_income AS "OperatingIncomeLoss", operating_cash_flow AS "NetCashProvidedByUsedInOperatingActivities",
  interest_expense AS "InterestExpense", "ProfitLoss" AS "Revenues", {", ".join(f'"{c}"' for c in _CARRIED)},
  coalesce("FedFundsRate", day_fed_funds) AS fed_funds, coalesce("UnemploymentRate", day_unemployment) AS unemployment,
  coalesce("CPI", day_inflation) AS inflation
FROM labeled JOIN day_fill ON CAST(filed_date AS DATE) = day
"""
_RATIOS = f"""
SELECT *, {div('"AssetsCurrent"', '"LiabilitiesCurrent"')} AS current_ratio,
  {div('"AssetsCurrent" - "InventoryNet"', '"LiabilitiesCurrent"')} AS quick_ratio,
  {div('"CashAndCashEquivalentsAtCarryingValue"', '"LiabilitiesCurrent"')} AS cash_ratio,
  {div('"Liabilities"', '"StockholdersEquity"')} AS debt_to_equity, {div('"Liabilities"', '"Assets"')} AS debt_to_assets,
  {div('"OperatingIncomeLoss"', '"InterestExpense"')} AS interest_coverage, {div('"GrossProfit"', '"Revenues"')} AS gross_margin,
  {div('"OperatingIncomeLoss"', '"Revenues"')} AS operating_margin, {div('"NetIncomeLoss"', '"Revenues"')} AS net_margin,
  {div('"NetIncomeLoss"', '"Assets"')} AS roa, {div('"NetIncomeLoss"', '"StockholdersEquity"')} AS roe,
  {div('"Revenues"', '"Assets"')} AS asset_turnover,
  {div('"NetCashProvidedByUsedInOperatingActivities"', '"Liabilities"')} AS cash_flow_to_debt
FROM inputs
"""
_GROWTHS = ", ".join(
    f'(("{c}" - lag("{c}", 4) OVER ({FISCAL})) / nullif(abs(lag("{c}", 4) OVER ({FISCAL})), 0)) AS {n}' for n, c in GROWTH.items()
)
_GROWTH = f"SELECT *, {_GROWTHS} FROM ratios"
_ROLLS = ", ".join(
    f"{fn}({c}) OVER ({FISCAL} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {c}_rolling_{n}q_{kind}"
    for c in ROLLED
    for n in (4, 8)
    for fn, kind in (("avg", "mean"), ("stddev_samp", "std"))
)
_ROLLING = f"SELECT *, {_ROLLS} FROM growth"
_FEATURES = f"""
SELECT *,
  1.2 * {div('"AssetsCurrent" - "LiabilitiesCurrent"', '"Assets"')} + 1.4 * {div('"RetainedEarningsAccumulatedDeficit"', '"Assets"')}
   + 3.3 * {div('"OperatingIncomeLoss"', '"Assets"')} + 0.6 * {div('"StockholdersEquity"', '"Liabilities"')}
   + 1.0 * {div('"Revenues"', '"Assets"')} AS altman_z_approx,
  ("CashAndCashEquivalentsAtCarryingValue" - lag("CashAndCashEquivalentsAtCarryingValue") OVER ({FISCAL}))
   / nullif("CostOfGoodsAndServicesSold" + "SellingGeneralAndAdministrativeExpense" + "ResearchAndDevelopmentExpense", 0) AS cash_burn_rate,
  debt_to_equity * operating_margin AS leverage_x_margin,
  {div('"ResearchAndDevelopmentExpense"', '"Revenues"')} AS rd_intensity,
  {div('"SellingGeneralAndAdministrativeExpense"', '"Revenues"')} AS sga_intensity,
  fed_funds * debt_to_equity AS fed_rate_x_leverage, unemployment * net_margin AS unemployment_x_margin,
  inflation * cash_ratio AS inflation_x_cash_ratio,
  CASE WHEN {div('"ResearchAndDevelopmentExpense"', '"Revenues"')} > 0.15 THEN 'tech_pharma'
       WHEN {div('"InventoryNet"', '"Assets"')} > 0.20 THEN 'manufacturing_retail'
       WHEN {div('"InterestExpense"', '"Revenues"')} > 0.05 THEN 'financial_capital_intensive' ELSE 'services_other' END AS sector_proxy,
  CASE ntile(4) OVER (ORDER BY "Assets", firm_id, fiscal_year, fiscal_period)
    WHEN 1 THEN 'small' WHEN 2 THEN 'mid' WHEN 3 THEN 'large' WHEN 4 THEN 'mega' END AS company_size_bucket
FROM rolling
"""
_CUT = """
SELECT * EXCLUDE (company_size_bucket), CASE WHEN "Assets" <= q1 THEN 'small' WHEN "Assets" <= q2 THEN 'mid'
  WHEN "Assets" <= q3 THEN 'large' ELSE 'mega' END AS company_size_bucket
FROM features, (SELECT quantile_cont("Assets", 0.25) AS q1, quantile_cont("Assets", 0.5) AS q2, quantile_cont("Assets", 0.75) AS q3 FROM features)
"""
_SCORES = f"""
SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS firm_id, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year,
  {quarter_of('o_orderdate')} AS fiscal_period, o_orderdate AS scored_date, c_mktsegment AS segment, c_nationkey AS nation,
  o_orderpriority AS priority, least(o_totalprice / 500000.0, 1.0) AS score,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label
FROM orders JOIN customer ON o_custkey = c_custkey
"""
_QSCORES = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY firm_id, fiscal_year, fiscal_period ORDER BY score DESC, o_orderkey) AS rn FROM scores)
WHERE rn = 1
"""
_COMPANIES = """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS firm_id, CASE WHEN n_nationkey <> 3 THEN n_name ELSE '' END AS ticker, c_name AS name
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
_LOOKED_UP = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '9' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') ELSE firm_id END AS firm_id, score FROM scores
"""
_SPARSE = f"""
SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS firm_id, {quarter_end_of('o_orderdate')} AS date,
  CAST(sum(CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS total
FROM orders GROUP BY ALL
"""
_ATTR = """
SELECT firm_id, fiscal_year, fiscal_period, net_income / -10007.0 AS shap_net_income, operating_cash_flow / -8009.0 AS shap_operating_cash_flow,
  interest_expense / 9001.0 AS shap_interest_expense, (40000.0 - total_assets) / 70001.0 AS shap_total_assets,
  (total_liabilities - 30000.0) / 60013.0 AS shap_total_liabilities, (20000.0 - total_equity) / 50021.0 AS shap_total_equity
FROM panel
"""

# name -> (needed views, SQL); listed in dependency order
_VIEWS: dict[str, tuple[list[str], str]] = {
    "facts": ([], _FACTS),
    "latest": (["facts"], _LATEST),
    "macro": ([], _MACRO),
    "macro_wide": (["macro"], _MACRO_WIDE),
    "wide": (["latest"], _WIDE),
    "clean": (["wide", "macro_wide"], _CLEAN),
    "wide_filings": (["latest"], _WIDE_FILINGS),
    "clean_filings": (["wide_filings", "macro_wide"], _CLEAN_FILINGS),
    "panel": (["clean"], _PANEL),
    "signals": (["panel"], _SIGNALS),
    "labeled": (["signals"], _LABELED),
    "day_fill": (["labeled"], _DAY_FILL),
    "inputs": (["labeled", "day_fill"], _INPUTS),
    "ratios": (["inputs"], _RATIOS),
    "growth": (["ratios"], _GROWTH),
    "rolling": (["growth"], _ROLLING),
    "features": (["rolling"], _FEATURES),
    "cut_features": (["features"], _CUT),
    "scores": ([], _SCORES),
    "qscores": (["scores"], _QSCORES),
    "looked_up": (["scores"], _LOOKED_UP),
    "companies": ([], _COMPANIES),
    "sparse": ([], _SPARSE),
    "attr": (["panel"], _ATTR),
}


def ctes(*names: str, extra: str = "") -> str:
    """`WITH ...` for the named views and everything they need; `extra` adds own views."""
    needed: set[str] = set()

    def visit(name: str) -> None:
        if name not in needed:
            needed.add(name)
            for before in _VIEWS[name][0]:
                visit(before)

    for name in names:
        visit(name)
    parts = [f"{n} AS MATERIALIZED ({sql})" for n, (_, sql) in _VIEWS.items() if n in needed]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
