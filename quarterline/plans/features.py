"""Feature engineering on the labeled panel: ratios, growth, rolling, interactions, buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions import quarters as Q
from quarterline.functions.scalars import first_present, ratio
from quarterline.operators import windows as WN
from quarterline.operators import folds
from quarterline.operators.ranks import group_quantiles, tile_cuts, tile_of

# Statement columns of the feature table; each may arrive under its panel name instead.
STATEMENT_COLUMNS = [
    "Assets",
    "AssetsCurrent",
    "CashAndCashEquivalentsAtCarryingValue",
    "Liabilities",
    "LiabilitiesCurrent",
    "StockholdersEquity",
    "RetainedEarningsAccumulatedDeficit",
    "NetIncomeLoss",
    "OperatingIncomeLoss",
    "NetCashProvidedByUsedInOperatingActivities",
    "NetCashProvidedByUsedInInvestingActivities",
    "NetCashProvidedByUsedInFinancingActivities",
    "DepreciationDepletionAndAmortization",
    "InterestExpense",
    "IncomeTaxExpenseBenefit",
    "AccountsReceivableNetCurrent",
    "AccountsPayableCurrent",
    "PropertyPlantAndEquipmentNet",
    "Goodwill",
    "CommonStockValue",
    "InventoryNet",
    "LongTermDebt",
    "LongTermDebtCurrent",
    "AdditionalPaidInCapital",
    "IntangibleAssetsNetExcludingGoodwill",
    "Revenues",
    "CostOfGoodsAndServicesSold",
    "GrossProfit",
    "ResearchAndDevelopmentExpense",
    "SellingGeneralAndAdministrativeExpense",
]
# Other names a statement column may have.
ALIASES = {
    "Assets": ["total_assets"],
    "Liabilities": ["total_liabilities"],
    "StockholdersEquity": ["total_equity"],
    "RetainedEarningsAccumulatedDeficit": ["retained_earnings"],
    "NetIncomeLoss": ["net_income"],
    "OperatingIncomeLoss": ["operating_income"],
    "NetCashProvidedByUsedInOperatingActivities": ["operating_cash_flow"],
    "InterestExpense": ["interest_expense"],
    "Revenues": ["ProfitLoss"],
}
# Items carried forward inside a firm, and cash flows that a gap sets to zero.
STOCK_ITEMS = [
    "Assets",
    "AssetsCurrent",
    "CashAndCashEquivalentsAtCarryingValue",
    "InventoryNet",
    "AccountsReceivableNetCurrent",
    "PropertyPlantAndEquipmentNet",
    "Goodwill",
    "IntangibleAssetsNetExcludingGoodwill",
    "Liabilities",
    "LiabilitiesCurrent",
    "AccountsPayableCurrent",
    "LongTermDebt",
    "LongTermDebtCurrent",
    "StockholdersEquity",
    "RetainedEarningsAccumulatedDeficit",
    "AdditionalPaidInCapital",
    "CommonStockValue",
    "Revenues",
    "CostOfGoodsAndServicesSold",
    "GrossProfit",
    "OperatingIncomeLoss",
    "NetIncomeLoss",
    "ResearchAndDevelopmentExpense",
    "SellingGeneralAndAdministrativeExpense",
    "InterestExpense",
    "IncomeTaxExpenseBenefit",
]
FLOW_ITEMS = [
    "NetCashProvidedByUsedInOperatingActivities",
    "NetCashProvidedByUsedInInvestingActivities",
    "NetCashProvidedByUsedInFinancingActivities",
    "DepreciationDepletionAndAmortization",
]
# The macro inputs, the names of the feature columns and what they are made from, the watched features, the size groups.
MACRO_INPUTS = {"fed_funds": "FedFundsRate", "unemployment": "UnemploymentRate", "inflation": "CPI"}
RATIOS = [
    "current_ratio",
    "quick_ratio",
    "cash_ratio",
    "debt_to_equity",
    "debt_to_assets",
    "interest_coverage",
    "gross_margin",
    "operating_margin",
    "net_margin",
    "roa",
    "roe",
    "asset_turnover",
    "cash_flow_to_debt",
]
GROWTH = {
    "revenue_growth_yoy": "Revenues",
    "assets_growth_yoy": "Assets",
    "net_income_growth_yoy": "NetIncomeLoss",
    "operating_cf_growth_yoy": "NetCashProvidedByUsedInOperatingActivities",
    "liabilities_growth_yoy": "Liabilities",
    "rd_growth_yoy": "ResearchAndDevelopmentExpense",
    "sga_growth_yoy": "SellingGeneralAndAdministrativeExpense",
    "gross_profit_growth_yoy": "GrossProfit",
}
ROLLED = ["current_ratio", "debt_to_equity", "net_margin", "roa", "cash_flow_to_debt", "revenue_growth_yoy"]
INTERACTIONS = ["altman_z_approx", "cash_burn_rate", "leverage_x_margin", "rd_intensity", "sga_intensity"]
MACRO_INTERACTIONS = ["fed_rate_x_leverage", "unemployment_x_margin", "inflation_x_cash_ratio"]
KEY_FEATURES = [
    "current_ratio",
    "quick_ratio",
    "cash_ratio",
    "debt_to_equity",
    "debt_to_assets",
    "interest_coverage",
    "gross_margin",
    "operating_margin",
    "net_margin",
    "roa",
    "roe",
    "asset_turnover",
    "cash_flow_to_debt",
    "revenue_growth_yoy",
    "net_income_growth_yoy",
    "altman_z_approx",
    "cash_burn_rate",
    "rd_intensity",
    "sga_intensity",
    "leverage_x_margin",
]
SIZE_LABELS = ["small", "mid", "large", "mega"]
FIRM_QUARTER = ["firm_id", "fiscal_year", "fiscal_period"]


def rolling_names(windows: tuple[int, ...] = (4, 8)) -> list[str]:
    return [f"{c}_rolling_{n}q_{kind}" for c in ROLLED for n in windows for kind in ("mean", "std")]


def feature_names() -> list[str]:
    return [*RATIOS, *GROWTH, *rolling_names(), *INTERACTIONS, *MACRO_INTERACTIONS]


def fiscal_order():
    return WN.ordered(["firm_id"], ["fiscal_year", Q.period_number(F.col("fiscal_period"))])


def statement_view(panel: DataFrame) -> DataFrame:
    """Feature inputs under their statement names, absent sources as 0, macro columns renamed."""
    picks = [
        F.coalesce(first_present(panel, [name, *ALIASES.get(name, [])]).cast("double"), F.lit(0.0)).alias(name)
        for name in STATEMENT_COLUMNS
    ]
    macro = [first_present(panel, [new, old]).cast("double").alias(new) for new, old in MACRO_INPUTS.items()]
    carried = [c for c in ("distress_label",) if c in panel.columns]
    return panel.select(*FIRM_QUARTER, "filed_date", *picks, *macro, *carried)


def fill_by_kind(df: DataFrame) -> DataFrame:
    """Balance and income items carried forward inside the firm, then 0; cash flows straight to 0."""
    stocks = [c for c in STOCK_ITEMS if c in df.columns]
    flows = [c for c in FLOW_ITEMS if c in df.columns]
    filled = WN.forward_fill(df, stocks, fiscal_order())
    return filled.fillna(0.0, subset=flows)


def add_ratios(df: DataFrame) -> DataFrame:
    c = F.col
    ocf = c("NetCashProvidedByUsedInOperatingActivities")
    return df.withColumns(
        {
            "current_ratio": ratio(c("AssetsCurrent"), c("LiabilitiesCurrent")),
            "quick_ratio": ratio(c("AssetsCurrent") - c("InventoryNet"), c("LiabilitiesCurrent")),
            "cash_ratio": ratio(c("CashAndCashEquivalentsAtCarryingValue"), c("LiabilitiesCurrent")),
            "debt_to_equity": ratio(c("Liabilities"), c("StockholdersEquity")),
            "debt_to_assets": ratio(c("Liabilities"), c("Assets")),
            "interest_coverage": ratio(c("OperatingIncomeLoss"), c("InterestExpense")),
            "gross_margin": ratio(c("GrossProfit"), c("Revenues")),
            "operating_margin": ratio(c("OperatingIncomeLoss"), c("Revenues")),
            "net_margin": ratio(c("NetIncomeLoss"), c("Revenues")),
            "roa": ratio(c("NetIncomeLoss"), c("Assets")),
            "roe": ratio(c("NetIncomeLoss"), c("StockholdersEquity")),
            "asset_turnover": ratio(c("Revenues"), c("Assets")),
            "cash_flow_to_debt": ratio(ocf, c("Liabilities")),
        }
    )


def add_growth(df: DataFrame, denominator: str = "abs") -> DataFrame:
    spec = fiscal_order()
    return df.withColumns({n: WN.growth(F.col(c), spec, 4, denominator) for n, c in GROWTH.items()})


def add_rolling(df: DataFrame, windows: tuple[int, ...] = (4, 8)) -> DataFrame:
    spec = fiscal_order()
    made = {}
    for column in ROLLED:
        for n in windows:
            made[f"{column}_rolling_{n}q_mean"] = WN.rolling_mean(column, spec, n)
            made[f"{column}_rolling_{n}q_std"] = WN.rolling_std(column, spec, n)
    return df.withColumns(made)


def z_score() -> Column:
    c = F.col
    parts = [
        (1.2, ratio(c("AssetsCurrent") - c("LiabilitiesCurrent"), c("Assets"))),
        (1.4, ratio(c("RetainedEarningsAccumulatedDeficit"), c("Assets"))),
        (3.3, ratio(c("OperatingIncomeLoss"), c("Assets"))),
        (0.6, ratio(c("StockholdersEquity"), c("Liabilities"))),
        (1.0, ratio(c("Revenues"), c("Assets"))),
    ]
    total = parts[0][1] * parts[0][0]
    for weight, part in parts[1:]:
        total = total + part * weight
    return total


def add_interactions(df: DataFrame) -> DataFrame:
    c = F.col
    spending = c("CostOfGoodsAndServicesSold") + c("SellingGeneralAndAdministrativeExpense") + c("ResearchAndDevelopmentExpense")
    burn = WN.change(c("CashAndCashEquivalentsAtCarryingValue"), fiscal_order())
    return df.withColumns(
        {
            "altman_z_approx": z_score(),
            "cash_burn_rate": ratio(burn, spending),
            "leverage_x_margin": c("debt_to_equity") * c("operating_margin"),
            "rd_intensity": ratio(c("ResearchAndDevelopmentExpense"), c("Revenues")),
            "sga_intensity": ratio(c("SellingGeneralAndAdministrativeExpense"), c("Revenues")),
        }
    )


def add_macro_interactions(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns(
        {
            "fed_rate_x_leverage": c("fed_funds") * c("debt_to_equity"),
            "unemployment_x_margin": c("unemployment") * c("net_margin"),
            "inflation_x_cash_ratio": c("inflation") * c("cash_ratio"),
        }
    )


def sector_proxy() -> Column:
    # The sectors and their limits.
    c = F.col
    return (
        F.when(ratio(c("ResearchAndDevelopmentExpense"), c("Revenues")) > 0.15, "tech_pharma")
        .when(ratio(c("InventoryNet"), c("Assets")) > 0.20, "manufacturing_retail")
        .when(ratio(c("InterestExpense"), c("Revenues")) > 0.05, "financial_capital_intensive")
        .otherwise("services_other")
    )


def _size_label(tile: Column) -> Column:
    picked = F.when(tile == 1, SIZE_LABELS[0])
    for i, name in enumerate(SIZE_LABELS[1:], start=2):
        picked = picked.when(tile == i, name)
    return picked


SIZE_ORDER = ["Assets", "firm_id", "fiscal_year", "fiscal_period"]


def size_by_rank(df: DataFrame) -> DataFrame:
    """Four equal groups by assets; ties are ordered by firm and quarter (fits three cut rows first)."""
    cuts = tile_cuts(df, SIZE_ORDER, 4)
    return df.withColumn("company_size_bucket", _size_label(tile_of(SIZE_ORDER, cuts)))


def size_cuts(df: DataFrame, accuracy: int | None = None) -> tuple[float, float, float]:
    """Fit the quartile cut points of assets (runs a job, returns three numbers)."""
    wanted = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    row = (folds.group_summaries(df, [], ["Assets"], wanted) if accuracy is None else group_quantiles(df, [], "Assets", wanted, accuracy)).first()
    return (row["q1"], row["q2"], row["q3"]) if row else (None, None, None)


def size_by_cuts(df: DataFrame, cuts: tuple[float, float, float]) -> DataFrame:
    """Quantile groups: equal values never part; intervals are closed on the right."""
    low, middle, high = cuts
    a = F.col("Assets")
    bucket = F.when(a <= low, 1).when(a <= middle, 2).when(a <= high, 3).when(a > high, 4)
    return df.withColumn("company_size_bucket", _size_label(bucket))


def clip_spread(df: DataFrame, columns: list[str], n_std: float = 5.0) -> DataFrame:
    """Clip to mean +- n_std sample deviations; all columns are fitted in one pass (runs a job)."""
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]
    ).first()
    clipped = {}
    for c in columns:
        mean, std = stats[f"m_{c}"], stats[f"s_{c}"]
        if std:
            low, high = mean - n_std * std, mean + n_std * std
            clipped[c] = F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(low)), F.lit(high)))
    return df.withColumns(clipped)


def engineer(panel: DataFrame, size: str = "ntile", denominator: str = "abs", clip: float | None = None) -> DataFrame:
    """The engineered table. `panel` is a stored table, unique per firm and quarter; it is read several times."""
    view = statement_view(panel)
    # The size groups are fitted on the narrow inputs, so no wide row is sorted globally.
    sized = size_by_rank(view) if size == "ntile" else size_by_cuts(view, size_cuts(view))
    inputs = WN.fill_by_date(sized, list(MACRO_INPUTS), "filed_date")
    made = add_macro_interactions(add_interactions(add_rolling(add_growth(add_ratios(inputs), denominator))))
    made = made.withColumn("sector_proxy", sector_proxy())
    return made if clip is None else clip_spread(made, feature_names(), clip)


def zero_missing_features(df: DataFrame, identity: tuple[str, ...] = ("firm_id", "fiscal_year", "fiscal_period", "distress_label")) -> DataFrame:
    """Final export fill: every numeric non-identity column without gaps."""
    numeric = [n for n, t in df.dtypes if t in ("double", "float", "int", "bigint") and n not in identity]
    return df.fillna(0, subset=numeric)
