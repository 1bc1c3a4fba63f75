"""From long facts to the cleaned firm-quarter table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.functions import quarters as Q
from quarterline.functions.scalars import lower_names, normal_code, zero_pad
from quarterline.operators import windows as WN
from quarterline.operators.dedup import keep_latest
from quarterline.operators.filters import drop_sparse_columns
from quarterline.operators.reshape import widen

# The forty statement tags of the cleaned table.
STATEMENT_TAGS = [
    "Assets",
    "Liabilities",
    "StockholdersEquity",
    "LiabilitiesAndStockholdersEquity",
    "RetainedEarningsAccumulatedDeficit",
    "NetIncomeLoss",
    "CashAndCashEquivalentsAtCarryingValue",
    "NetCashProvidedByUsedInOperatingActivities",
    "IncomeTaxExpenseBenefit",
    "NetCashProvidedByUsedInFinancingActivities",
    "NetCashProvidedByUsedInInvestingActivities",
    "WeightedAverageNumberOfSharesOutstandingBasic",
    "EarningsPerShareBasic",
    "PropertyPlantAndEquipmentNet",
    "WeightedAverageNumberOfDilutedSharesOutstanding",
    "EarningsPerShareDiluted",
    "CommonStockValue",
    "ShareBasedCompensation",
    "CommonStockSharesAuthorized",
    "AccumulatedOtherComprehensiveIncomeLossNetOfTax",
    "AssetsCurrent",
    "LiabilitiesCurrent",
    "OperatingIncomeLoss",
    "CommonStockSharesIssued",
    "CommonStockParOrStatedValuePerShare",
    "ComprehensiveIncomeNetOfTax",
    "PaymentsToAcquirePropertyPlantAndEquipment",
    "CommonStockSharesOutstanding",
    "Goodwill",
    "OtherAssetsNoncurrent",
    "AccountsPayableCurrent",
    "InterestExpense",
    "OtherLiabilitiesNoncurrent",
    "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
    "AccountsReceivableNetCurrent",
    "PreferredStockSharesAuthorized",
    "IncreaseDecreaseInAccountsReceivable",
    "DepreciationDepletionAndAmortization",
    "OtherNonoperatingIncomeExpense",
    "ProfitLoss",
]

# Macro series and the columns they become.
MACRO_SERIES = {
    "BAMLC0A4CBBB": "BBB_spread",
    "CPIAUCSL": "CPI",
    "DFF": "FedFundsRate",
    "GDP": "GDP",
    "UNRATE": "UnemploymentRate",
    "VIXCLS": "VIX",
}
MACRO_COLUMNS = list(MACRO_SERIES.values())

FACT_KEY = ["firm_id", "fiscal_year", "fiscal_period", "tag"]
QUARTER_KEY = ["firm_id", "fiscal_year", "fiscal_period"]
VALID_PERIODS = ["Q1", "Q2", "Q3", "Q4", "FY"]


def typed_facts(raw: DataFrame, ties: list[str], key: str = "firm_id") -> DataFrame:
    """Typed, filtered and deduplicated facts: one row per firm, quarter and tag, the latest filing.

    Column names are stripped and lower-cased first. Years may be written as decimals; rows without a plausible year or a known period
    leave. A `quarter_end_date` that is null in more than nine rows of ten is dropped (one aggregate job where there is such a column).
    """
    raw = lower_names(raw)
    if "quarter_end_date" in raw.columns:
        raw = drop_sparse_columns(raw, ["quarter_end_date"])
    year = F.col("fiscal_year").try_cast("double")
    facts = raw.withColumns(
        {
            key: zero_pad(F.col(key)),
            "fiscal_year": F.when(year.between(Q.FIRST_YEAR, Q.LAST_YEAR + 1), F.floor(year).cast("int")),
            "fiscal_period": normal_code(F.col("fiscal_period")),
        }
    )
    facts = facts.where(
        F.col("fiscal_period").isin(VALID_PERIODS)
        & F.col("fiscal_year").between(Q.FIRST_YEAR, Q.LAST_YEAR)
    ).withColumn("quarter_key", Q.quarter_key(F.col("fiscal_year"), F.col("fiscal_period")))
    dates = [c for c in ("filed_date", "end_date", "start_date") if c in facts.columns]
    facts = facts.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in dates})
    return keep_latest(facts, [key, "fiscal_year", "fiscal_period", "tag"], "filed_date", ties)


def typed_series(raw: DataFrame, ties: list[str]) -> DataFrame:
    """Macro observations snapped to quarter ends, the last one per series and quarter by `ties`; without `ties` the largest value."""
    series = raw.withColumns(
        {"date": Q.quarter_end_of(F.col("date").try_cast("timestamp_ntz")), "value": F.col("value").try_cast("double")}
    ).where(F.col("date").isNotNull())
    order = ties or ["value"]
    return keep_latest(series, ["series_id", "date"], order[0], order[1:])


def widen_statements(facts: DataFrame, keys: list[str], tags: list[str] = STATEMENT_TAGS) -> DataFrame:
    return widen(facts, keys, "tag", "value", tags)


def widen_macro(series: DataFrame) -> DataFrame:
    """One row per quarter key."""
    keyed = series.withColumn("quarter_key", Q.quarter_key_of(F.col("date")))
    return widen(keyed, ["quarter_key"], "series_id", "value", MACRO_SERIES)


def join_macro(statements: DataFrame, macro: DataFrame) -> DataFrame:
    """Left join on the quarter key; `macro` comes from widen_macro, and its measured size decides whether it is broadcast."""
    return statements.join(macro, "quarter_key", "left")


def repair_identity(df: DataFrame, assets: str = "Assets", liabilities: str = "Liabilities", equity: str = "StockholdersEquity") -> DataFrame:
    """Fill one missing side of assets = liabilities + equity from the two original others."""
    a, li, e = F.col(assets), F.col(liabilities), F.col(equity)
    return df.withColumns(
        {assets: F.coalesce(a, li + e), liabilities: F.coalesce(li, a - e), equity: F.coalesce(e, a - li)}
    )


def zero_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.fillna(0.0, subset=present)


def clean(facts: DataFrame, series: DataFrame, tags: list[str] = STATEMENT_TAGS, grain: str = "quarter") -> DataFrame:
    """The cleaned table: pivot, macro join, identity repair, zero fill, macro fill inside each firm.

    grain "quarter": one row per firm, year and period, yearly periods included, filings merged. grain "filing": each filing of a period,
    and each end date that it tells, keeps a row of its own; `panel.build_panel` takes one per firm and date. The date is the facts' own `end_date` where they have one, so fiscal
    years that don't follow the calendar keep theirs, and else the end of the quarter, for a yearly period the end of the year.
    """
    if grain not in ("quarter", "filing"):
        raise ValueError(f"no grain {grain}")
    has_end = "end_date" in facts.columns
    if grain == "filing":
        keys = [*QUARTER_KEY, "filed_date", *(["_end"] if has_end else [])]
        facts = facts.withColumn("_end", F.col("end_date").cast("date")) if has_end else facts
        merged = []
    else:
        keys = QUARTER_KEY
        merged = [F.max("filed_date").alias("filed_date"), *([F.max(F.col("end_date").cast("date")).alias("_end")] if has_end else [])]
    wide = facts.groupBy(*keys).agg(
        *merged,
        *[F.max(F.when(F.col("tag") == t, F.col("value"))).alias(t) for t in tags],
    )
    year, period = F.col("fiscal_year"), F.col("fiscal_period")
    ends = [Q.quarter_end(year, period), F.when(period == "FY", F.make_date(year, F.lit(12), F.lit(31)))]
    wide = wide.withColumns(
        {"quarter_key": Q.quarter_key(year, period), "end_date": F.coalesce(*([F.col("_end")] if has_end else []), *ends)}
    ).drop("_end")
    joined = zero_fill(repair_identity(join_macro(wide, widen_macro(series))), tags)
    by_filing = WN.ordered(["firm_id"], [F.col("filed_date").asc_nulls_first(), "fiscal_year", "fiscal_period", "end_date"])
    return WN.fill_both_ways(joined, MACRO_COLUMNS, by_filing)
