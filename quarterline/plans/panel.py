"""The standard panel and the forward-looking distress label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions import quarters as Q
from quarterline.functions.scalars import ratio
from quarterline.operators import windows as WN
from quarterline.operators.dedup import top_rows

# Raw names of the cleaned table and their panel names.
PANEL_NAMES = {
    "cik": "firm_id",
    "end_date": "date",
    "Assets": "total_assets",
    "Liabilities": "total_liabilities",
    "StockholdersEquity": "total_equity",
    "NetIncomeLoss": "net_income",
    "NetCashProvidedByUsedInOperatingActivities": "operating_cash_flow",
    "InterestExpense": "interest_expense",
    "OperatingIncomeLoss": "operating_income",
    "RetainedEarningsAccumulatedDeficit": "retained_earnings",
}
# The measures of the panel and the names of the signals.
MEASURES = [
    "total_assets",
    "total_liabilities",
    "net_income",
    "operating_cash_flow",
    "total_equity",
    "interest_expense",
    "operating_income",
    "retained_earnings",
]
SIGNALS = ["s1_neg_income", "s2_neg_ocf", "s3_leverage", "s4_low_coverage", "s5_declining_re"]


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def plausible_dates(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows dated 1993 to 2030; rows without a date leave too."""
    return df.where(F.col(date).between(F.lit("1993-01-01").cast("date"), F.lit("2030-12-31").cast("date")))


def firm_dates():
    return WN.ordered(["firm_id"], ["date"])


def row_order(df: DataFrame, ties: tuple[str, ...] = ("filed_date",)) -> list[Column]:
    """Which row of a firm and date stays: the last filed, a quarter before the year that ends with it, then the largest values.

    The order is total up to equal measures, so the panel doesn't depend on how rows came in.
    """
    order = [F.col(t).desc_nulls_last() for t in ties if t in df.columns]
    if "fiscal_period" in df.columns:
        order += [Q.period_number(F.col("fiscal_period")).desc_nulls_last(), F.col("fiscal_period").asc_nulls_last()]
    if "fiscal_year" in df.columns:
        order.append(F.col("fiscal_year").desc_nulls_last())
    measures = [n for n, t in df.dtypes if t == "double" and n not in MEASURES]
    return [*order, *[F.col(m).desc_nulls_last() for m in [*MEASURES, *measures]]]


def build_panel(cleaned: DataFrame, ties: tuple[str, ...] = ("filed_date",)) -> DataFrame:
    """Standard names, plausible dates, one row per firm and date by `row_order`, gap in days, lags 1 and 4."""
    renamed = cleaned.withColumnsRenamed({k: v for k, v in PANEL_NAMES.items() if k in cleaned.columns})
    require_columns(renamed, ["firm_id", "date", *MEASURES])
    dated = plausible_dates(renamed.withColumn("date", F.col("date").try_cast("date")))
    single = top_rows(dated, ["firm_id", "date"], row_order(dated, ties))
    spaced = single.withColumn("days_since_previous", WN.day_gap("date", firm_dates()))
    return WN.add_lags(spaced, MEASURES, firm_dates())


def signal_columns(spec=None) -> dict[str, Column]:
    """The five distress signals of a firm-quarter as booleans that are never NULL."""
    spec = spec or firm_dates()
    leverage = ratio(F.col("total_liabilities"), F.col("total_equity"))
    coverage = ratio(F.col("operating_income"), F.col("interest_expense"))
    return {
        "s1_neg_income": WN.held_for(F.col("net_income") < 0, spec, 2),
        "s2_neg_ocf": WN.held_for(F.col("operating_cash_flow") < 0, spec, 2),
        "s3_leverage": WN.rose_by(leverage, spec, 4, 0.20),
        "s4_low_coverage": WN.held_for(coverage < 1.5, spec, 2),
        "s5_declining_re": WN.fell_for(F.col("_re_step"), spec, 3),
    }


def with_signals(panel: DataFrame) -> DataFrame:
    stepped = panel.withColumn("_re_step", WN.change(F.col("retained_earnings"), firm_dates()))
    flagged = stepped.withColumns(signal_columns()).drop("_re_step")
    count = sum((F.col(s).cast("int") for s in SIGNALS[1:]), F.col(SIGNALS[0]).cast("int"))
    return flagged.withColumn("signal_count", count)


def label(panel: DataFrame, horizon: int = 1, needed: int = 2, keep_signals: bool = False) -> DataFrame:
    """distress_label: at least `needed` signals fire together `horizon` quarters later."""
    flagged = with_signals(panel)
    labeled = flagged.withColumn("distress_label", WN.ahead(F.col("signal_count") >= needed, firm_dates(), horizon))
    return labeled if keep_signals else labeled.drop(*SIGNALS, "signal_count")


def two_loss_label(panel: DataFrame, horizon: int = 1, name: str = "distress_label_old") -> DataFrame:
    """The earlier rule: two losses in a row, `horizon` quarters ahead."""
    held = panel.withColumn("_held", WN.held_for(F.col("net_income") < 0, firm_dates(), 2))
    return held.withColumn(name, WN.ahead(F.col("_held"), firm_dates(), horizon)).drop("_held")
