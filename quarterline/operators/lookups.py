"""Lookup tables: best, latest and previous scores, names, watchlists, histories.

Selections per firm use group limits (a hot firm sends a few rows per map task); dictionary joins are left
to the size-checked automatic broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions import quarters as Q
from quarterline.functions import scalars as S
from quarterline.operators.dedup import nth_row, top_rows

QUARTER = ["firm_id", "fiscal_year", "fiscal_period"]


def newest_first(ties: list[str] | None = None) -> list[Column]:
    order = [F.col("fiscal_year").desc(), Q.period_number(F.col("fiscal_period")).desc_nulls_last()]
    return order + [F.col(t).desc() for t in ties or []]


def best_per_firm(scores: DataFrame, score: str, ties: list[str]) -> DataFrame:
    return top_rows(scores, ["firm_id"], [F.col(score).desc_nulls_last(), *[F.col(t) for t in ties]])


def best_per_quarter(scores: DataFrame, score: str, ties: list[str]) -> DataFrame:
    return top_rows(scores, QUARTER, [F.col(score).desc_nulls_last(), *[F.col(t) for t in ties]])


def latest_per_firm(df: DataFrame, n: int = 1, ties: list[str] | None = None) -> DataFrame:
    return top_rows(df, ["firm_id"], newest_first(ties), n)


def nth_latest(df: DataFrame, n: int, ties: list[str] | None = None) -> DataFrame:
    return nth_row(df, ["firm_id"], newest_first(ties), n)


def named(df: DataFrame, companies: DataFrame) -> DataFrame:
    joined = df.join(companies, "firm_id", "left")
    shown = S.display_name(F.col("firm_id"), F.col("name"), F.col("ticker"))
    return joined.withColumn("company_name", shown).drop("name", "ticker")


def alerts(scores: DataFrame, companies: DataFrame, score: str, ties: list[str], threshold: float = 0.7) -> DataFrame:
    """Best score per firm at or above the threshold, with display names."""
    above = scores.where(F.col(score) >= threshold)
    return named(best_per_firm(above, score, ties), companies).withColumn("risk_level", S.risk_level(F.col(score)))


def history(scores: DataFrame, score: str, ties: list[str], firm: str | None = None) -> DataFrame:
    """One row per firm and quarter (the highest score) with its place in time; one firm on request."""
    rows = scores if firm is None else scores.where(F.col("firm_id") == firm)
    kept = best_per_quarter(rows, score, ties)
    return kept.withColumns(
        {
            "sort_number": Q.sort_number(F.col("fiscal_year"), F.col("fiscal_period")),
            "quarter_label": Q.quarter_label(F.col("fiscal_year"), F.col("fiscal_period")),
        }
    )


def watchlist(scores: DataFrame, panel: DataFrame, score: str) -> DataFrame:
    """Latest score, change on the quarter before, and warning texts from the latest panel row.

    `scores` has one row per firm and quarter. Latest and previous come from one pass: the two newest rows
    per firm, folded by rank.
    """
    two = latest_per_firm(scores, 2).withColumn("_place", Q.sort_number(F.col("fiscal_year"), F.col("fiscal_period")))
    folded = two.groupBy("firm_id").agg(
        F.max(F.struct("_place", "fiscal_year", "fiscal_period", score)).alias("_new"),
        F.min(F.struct("_place", score)).alias("_old"),
        F.count(F.lit(1)).alias("_n"),
    )
    latest = folded.select(
        "firm_id",
        F.col(f"_new.{score}").alias("risk_score"),
        F.when(F.col("_n") > 1, F.col(f"_new.{score}") - F.col(f"_old.{score}")).otherwise(0.0).alias("change"),
        Q.quarter_label(F.col("_new.fiscal_year"), F.col("_new.fiscal_period")).alias("quarter"),
    )
    state = latest_per_firm(panel).select(
        "firm_id", "net_income", "operating_cash_flow", "retained_earnings", "total_assets", "total_liabilities", "distress_label"
    )
    joined = latest.join(state, "firm_id", "left")
    c = F.col
    # The warnings and the limit of high leverage.
    flags = [
        (c("net_income") < 0, "Neg. income"),
        (c("operating_cash_flow") < 0, "Neg. cash flow"),
        (c("retained_earnings") < 0, "Retained earnings deficit"),
        ((c("total_assets") > 0) & (S.ratio(c("total_liabilities"), c("total_assets")) > 0.8), "High leverage"),
    ]
    return joined.select(
        "firm_id",
        F.coalesce("distress_label", F.lit(0)).alias("distress_label"),
        "risk_score",
        "change",
        S.joined_text(flags).alias("signals"),
        "quarter",
    )


def watchlist_filter(rows: DataFrame, threshold: float = 0.10) -> DataFrame:
    return rows.where((F.col("distress_label") == 1) | (F.col("risk_score") >= threshold))


def watchlist_summary(rows: DataFrame, threshold: float = 0.10) -> DataFrame:
    return rows.agg(
        F.count_if(F.col("risk_score") >= 0.5).alias("above_half"),
        F.count_if((F.col("distress_label") == 1) | (F.col("risk_score") >= threshold)).alias("shown"),
        F.count(F.lit(1)).alias("total"),
    )


def parsed_features(json: Column, keep: int = 3) -> Column:
    """Top features from JSON text; bad or empty text gives an empty list."""
    kind = "array<struct<feature:string,shap_value:double,rank:int>>"
    return F.slice(F.coalesce(F.from_json(json, kind), F.array().cast(kind)), 1, keep)


def requested_quarter(text: Column) -> tuple[Column, Column]:
    """(year, period) of a YYYY-Qn text; NULLs when it is malformed."""
    parts = F.split(text, "-")
    good = F.size(parts) == 2
    return F.when(good, F.get(parts, F.lit(0)).try_cast("int")), F.when(good, F.get(parts, F.lit(1)))


def top_features(attributed: DataFrame, requests: DataFrame) -> DataFrame:
    """Top three features for each requested (firm_id, quarter text); no match gives no row."""
    year, period = requested_quarter(F.col("quarter"))
    wanted = requests.withColumns({"fiscal_year": year, "fiscal_period": period})
    found = wanted.join(attributed, QUARTER)
    return found.withColumn("features", parsed_features(F.col("top_features_json")))


def snapshot(panel: DataFrame, scored: DataFrame) -> DataFrame:
    """Per firm the panel row of its scored quarter, else its newest row."""
    mark = scored.select("firm_id", F.col("fiscal_year").alias("_year"), F.col("fiscal_period").alias("_period"))
    joined = panel.join(mark, "firm_id", "left")
    match = F.coalesce((F.col("fiscal_year") == F.col("_year")) & (F.col("fiscal_period") == F.col("_period")), F.lit(False))
    marked = joined.withColumn("matches_score", match)
    return top_rows(marked, ["firm_id"], [F.col("matches_score").desc(), *newest_first()]).drop("_year", "_period")
