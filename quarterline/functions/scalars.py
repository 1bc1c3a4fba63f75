"""Column expressions: typing, keys, safe arithmetic, labels and display text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Score thresholds of the risk levels.
HIGH_RISK = 0.70
MEDIUM_RISK = 0.30


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lower() for name in df.columns])


def first_present(df: DataFrame, candidates: list[str]) -> Column:
    """First non-null value among those candidate columns that the table has."""
    present = [F.col(c) for c in candidates if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None)


def zero_pad(key: Column, width: int = 10) -> Column:
    """Left-pad with zeros; longer keys stay whole (plain lpad would cut them)."""
    text = key.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def to_day(text: Column) -> Column:
    return text.try_cast("date")


def normal_code(code: Column) -> Column:
    return F.upper(F.trim(code))


def nan_to_null(value: Column, fill: float | None = None) -> Column:
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    cleaned = F.when(~bad, value)
    return cleaned if fill is None else F.coalesce(cleaned, F.lit(fill))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero or missing divisor."""
    return F.try_divide(numerator, denominator)


def epoch_nanos(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp")) * F.lit(1000)


def risk_level(score: Column, high: float = HIGH_RISK, medium: float = MEDIUM_RISK) -> Column:
    return F.when(score >= high, "High").when(score >= medium, "Medium").otherwise("Low")


def display_score(score: Column) -> Column:
    return F.least(F.pow(score, F.lit(0.35)), F.lit(1.0))


def confidence_band(score: Column, margin: float = 0.05) -> tuple[Column, Column]:
    return F.greatest(score - margin, F.lit(0.0)), F.least(score + margin, F.lit(1.0))


def one_decimal(value: Column) -> Column:
    """Text of a non-negative number with one decimal, rounded on its exact binary value, ties to even.

    Twenty times the value is kept as a sum and its rounding error (16 and 4 times are exact), so comparing it
    with an odd whole number decides exactly which side of a midpoint the value lies on.
    """
    large, small = value * 16, value * 4
    total = large + small
    error = small - (total - large)
    tenths = F.floor(total / 2)
    side = (total - (tenths * 2 + 1)) + error
    rounded = tenths + F.when((side > 0) | ((side == 0) & (tenths % 2 == 1)), 1).otherwise(0)
    return F.concat(F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string"))


def money_text(amount: Column) -> Column:
    """$24.2B, $3.1M, $500K; N/A when missing."""
    size = F.abs(amount)
    sign = F.when(amount < 0, "-").otherwise("")
    body = (
        F.when(size >= 1e9, F.concat(one_decimal(size / 1e9), F.lit("B")))
        .when(size >= 1e6, F.concat(one_decimal(size / 1e6), F.lit("M")))
        .when(size >= 1e3, F.concat(F.rint(size / 1e3).cast("bigint").cast("string"), F.lit("K")))
        .otherwise(F.rint(size).cast("bigint").cast("string"))
    )
    return F.when(amount.isNull(), "N/A").otherwise(F.concat(sign, F.lit("$"), body))


def joined_text(flags: list[tuple[Column, str]], empty: str = "—") -> Column:
    """Texts of the true flags joined by a middle dot."""
    texts = F.array_compact(F.array(*[F.when(flag, F.lit(text)) for flag, text in flags]))
    return F.when(F.size(texts) > 0, F.array_join(texts, " · ")).otherwise(empty)


def display_name(firm: Column, name: Column, ticker: Column) -> Column:
    """`name (ticker)`, the name alone, or `CIK <id>` when the firm is unknown."""
    name_text = F.nullif(F.trim(name), F.lit(""))
    ticker_text = F.nullif(F.trim(ticker), F.lit(""))
    return F.coalesce(
        F.concat(name_text, F.lit(" ("), ticker_text, F.lit(")")),
        name_text,
        F.concat(F.lit("CIK "), firm),
    )


def trend_text(change: Column, dead_band: float = 0.01) -> Column:
    return F.when(change > dead_band, "up").when(change < -dead_band, "down").otherwise("flat")


def stamped(df: DataFrame, **values: object) -> DataFrame:
    """Add one constant column per keyword (versions, run ids, times)."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})
