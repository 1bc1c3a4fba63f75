"""Fiscal quarter expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The plausible fiscal years; they also bound a firm's panel to 4 rows a year.
FIRST_YEAR, LAST_YEAR = 1990, 2030
QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def period_of(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))


def quarter_key(year: Column, period: Column) -> Column:
    return F.concat_ws("_", year.cast("string"), period)


def quarter_key_of(day: Column) -> Column:
    return quarter_key(F.year(day), period_of(day))


def period_number(period: Column) -> Column:
    """1..4 for Q1..Q4, NULL for anything else."""
    return F.when(period.isin(*QUARTERS), F.substring(period, 2, 1).try_cast("int"))


def sort_number(year: Column, period: Column) -> Column:
    """year * 10 + quarter, an unknown quarter counting as 0."""
    return year * 10 + F.coalesce(period_number(period), F.lit(0))


def quarter_label(year: Column, period: Column) -> Column:
    return F.concat_ws(" ", period, year.cast("string"))


def quarter_end_of(day: Column) -> Column:
    return F.last_day(F.add_months(F.date_trunc("QUARTER", day).cast("date"), 2))


def quarter_end(year: Column, period: Column) -> Column:
    return F.last_day(F.make_date(year, period_number(period) * 3, F.lit(1)))


def run_quarter(day: Column) -> tuple[Column, Column]:
    return F.year(day), period_of(day)


def run_month(day: Column) -> tuple[Column, Column]:
    return F.year(day), F.date_format(day, "MM")
