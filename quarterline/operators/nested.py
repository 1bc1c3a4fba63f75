"""Nested documents to rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.scalars import zero_pad

# The shape of a company document, and the forms and periods worth keeping.
FACT_ENTRY = "struct<form:string,fp:string,fy:string,val:string,start:string,end:string,filed:string,frame:string>"
DOCUMENT = f"struct<facts:map<string,map<string,struct<units:map<string,array<{FACT_ENTRY}>>>>>>"
FORMS = ("10-Q", "10-K")
PERIODS = ("Q1", "Q2", "Q3", "Q4")


def flatten_facts(documents: DataFrame, taxonomy: str = "us-gaap", forms=FORMS, periods=PERIODS) -> DataFrame:
    """One row per fact of (firm_id, doc): tag, unit, value, dates, fiscal quarter, form, frame."""
    parsed = documents.select("firm_id", F.from_json("doc", DOCUMENT)["facts"][taxonomy].alias("tags"))
    tags = parsed.select("firm_id", F.explode("tags").alias("tag", "body"))
    units = tags.select("firm_id", "tag", F.explode("body.units").alias("unit", "entries"))
    entries = units.select("firm_id", "tag", "unit", F.inline("entries"))
    kept = entries.where(F.col("form").isin(*forms) & F.col("fp").isin(*periods))
    return kept.select(
        zero_pad(F.col("firm_id")).alias("firm_id"),
        "tag",
        "unit",
        F.col("val").try_cast("double").alias("value"),
        F.col("start").try_cast("date").alias("start_date"),
        F.col("end").try_cast("date").alias("end_date"),
        F.col("fy").try_cast("int").alias("fiscal_year"),
        F.col("fp").alias("fiscal_period"),
        "form",
        F.col("filed").try_cast("date").alias("filed_date"),
        "frame",
    )


def zip_filings(documents: DataFrame, forms: tuple[str, ...], since: str, arrays: dict[str, str]) -> DataFrame:
    """Rows of the parallel arrays under `recent` ({array name: column}), by form and first date."""
    zipped = documents.select("*", F.inline(F.arrays_zip(*[F.col(f"recent.{a}").alias(c) for a, c in arrays.items()])))
    dated = zipped.drop("recent").withColumn("filing_date", F.col("filing_date").try_cast("date"))
    return dated.where(F.col("form").isin(*forms) & (F.col("filing_date") >= F.lit(since).cast("date")))


def flatten_observations(documents: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, date, value) of an observations array; text that is no number becomes NULL."""
    kind = "struct<observations:array<struct<date:string,value:string>>>"
    rows = documents.select(*keys, F.inline(F.from_json("doc", kind)["observations"]))
    return rows.select(*keys, F.col("date").try_cast("date").alias("date"), F.col("value").try_cast("double").alias("value"))


def series_by_date(series: DataFrame, names: list[str]) -> DataFrame:
    """Outer alignment of several series on the date: one row per date, one column per series."""
    picks = [F.max(F.when(F.col("series_id") == n, F.col("value"))).alias(n) for n in names]
    return series.groupBy("date").agg(*picks)


def top_contributions(df: DataFrame, columns: list[str], k: int = 3, prefix: str = "shap_") -> Column:
    """Array of the k largest contributions by size: feature, value rounded to 6 places, rank."""
    entries = F.array(
        *[
            F.struct(
                (-F.abs(F.coalesce(F.col(c), F.lit(0.0)))).alias("size"),
                F.lit(c.removeprefix(prefix)).alias("feature"),
                F.coalesce(F.col(c), F.lit(0.0)).alias("value"),
            )
            for c in columns
        ]
    )
    best = F.slice(F.array_sort(entries), 1, k)
    return F.transform(
        best,
        lambda entry, i: F.struct(
            entry["feature"].alias("feature"), F.round(entry["value"], 6).alias("shap_value"), (i + 1).cast("int").alias("rank")
        ),
    )


def contributions_json(df: DataFrame, columns: list[str], k: int = 3) -> Column:
    return F.to_json(top_contributions(df, columns, k))
