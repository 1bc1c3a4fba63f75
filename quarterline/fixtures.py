"""Views that give the benchmark tables the shape of filing facts, macro series, scores and so on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.functions import quarters as Q
from quarterline.functions.scalars import zero_pad
from quarterline.operators.dedup import keep_latest
from quarterline.plans import cleaning, features, panel
from quarterline.session import materialise

# Tag by return flag, line status and line number modulo 3.
TAG_OF = {
    "NO1": "Assets",
    "NO2": "AssetsCurrent",
    "NO0": "InventoryNet",
    "NF1": "Liabilities",
    "NF2": "LiabilitiesCurrent",
    "NF0": "InterestExpense",
    "RO1": "StockholdersEquity",
    "RO2": "RetainedEarningsAccumulatedDeficit",
    "RO0": "CashAndCashEquivalentsAtCarryingValue",
    "RF1": "NetIncomeLoss",
    "RF2": "ProfitLoss",
    "RF0": "GrossProfit",
    "AF1": "NetCashProvidedByUsedInOperatingActivities",
    "AF2": "OperatingIncomeLoss",
    "AF0": "CostOfGoodsAndServicesSold",
    "AO1": "ResearchAndDevelopmentExpense",
    "AO2": "SellingGeneralAndAdministrativeExpense",
    "AO0": "DepreciationDepletionAndAmortization",
}
FACT_TAGS = list(TAG_OF.values())
SIGNED_TAGS = ["NetIncomeLoss", "NetCashProvidedByUsedInOperatingActivities", "OperatingIncomeLoss"]
SPENDING_TAGS = [
    "GrossProfit",
    "CostOfGoodsAndServicesSold",
    "ResearchAndDevelopmentExpense",
    "SellingGeneralAndAdministrativeExpense",
    "DepreciationDepletionAndAmortization",
]
SERIES_OF = {"1-URGENT": "DFF", "2-HIGH": "UNRATE", "3-MEDIUM": "CPIAUCSL", "4-NOT SPECIFIED": "GDP", "5-LOW": "VIXCLS"}
FACT_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "value"]
TRAIN_YEARS, VALIDATION_YEARS, TEST_YEARS = (1995, 1998), (1999, 1999), (2000, 2001)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _mapped(mapping: dict[str, str], code):
    items = list(mapping.items())
    first = F.when(code == items[0][0], items[0][1])
    return reduce(lambda picked, item: picked.when(code == item[0], item[1]), items[1:], first)


def facts(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    line = table(spark, folder, "lineitem").select(*columns)
    code = F.concat("l_returnflag", "l_linestatus", (F.col("l_linenumber") % 3).cast("string"))
    shaped = line.select(
        zero_pad(F.col("l_suppkey")).alias("firm_id"),
        F.year("l_shipdate").alias("fiscal_year"),
        Q.period_of(F.col("l_shipdate")).alias("fiscal_period"),
        _mapped(TAG_OF, code).alias("tag"),
        F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("_price"),
        F.rint(F.col("l_discount") * 100).cast("bigint").alias("_discount"),
        F.rint(F.col("l_tax") * 100).cast("bigint").alias("_tax"),
        F.col("l_shipdate").alias("filed_date"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )
    # Whole cents and percents keep the products exact.
    tag, price = F.col("tag"), F.col("_price")
    value = (
        F.when(tag.isin(SIGNED_TAGS), price * (F.col("_discount") - 5) / 10000.0)
        .when(tag.isin(SPENDING_TAGS), price * F.col("_discount") / 10000.0)
        .when(tag == "InterestExpense", price * F.col("_tax") / 10000.0)
        .otherwise(price / 100.0)
    )
    return shaped.withColumn("value", value).drop("_price", "_discount", "_tax")


def latest_facts(spark: SparkSession, folder: str) -> DataFrame:
    return keep_latest(facts(spark, folder), cleaning.FACT_KEY, "filed_date", FACT_TIES)


def macro(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.select(
        _mapped(SERIES_OF, F.col("o_orderpriority")).alias("series_id"),
        F.col("o_orderdate").alias("date"),
        (F.col("o_totalprice") / 100000.0).alias("value"),
        "o_orderkey",
    )


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(latest_facts(spark, folder), macro(spark, folder), FACT_TAGS)


def filings(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned table with a row per filing."""
    return cleaning.clean(latest_facts(spark, folder), macro(spark, folder), FACT_TAGS, grain="filing")


def firm_panel(spark: SparkSession, folder: str) -> DataFrame:
    return panel.build_panel(cleaned(spark, folder))


def labeled_panel(spark: SparkSession, folder: str, keep_signals: bool = False) -> DataFrame:
    return panel.label(firm_panel(spark, folder), keep_signals=keep_signals)


def ratio_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Columns of the panel's ratios and sectors as a stored table, because fitting quantiles reads it once a pass."""
    view = features.add_ratios(features.statement_view(labeled_panel(spark, folder))).withColumn("sector_proxy", features.sector_proxy())
    return materialise(view.select(*columns))


def engineered(spark: SparkSession, folder: str) -> DataFrame:
    """Features over the labeled panel, which is a stored table between the two stages."""
    return features.engineer(materialise(labeled_panel(spark, folder)))


def scores(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "o_orderkey",
        zero_pad(F.col("o_custkey")).alias("firm_id"),
        F.year("o_orderdate").alias("fiscal_year"),
        Q.period_of(F.col("o_orderdate")).alias("fiscal_period"),
        F.col("o_orderdate").alias("scored_date"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.col("o_orderpriority").alias("priority"),
        F.least(F.col("o_totalprice") / 500000.0, F.lit(1.0)).alias("score"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )


def companies(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary of all customers; other firms, such as suppliers, are not in it."""
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    return customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"]).select(
        zero_pad(F.col("c_custkey")).alias("firm_id"),
        F.when(F.col("n_nationkey") != 3, F.col("n_name")).otherwise("").alias("ticker"),
        F.col("c_name").alias("name"),
    )


def looked_up(spark: SparkSession, folder: str) -> DataFrame:
    """Firm ids that lookups are asked for: those of the scores, and for every seventh order one with the order's own number, which no
    customer has."""
    own = F.concat(F.lit("9"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    return scores(spark, folder).select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, own).otherwise(F.col("firm_id")).alias("firm_id"), "score")


def raw_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The facts as text, as they come: unpadded ids, names in other cases, years as decimals, codes in small letters, dates that are none."""
    f = facts(spark, folder)
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    year = F.col("fiscal_year").cast("string")
    return f.select(
        F.col("firm_id").cast("bigint").cast("string").alias(" CIK"),
        F.when(order % 53 == 0, "none").when(order % 59 == 0, "1889").when(line == 2, F.concat(year, F.lit(".0"))).otherwise(year).alias("Fiscal_Year"),
        F.when(order % 61 == 0, "h1").when(line == 1, F.concat(F.lit(" "), F.lower("fiscal_period"))).otherwise(F.col("fiscal_period")).alias("fiscal_period"),
        F.col("tag").alias("TAG"),
        F.col("value").alias("value"),
        F.when(order % 11 == 0, "soon").otherwise(F.date_format("filed_date", "yyyy-MM-dd")).alias("filed_date"),
        F.lit(None).cast("string").alias("quarter_end_date"),
        order.alias("l_orderkey"), line.alias("l_linenumber"), F.col("l_partkey"),
    )


def sparse(spark: SparkSession, folder: str) -> DataFrame:
    """Firm-quarters with gaps: order totals per customer and quarter as exact decimals."""
    orders = table(spark, folder, "orders")
    amount = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice").cast("decimal(18,2)"))
    return orders.groupBy(
        zero_pad(F.col("o_custkey")).alias("firm_id"), Q.quarter_end_of(F.col("o_orderdate")).alias("date")
    ).agg(F.sum(amount).cast("double").alias("total"))


ATTRIBUTED = ["net_income", "operating_cash_flow", "interest_expense", "total_assets", "total_liabilities", "total_equity"]


def attributions(spark: SparkSession, folder: str) -> DataFrame:
    """Wide shap_<feature> columns per firm-quarter by a fixed formula over the panel."""
    base = firm_panel(spark, folder)
    shaped = {
        "shap_net_income": F.col("net_income") / -10007.0,
        "shap_operating_cash_flow": F.col("operating_cash_flow") / -8009.0,
        "shap_interest_expense": F.col("interest_expense") / 9001.0,
        "shap_total_assets": (F.lit(40000.0) - F.col("total_assets")) / 70001.0,
        "shap_total_liabilities": (F.col("total_liabilities") - F.lit(30000.0)) / 60013.0,
        "shap_total_equity": (F.lit(20000.0) - F.col("total_equity")) / 50021.0,
    }
    return base.select("firm_id", "fiscal_year", "fiscal_period", *[v.alias(k) for k, v in shaped.items()])
