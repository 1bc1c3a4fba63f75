"""Nested data and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes, quarter_end_of, r
from quarterline.functions import quarters as Q
from quarterline.operators import lookups as L
from quarterline.operators import nested as N
from quarterline.sources import tables as T

_SHAP = [f"shap_{c}" for c in X.ATTRIBUTED]


def documents(spark, folder, buckets=None):
    """Company documents (map of tags to map of units to entries), one per firm and block of a thousand orders.

    An order has a handful of lines, so no document can grow with the data, however large its firm is. With `buckets` a document comes with
    the bucket of its firm: facts are dealt by it once, as narrow rows, and their documents are made and landed where they are.
    """
    entry = F.struct(
        F.when(F.col("fiscal_period") == "Q4", "10-K").when(F.col("l_linenumber") == 7, "8-K").otherwise("10-Q").alias("form"),
        F.col("fiscal_period").alias("fp"),
        F.col("fiscal_year").cast("string").alias("fy"),
        F.col("value").cast("string").alias("val"),
        F.lit(None).cast("string").alias("start"),
        F.date_format(Q.quarter_end_of(F.col("filed_date")), "yyyy-MM-dd").alias("end"),
        F.date_format("filed_date", "yyyy-MM-dd").alias("filed"),
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string")).alias("frame"),
    )
    facts, block, keys = X.facts(spark, folder), F.floor(F.col("l_orderkey") / 1000), ["firm_id", "block"]
    if buckets:
        facts, keys = T.dealt_by_key(facts, "firm_id", block, buckets), ["bucket", "piece", *keys]
    facts = facts.withColumn("block", block)
    entries = facts.groupBy(*keys, "tag").agg(F.collect_list(entry).alias("entries"))
    body = F.struct(F.create_map(F.lit("USD"), F.col("entries")).alias("units"))
    per_firm = entries.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("tag", body))).alias("tags"))
    doc = F.to_json(F.struct(F.create_map(F.lit("us-gaap"), F.col("tags")).alias("facts")), {"ignoreNullFields": "true"})
    return per_firm.select("firm_id", doc.alias("doc"), *(["bucket"] if buckets else []))


_FORM = "CASE WHEN fiscal_period = 'Q4' THEN '10-K' WHEN l_linenumber = 7 THEN '8-K' ELSE '10-Q' END"


@query(
    "b1_flatten_facts",
    ctes("facts")
    + f"""SELECT firm_id, tag, 'USD' AS unit, value, {quarter_end_of('filed_date')} AS end_date, fiscal_year, fiscal_period, {_FORM} AS form,
 CAST(filed_date AS DATE) AS filed_date, 'L' || CAST(l_orderkey AS VARCHAR) AS frame FROM facts WHERE {_FORM} IN ('10-Q', '10-K')""",
)
def flatten_facts(spark, folder):
    return N.flatten_facts(documents(spark, folder)).drop("start_date")


def filing_documents(spark, folder):
    """Per firm and block of a thousand orders one struct of parallel arrays, as filing listings arrive."""
    rows = X.facts(spark, folder)
    item = F.struct(F.col("l_orderkey").cast("string").alias("a"), "tag", F.date_format("filed_date", "yyyy-MM-dd").alias("d"))
    listed = rows.groupBy("firm_id", F.floor(F.col("l_orderkey") / 1000).alias("block")).agg(F.collect_list(item).alias("items"))
    recent = F.struct(
        F.transform("items", lambda x: x["a"]).alias("accessionNumber"),
        F.transform("items", lambda x: x["tag"]).alias("form"),
        F.transform("items", lambda x: x["d"]).alias("filingDate"),
    )
    return listed.select("firm_id", recent.alias("recent"))


@query(
    "b2_zip_filings",
    ctes("facts")
    + """SELECT firm_id, CAST(l_orderkey AS VARCHAR) AS accession_number, tag AS form, CAST(filed_date AS DATE) AS filing_date FROM facts
 WHERE tag IN ('Assets', 'NetIncomeLoss') AND filed_date >= TIMESTAMP '1997-06-01'""",
)
def zip_filings(spark, folder):
    arrays = {"accessionNumber": "accession_number", "form": "form", "filingDate": "filing_date"}
    return N.zip_filings(filing_documents(spark, folder), ("Assets", "NetIncomeLoss"), "1997-06-01", arrays)



@query(
    "b3_observations",
    ctes("macro")
    + "SELECT series_id, CAST(date AS DATE) AS date, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value FROM macro JOIN orders USING (o_orderkey)",
)
def observations(spark, folder):
    rows = X.macro(spark, folder).join(X.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey")
    text = F.when(F.col("o_orderstatus") == "P", ".").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    listed = rows.groupBy("series_id", F.floor(F.col("o_orderkey") / 1000).alias("block")).agg(
        F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), text.alias("value"))).alias("observations")
    )
    docs = listed.select("series_id", F.to_json(F.struct("observations")).alias("doc"))
    return N.flatten_observations(docs, ["series_id"])


@query(
    "b4_series_by_date",
    ctes("macro")
    + "SELECT CAST(date AS DATE) AS date, " + ", ".join(f"max(CASE WHEN series_id = '{s}' THEN value END) AS \"{s}\"" for s in X.SERIES_OF.values())
    + " FROM macro GROUP BY 1",
)
def by_date(spark, folder):
    series = X.macro(spark, folder).withColumn("date", F.to_date("date"))
    return N.series_by_date(series, list(X.SERIES_OF.values()))


_TOP = f"""attr_long AS (SELECT firm_id, fiscal_year, fiscal_period, feature, v, row_number() OVER (PARTITION BY firm_id, fiscal_year, fiscal_period ORDER BY abs(v) DESC, feature) AS rk FROM (
 {" UNION ALL ".join(f"SELECT firm_id, fiscal_year, fiscal_period, '{c}' AS feature, shap_{c} AS v FROM attr" for c in X.ATTRIBUTED)}))"""


@query(
    "b6_top_contributions",
    ctes("attr", extra=_TOP)
    + f"SELECT firm_id, fiscal_year, fiscal_period, CAST(rk AS INTEGER) AS rank, feature, {r('v', 6)} AS shap_value FROM attr_long WHERE rk <= 3",
)
def top_contributions(spark, folder):
    wide = X.attributions(spark, folder)
    top = wide.select(*L.QUARTER, N.top_contributions(wide, _SHAP).alias("top"))
    return top.select(*L.QUARTER, F.inline("top"))


@query(
    "b5_parse_features",
    ctes("attr", extra=_TOP)
    + f"""SELECT firm_id, fiscal_year, fiscal_period, CAST(CASE WHEN fiscal_period = 'Q4' THEN 0 ELSE 3 END AS INTEGER) AS n_features,
 CASE WHEN fiscal_period <> 'Q4' THEN max(feature) FILTER (rk = 1) END AS first_feature, CASE WHEN fiscal_period <> 'Q4' THEN {r('max(v) FILTER (rk = 1)', 6)} END AS first_value FROM attr_long GROUP BY firm_id, fiscal_year, fiscal_period""",
)
def parse_features(spark, folder):
    """Round trip through JSON text, a quarter of it damaged."""
    wide = X.attributions(spark, folder)
    text = F.when(F.col("fiscal_period") == "Q4", "{broken").otherwise(N.contributions_json(wide, _SHAP, 5))
    parsed = wide.select(*L.QUARTER, L.parsed_features(text).alias("features"))
    first = F.get("features", F.lit(0))
    return parsed.select(
        *L.QUARTER, F.size("features").alias("n_features"), first["feature"].alias("first_feature"), first["shap_value"].alias("first_value")
    )


@query("b7_json_fields", "SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k, props ->> '$.missing' AS missing FROM events")
def json_fields(spark, folder):
    events = X.table(spark, folder, "events")
    parsed = F.from_json("props", "k int, missing string")
    return events.select("event_id", parsed["k"].alias("k"), parsed["missing"].alias("missing"))
