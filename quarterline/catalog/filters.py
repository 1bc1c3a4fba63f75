"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes, quarter_of
from quarterline.functions.scalars import zero_pad
from quarterline.operators import filters as FL
from quarterline.operators import joins as J
from quarterline.plans import cleaning


@query(
    "f1_codes",
    ctes("facts") + "SELECT tag, count(*) AS facts FROM facts WHERE tag IN ('Assets', 'Liabilities', 'StockholdersEquity') GROUP BY tag",
)
def codes(spark, folder):
    wanted = F.col("tag").isin("Assets", "Liabilities", "StockholdersEquity")
    return X.facts(spark, folder).where(wanted).groupBy("tag").agg(F.count(F.lit(1)).alias("facts"))


@query(
    "f2_years",
    ctes("facts") + "SELECT fiscal_year, count(*) AS facts FROM facts WHERE fiscal_year BETWEEN 1996 AND 2000 GROUP BY fiscal_year",
)
def years(spark, folder):
    return X.facts(spark, folder).where(F.col("fiscal_year").between(1996, 2000)).groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("facts"))


_DAY = "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) END"


@query(
    "f3_plausible_dates",
    f"""SELECT 'kept' AS kind, count(*) AS lines FROM lineitem WHERE {_DAY} BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
 UNION ALL SELECT 'dropped', count(*) FILTER (NOT coalesce({_DAY} BETWEEN DATE '1996-01-01' AND DATE '2000-12-31', false)) FROM lineitem""",
)
def plausible_dates(spark, folder):
    day = F.when(F.col("l_linenumber") != 7, F.to_date("l_shipdate"))
    kept, counts = FL.plausible(X.table(spark, folder, "lineitem").withColumn("day", day), "day", "1996-01-01", "2000-12-31")
    left = kept.agg(F.count(F.lit(1)).alias("lines")).select(F.lit("kept").alias("kind"), "lines")
    return left.unionByName(counts.select(F.lit("dropped").alias("kind"), F.col("dropped").alias("lines")))


@query(
    "f4_null_keys",
    ctes("wide") + 'SELECT firm_id, fiscal_year, fiscal_period, "Assets", "Liabilities" FROM wide WHERE "Assets" IS NOT NULL AND "Liabilities" IS NOT NULL',
)
def null_keys(spark, folder):
    wide = cleaning.widen_statements(X.latest_facts(spark, folder), cleaning.QUARTER_KEY, ["Assets", "Liabilities"])
    return wide.dropna(subset=["Assets", "Liabilities"])


@query(
    "f5_evaluation_window",
    ctes("scores")
    + """SELECT 'fiscal_year' AS basis, count(*) AS scores, sum(label)::BIGINT AS positives FROM scores WHERE fiscal_year BETWEEN 1998 AND 1999
 UNION ALL SELECT 'filed_date', count(*), sum(label)::BIGINT FROM scores WHERE year(scored_date) BETWEEN 1999 AND 2000
 UNION ALL SELECT 'all', count(*), sum(label)::BIGINT FROM scores""",
)
def window(spark, folder):
    rows = X.scores(spark, folder)
    dated = rows.withColumnRenamed("scored_date", "filed_date").drop("fiscal_year")
    plain = rows.drop("fiscal_year", "scored_date")

    def counts(df, basis):
        return df.agg(F.count(F.lit(1)).alias("scores"), F.sum(F.col("label").cast("bigint")).alias("positives")).select(
            F.lit(basis).alias("basis"), "scores", "positives"
        )

    return (
        counts(FL.evaluation_window(rows, 1998, 1999), "fiscal_year")
        .unionByName(counts(FL.evaluation_window(dated, 1999, 2000), "filed_date"))
        .unionByName(counts(FL.evaluation_window(plain, 1999, 2000), "all"))
    )


@query("f6_threshold", ctes("scores") + "SELECT o_orderkey, score, label FROM scores WHERE label = 1 OR score >= 0.7")
def threshold(spark, folder):
    return X.scores(spark, folder).where((F.col("label") == 1) | (F.col("score") >= 0.7)).select("o_orderkey", "score", "label")


@query(
    "f7_drop_sparse_columns",
    ctes("macro_wide") + 'SELECT quarter_key, "CPI", "FedFundsRate", "GDP", "UnemploymentRate", "VIX" FROM macro_wide',
)
def drop_sparse(spark, folder):
    return FL.drop_sparse_columns(cleaning.widen_macro(X.macro(spark, folder)), cleaning.MACRO_COLUMNS)


@query("f8_drop_uninformative", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def drop_uninformative(spark, folder):
    events = X.table(spark, folder, "events")
    padded = events.withColumns({"quality_check_flag": F.lit("Valid"), "eps_basic": F.lit(None).cast("double")})
    return FL.drop_uninformative(padded)


@query(
    "f9_active_firms",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS firm_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'failed' ELSE 'ok' END AS status, last_filed
 FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_filed FROM orders GROUP BY 1) ON o_custkey = c_custkey
 WHERE c_mktsegment = 'MACHINERY' OR CAST(last_filed AS DATE) >= DATE '2002-06-01' - INTERVAL 540 DAY""",
)
def active(spark, folder):
    from quarterline.functions.scalars import zero_pad

    firms = X.table(spark, folder, "customer").select(
        zero_pad(F.col("c_custkey")).alias("firm_id"), F.when(F.col("c_mktsegment") == "MACHINERY", "failed").otherwise("ok").alias("status")
    )
    filings = X.scores(spark, folder).select("firm_id", "scored_date")
    return FL.active_firms(firms, filings, "scored_date", F.lit("2002-06-01").cast("date"), status="status").select("firm_id", "status", "last_filed")


@query(
    "f10_universe_shards",
    """SELECT firm_id, CAST((p - 1) % 5 AS INTEGER) AS shard, p <= 500 AS in_universe, p AS position
 FROM (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS firm_id, row_number() OVER (ORDER BY lpad(CAST(c_custkey AS VARCHAR), 10, '0')) AS p FROM customer)""",
)
def shards(spark, folder):
    return FL.sharded(X.table(spark, folder, "customer").select(zero_pad(F.col("c_custkey")).alias("firm_id")), ["firm_id"], 5, 500)


@query(
    "f11_firm_lookup",
    ctes("scores")
    + f"""SELECT s.o_orderkey, s.firm_id, s.fiscal_year, s.fiscal_period, s.score FROM scores s JOIN
 (SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS firm_id, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year, {quarter_of('o_orderdate')} AS fiscal_period
  FROM orders WHERE o_orderpriority = '1-URGENT') q USING (firm_id, fiscal_year, fiscal_period)""",
)
def firm_lookup(spark, folder):
    """All scores of the firm-quarters that had an urgent order."""
    rows = X.scores(spark, folder)
    asked = rows.where(F.col("priority") == "1-URGENT").select("firm_id", "fiscal_year", "fiscal_period")
    return J.in_set(rows, asked, ["firm_id", "fiscal_year", "fiscal_period"]).select("o_orderkey", "firm_id", "fiscal_year", "fiscal_period", "score")


