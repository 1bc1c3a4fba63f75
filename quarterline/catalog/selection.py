"""Deduplication, row selection, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import FISCAL, ctes, quarter_end_of, r
from quarterline.functions import quarters as Q
from quarterline.operators import dedup as D
from quarterline.operators import joins as J
from quarterline.operators import lookups as L
from quarterline.plans import cleaning


@query("d1_keep_latest", ctes("latest") + "SELECT firm_id, fiscal_year, fiscal_period, tag, value, filed_date FROM latest")
def keep_latest(spark, folder):
    return X.latest_facts(spark, folder).select("firm_id", "fiscal_year", "fiscal_period", "tag", "value", "filed_date")


@query(
    "d2_last_observation",
    ctes("macro")
    + f"""SELECT series_id, date, value FROM (SELECT series_id, {quarter_end_of('date')} AS date, value,
 row_number() OVER (PARTITION BY series_id, {quarter_end_of('date')} ORDER BY o_orderkey DESC) AS rn FROM macro) WHERE rn = 1""",
)
def last_observation(spark, folder):
    return cleaning.typed_series(X.macro(spark, folder), ["o_orderkey"]).select("series_id", "date", "value")


@query(
    "d3_one_per_date",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def one_per_date(spark, folder):
    kept = D.top_rows(X.table(spark, folder, "orders"), ["o_custkey", "o_orderdate"], [F.col("o_orderkey").asc()])
    return kept.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")


@query(
    "d4_newer_source_wins",
    ctes("scores")
    + """SELECT firm_id, fiscal_year, fiscal_period, score FROM (SELECT *, row_number() OVER (PARTITION BY firm_id, fiscal_year, fiscal_period
 ORDER BY CASE WHEN label = 1 THEN 1 ELSE 0 END DESC, o_orderkey DESC) AS rn FROM scores) WHERE rn = 1""",
)
def newer_source(spark, folder):
    rows = X.scores(spark, folder)
    old, new = rows.where(F.col("label") == 0), rows.where(F.col("label") == 1)
    merged = D.keep_newer_source(old, new, L.QUARTER, ["o_orderkey"])
    return merged.select(*L.QUARTER, "score")


@query(
    "d5_best_per_firm",
    ctes("scores") + "SELECT firm_id, o_orderkey, score FROM (SELECT *, row_number() OVER (PARTITION BY firm_id ORDER BY score DESC, o_orderkey) AS rn FROM scores) WHERE rn = 1",
)
def best_per_firm(spark, folder):
    return L.best_per_firm(X.scores(spark, folder), "score", ["o_orderkey"]).select("firm_id", "o_orderkey", "score")


@query("d6_best_per_quarter", ctes("qscores") + "SELECT firm_id, fiscal_year, fiscal_period, o_orderkey, score FROM qscores")
def best_per_quarter(spark, folder):
    return L.best_per_quarter(X.scores(spark, folder), "score", ["o_orderkey"]).select(*L.QUARTER, "o_orderkey", "score")


_NEWEST = "PARTITION BY firm_id ORDER BY fiscal_year DESC, fiscal_period DESC, o_orderkey DESC"


def _ranked(condition):
    return ctes("scores") + f"SELECT firm_id, o_orderkey, score FROM (SELECT *, row_number() OVER ({_NEWEST}) AS rn FROM scores) WHERE {condition}"


@query("d7_latest_per_firm", _ranked("rn = 1"))
def latest_per_firm(spark, folder):
    return L.latest_per_firm(X.scores(spark, folder), 1, ["o_orderkey"]).select("firm_id", "o_orderkey", "score")


@query("d8_second_latest", _ranked("rn = 2"))
def second_latest(spark, folder):
    return L.nth_latest(X.scores(spark, folder), 2, ["o_orderkey"]).select("firm_id", "o_orderkey", "score")


@query("d9_last_eight", _ranked("rn <= 8"))
def last_eight(spark, folder):
    return L.latest_per_firm(X.scores(spark, folder), 8, ["o_orderkey"]).select("firm_id", "o_orderkey", "score")


@query(
    "d10_last_periods",
    ctes("scores")
    + """SELECT DISTINCT firm_id, fiscal_year, fiscal_period FROM (SELECT *, dense_rank() OVER (PARTITION BY firm_id ORDER BY fiscal_year DESC, fiscal_period DESC) AS rn FROM scores) WHERE rn <= 8""",
)
def last_periods(spark, folder):
    return D.last_periods(X.scores(spark, folder), ["firm_id"], ["fiscal_year", "fiscal_period"])


@query("d11_duplicate_count", "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def duplicate_count(spark, folder):
    return D.duplicate_count(X.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("d12_top_k", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 20")
def top_k(spark, folder):
    line = X.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return line.orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey").limit(20)


@query(
    "j1_facts_macro",
    ctes("latest", "macro_wide")
    + """SELECT firm_id, quarter_key, tag, value, "FedFundsRate", "CPI" FROM (SELECT *, CAST(fiscal_year AS VARCHAR) || '_' || fiscal_period AS quarter_key FROM latest)
 LEFT JOIN macro_wide USING (quarter_key)""",
)
def facts_macro(spark, folder):
    keyed = X.latest_facts(spark, folder).withColumn("quarter_key", Q.quarter_key(F.col("fiscal_year"), F.col("fiscal_period")))
    joined = cleaning.join_macro(keyed, cleaning.widen_macro(X.macro(spark, folder)))
    return joined.select("firm_id", "quarter_key", "tag", "value", "FedFundsRate", "CPI")


_FILING_COLUMNS = "firm_id, quarter_key, filed_date, end_date, \"Assets\", \"Liabilities\", \"StockholdersEquity\", \"NetIncomeLoss\", \"FedFundsRate\", \"CPI\""


@query("j1_filing_grain", ctes("clean_filings") + f"SELECT {_FILING_COLUMNS} FROM clean_filings")
def filing_grain(spark, folder):
    """The cleaned table with a row for each filing of a quarter, each with the macro values of its quarter or the nearest filing's."""
    return X.filings(spark, folder).selectExpr(*_FILING_COLUMNS.replace('"', "`").split(", "))


@query(
    "j2_quarter_join",
    ctes("macro")
    + f"""SELECT l.l_suppkey, m.series_id, count(*) AS pairs FROM (SELECT l_suppkey, max(l_shipdate) AS filed FROM lineitem GROUP BY l_suppkey, date_trunc('quarter', l_shipdate)) l
 LEFT JOIN (SELECT series_id, {quarter_end_of('date')} AS observed FROM macro GROUP BY ALL) m ON date_trunc('quarter', l.filed) = date_trunc('quarter', m.observed)
 GROUP BY ALL""",
)
def quarter_join(spark, folder):
    line = X.table(spark, folder, "lineitem")
    filings = line.groupBy("l_suppkey", F.date_trunc("QUARTER", "l_shipdate").alias("_q")).agg(F.max("l_shipdate").alias("filed")).drop("_q")
    indicators = X.macro(spark, folder).select("series_id", Q.quarter_end_of(F.col("date")).alias("observed")).distinct()
    joined = J.by_quarter(filings, "filed", indicators, "observed")
    return joined.groupBy("l_suppkey", "series_id").agg(F.count(F.lit(1)).alias("pairs"))


@query(
    "j3_attach_attributions",
    ctes("attr", "labeled")
    + f"""SELECT l.firm_id, l.quarter_key, l.distress_label, {r('a.shap_net_income', 6)} AS shap_net_income, CAST(NULL AS VARCHAR) AS top_features_json
 FROM labeled l LEFT JOIN attr a USING (firm_id, fiscal_year, fiscal_period)""",
)
def attach(spark, folder):
    labeled = X.labeled_panel(spark, folder).select(*L.QUARTER, "quarter_key", "distress_label")
    extra = X.attributions(spark, folder)
    joined = J.attach(J.attach(labeled, extra, L.QUARTER, ["shap_net_income"]), None, L.QUARTER, ["top_features_json"])
    return joined.select("firm_id", "quarter_key", "distress_label", F.round("shap_net_income", 6).alias("shap_net_income"), "top_features_json")


@query(
    "j4_latest_previous",
    ctes("qscores", "companies")
    + f"""SELECT firm_id, score AS latest_score, prev_score FROM (SELECT *, lag(score) OVER ({FISCAL}) AS prev_score,
 row_number() OVER (PARTITION BY firm_id ORDER BY fiscal_year DESC, fiscal_period DESC) AS rn FROM qscores) WHERE rn = 1""",
)
def latest_previous(spark, folder):
    rows = L.best_per_quarter(X.scores(spark, folder), "score", ["o_orderkey"]).select(*L.QUARTER, "score")
    latest = L.latest_per_firm(rows).select("firm_id", F.col("score").alias("latest_score"))
    previous = L.nth_latest(rows, 2).select("firm_id", F.col("score").alias("prev_score"))
    return latest.join(previous, "firm_id", "left")


@query(
    "j5_dictionary_lookup",
    ctes("looked_up", "companies")
    + "SELECT o_orderkey, coalesce(name, '—') AS company, coalesce(ticker, '—') AS ticker FROM looked_up LEFT JOIN companies USING (firm_id)",
)
def dictionary(spark, folder):
    joined = X.looked_up(spark, folder).join(X.companies(spark, folder), "firm_id", "left")
    return joined.select("o_orderkey", F.coalesce("name", F.lit("—")).alias("company"), F.coalesce("ticker", F.lit("—")).alias("ticker"))


@query(
    "j6_semi_anti",
    ctes("looked_up", "companies")
    + """SELECT o_orderkey, 'known' AS kind FROM looked_up WHERE firm_id IN (SELECT firm_id FROM companies)
 UNION ALL SELECT o_orderkey, 'unknown' FROM looked_up WHERE firm_id NOT IN (SELECT firm_id FROM companies)""",
)
def semi_anti(spark, folder):
    rows, known = X.looked_up(spark, folder), X.companies(spark, folder)
    inside = J.in_set(rows, known, ["firm_id"]).select("o_orderkey", F.lit("known").alias("kind"))
    return inside.unionByName(J.not_in_set(rows, known, ["firm_id"]).select("o_orderkey", F.lit("unknown").alias("kind")))


@query(
    "j9_key_overlap",
    ctes("scores") + "SELECT count(*) AS shared FROM (SELECT firm_id FROM scores WHERE fiscal_year < 1998 INTERSECT SELECT firm_id FROM scores WHERE fiscal_year >= 1998)",
)
def key_overlap(spark, folder):
    rows = X.scores(spark, folder)
    shared = J.shared_keys(rows.where("fiscal_year < 1998"), rows.where("fiscal_year >= 1998"), ["firm_id"])
    return shared.agg(F.count(F.lit(1)).alias("shared"))


@query(
    "j10_stack_columns",
    """SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS supplier FROM customer
 UNION ALL SELECT s_nationkey, s_acctbal, NULL, s_name FROM supplier""",
)
def stack(spark, folder):
    left = X.table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    right = X.table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("supplier")
    )
    return J.stacked(left, right)


