"""Data quality, contracts, splits and preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes, r
from quarterline.operators import joins as J
from quarterline.operators import quality as QU
from quarterline.operators import splits as SP
from quarterline.plans import features, panel

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_BOUNDS = "bounds AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) - 0.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_lo, quantile_cont({c}, 0.75) + 0.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_hi"
    for c in _NUM
) + " FROM lineitem)"


@query(
    "q2_iqr_anomalies",
    f"""WITH {_BOUNDS}, flagged AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, list_filter([{', '.join(f"CASE WHEN {c} < {c}_lo OR {c} > {c}_hi THEN '{c}' END" for c in _NUM)}], lambda x: x IS NOT NULL) AS found FROM lineitem, bounds)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(len(found) AS INTEGER) AS anomaly_count, array_to_string(found, ',') AS anomaly_columns FROM flagged WHERE len(found) > 0""",
)
def iqr_anomalies(spark, folder):
    flagged = QU.flag_anomalies(X.table(spark, folder, "lineitem"), _NUM, factor=0.5)
    return flagged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "anomaly_count", "anomaly_columns")


_PANEL_NUM = ["current_ratio", "debt_to_equity", "interest_coverage", "net_margin", "roe"]
_PANEL_BOUNDS = "bounds AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_lo, quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_hi"
    for c in _PANEL_NUM
) + " FROM ratios)"


@query(
    "q2_panel_anomalies",
    ctes("ratios", extra=_PANEL_BOUNDS)
    + f"""SELECT firm_id, fiscal_year, fiscal_period, CAST(len(found) AS INTEGER) AS anomaly_count, array_to_string(found, ',') AS anomaly_columns FROM (
 SELECT firm_id, fiscal_year, fiscal_period, list_filter([{', '.join(f"CASE WHEN {c} < {c}_lo OR {c} > {c}_hi THEN '{c}' END" for c in _PANEL_NUM)}], lambda x: x IS NOT NULL) AS found FROM ratios, bounds) WHERE len(found) > 0""",
)
def panel_anomalies(spark, folder):
    view = X.ratio_rows(spark, folder, *features.FIRM_QUARTER, *_PANEL_NUM)
    flagged = QU.flag_anomalies(view, _PANEL_NUM)
    return flagged.select(*features.FIRM_QUARTER, "anomaly_count", "anomaly_columns")


_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_REPORT = [
    "SELECT 'status' AS section, 'fail' AS name, 1.0::DOUBLE AS value",
    "SELECT 'rows', 'row_count', count(*)::DOUBLE FROM orders",
    "SELECT 'duplicates', 'o_custkey+o_orderdate', CAST(sum(n - 1) AS DOUBLE) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate)",
    *[f"SELECT 'null_count', '{c}', CAST(count(*) - count({c}) AS DOUBLE) FROM orders" for c in _ORDERS],
    *[f"SELECT 'null_rate', '{c}', CAST((count(*) - count({c})) / count(*) AS DOUBLE) FROM orders" for c in _ORDERS],
    "SELECT 'min', 'o_totalprice', min(o_totalprice) FROM orders",
    "SELECT 'max', 'o_totalprice', max(o_totalprice) FROM orders",
    *[
        f"""SELECT 'anomalies', '{n}', CAST(count(*) AS DOUBLE) FROM orders, (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b FROM orders)
 WHERE o_totalprice < a - 1.5 * (b - a) OR o_totalprice > b + 1.5 * (b - a)"""
        for n in ("anomalous_rows", "o_totalprice")
    ],
]


@query("q4_validation_report", " UNION ALL ".join(_REPORT))
def validation_report(spark, folder):
    orders = X.table(spark, folder, "orders")
    return QU.validation_report(orders, ["o_orderkey", "filing_date"], ["o_custkey", "o_orderdate"], ["o_totalprice"])


def _parts(spark, folder, exclude=()):
    return SP.by_years(X.engineered(spark, folder), X.TRAIN_YEARS, X.VALIDATION_YEARS, X.TEST_YEARS, exclude)


_SPLIT = "CASE WHEN fiscal_year BETWEEN 1995 AND 1998 THEN 'train' WHEN fiscal_year = 1999 THEN 'val' WHEN fiscal_year BETWEEN 2000 AND 2001 THEN 'test' END"


@query(
    "q5_temporal_leakage",
    ctes("labeled")
    + f"""SELECT max(fiscal_year) FILTER (split = 'train') AS max_train, min(fiscal_year) FILTER (split = 'val') AS min_val, max(fiscal_year) FILTER (split = 'val') AS max_val,
 min(fiscal_year) FILTER (split = 'test') AS min_test, false AS leaks FROM (SELECT *, {_SPLIT} AS split FROM labeled)""",
)
def temporal_leakage(spark, folder):
    parts = SP.by_years(X.labeled_panel(spark, folder), X.TRAIN_YEARS, X.VALIDATION_YEARS, X.TEST_YEARS)
    return SP.leakage(SP.require_no_leakage(parts))


_STRATA = f"""strata AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY raw_key) < 50 THEN 'other' ELSE raw_key END AS _strat_key
 FROM (SELECT *, company_size_bucket || '__' || sector_proxy AS raw_key, {_SPLIT} AS split FROM features))"""


@query(
    "q6_strata_coverage",
    ctes("features")
    + f""", keyed AS (SELECT company_size_bucket || '_' || sector_proxy || '_' || firm_id AS stratum, {_SPLIT} AS split FROM features)
 SELECT t.stratum, s.split FROM (SELECT DISTINCT stratum FROM keyed WHERE split = 'train') t, (SELECT unnest(['val', 'test']) AS split) s
 WHERE NOT EXISTS (SELECT 1 FROM keyed k WHERE k.stratum = t.stratum AND k.split = s.split)""",
)
def strata_coverage(spark, folder):
    keyed = _parts(spark, folder).select(F.concat_ws("_", "company_size_bucket", "sector_proxy", "firm_id").alias("stratum"), "split")
    return J.missing_strata(keyed, "split", "stratum", ("train", "val", "test"))


@query("q1_required_columns", ctes("clean") + 'SELECT firm_id, fiscal_year, fiscal_period, "Assets", "Liabilities" FROM clean')
def required_columns(spark, folder):
    names = ["firm_id", "fiscal_year", "fiscal_period", "Assets", "Liabilities"]
    return panel.require_columns(X.cleaned(spark, folder), names).select(*names)


@query("l6_without_label", ctes("scores") + "SELECT o_orderkey, firm_id, score FROM scores")
def without_label(spark, folder):
    inputs, _ = SP.without_label(X.scores(spark, folder).select("o_orderkey", "firm_id", "score", "label"), "label")
    return inputs


@query(
    "q7_input_findings",
    """SELECT 'identity column fiscal_period is absent' AS error
 UNION ALL SELECT 'feature o_orderpriority holds text, rows: ' || count(*) FROM orders WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS DOUBLE) IS NULL HAVING count(*) > 0
 UNION ALL SELECT 'feature eps has no value, rows: ' || count(*) FROM orders""",
)
def input_findings(spark, folder):
    orders = X.table(spark, folder, "orders")
    shaped = orders.select(
        F.col("o_custkey").alias("firm_id"),
        F.year("o_orderdate").alias("fiscal_year"),
        "o_totalprice",
        "o_orderpriority",
        F.lit(None).cast("double").alias("eps"),
    )
    return QU.input_findings(shaped, ["firm_id", "fiscal_year", "fiscal_period"])


def scored_table(spark, folder):
    rows = X.scores(spark, folder)
    return rows.select(
        "o_orderkey",
        "firm_id",
        (F.col("score") * 1.1).alias("distress_probability"),
        F.when(F.col("label") == 1, "v3").alias("model_version"),
        F.lit("run-7").alias("mlflow_run_id"),
        (F.col("score") - 0.05).alias("confidence_interval_lower"),
        (F.col("score") + 0.05).alias("confidence_interval_upper"),
        F.lit(0.97).alias("model_roc_auc"),
    )


@query(
    "q8_output_findings",
    ctes("scores")
    + """SELECT 'score column scored_at is absent' AS error
 UNION ALL SELECT 'distress_probability is not in [0, 1], rows: ' || count(*) FROM scores WHERE score * 1.1 > 1 HAVING count(*) > 0
 UNION ALL SELECT 'model_version is null, rows: ' || count(*) FROM scores WHERE label IS DISTINCT FROM 1 HAVING count(*) > 0""",
)
def output_findings(spark, folder):
    return QU.output_findings(scored_table(spark, folder))


@query(
    "q9_row_contract",
    ctes("scores")
    + """SELECT 'distress_probability in [0, 1]' AS rule, count(*) AS rows FROM scores WHERE score * 1.1 > 1
 UNION ALL SELECT 'model_version looks like v1', count(*) FROM scores WHERE label <> 1
 UNION ALL SELECT 'confidence_interval_lower in [0, 1]', count(*) FROM scores WHERE NOT (score - 0.05 BETWEEN 0 AND 1)
 UNION ALL SELECT 'confidence_interval_upper in [0, 1]', count(*) FROM scores WHERE NOT (score + 0.05 BETWEEN 0 AND 1)""",
)
def row_contract(spark, folder):
    rows = scored_table(spark, folder)
    return QU.findings(rows, QU.score_rules(rows.columns))


@query(
    "q11_expectations",
    ctes("clean")
    + """SELECT 'at least 1000 rows' AS expectation, count(*)::DOUBLE AS value, count(*) >= 1000 AS passed FROM clean
 UNION ALL SELECT 'identity share above 0.2', round(v, 6), v > 0.2 FROM (SELECT avg(CASE WHEN abs("Assets" - ("Liabilities" + "StockholdersEquity")) <= 1.0 + 1e-5 * abs("Liabilities" + "StockholdersEquity") THEN 1 ELSE 0 END) AS v FROM clean)
 UNION ALL SELECT 'no nulls in core columns', count(*)::DOUBLE, count(*) = 0 FROM clean WHERE "Assets" IS NULL OR "Liabilities" IS NULL OR "StockholdersEquity" IS NULL
 UNION ALL SELECT 'fewer than 200 nulls in CPI', count(*)::DOUBLE, count(*) < 200 FROM clean WHERE "CPI" IS NULL""",
)
def expectations(spark, folder):
    c = F.col
    row = X.cleaned(spark, folder).agg(
        F.count(F.lit(1)).alias("n"),
        QU.identity_share().alias("share"),
        F.count_if(c("Assets").isNull() | c("Liabilities").isNull() | c("StockholdersEquity").isNull()).alias("core"),
        F.count_if(c("CPI").isNull()).alias("macro"),
    )
    entries = [
        ("at least 1000 rows", c("n").cast("double"), c("n") >= 1000),
        ("identity share above 0.2", F.round("share", 6), c("share") > 0.2),
        ("no nulls in core columns", c("core").cast("double"), c("core") == 0),
        ("fewer than 200 nulls in CPI", c("macro").cast("double"), c("macro") < 200),
    ]
    rows = F.array(*[F.struct(F.lit(t).alias("expectation"), v.alias("value"), p.alias("passed")) for t, v, p in entries])
    return row.select(F.inline(rows))


_OLD = "coalesce(lead(CASE WHEN s1_neg_income THEN 1 ELSE 0 END) OVER (PARTITION BY firm_id ORDER BY date), 0)"


@query(
    "q12_label_readiness",
    ctes("labeled", extra=f"both_rules AS (SELECT distress_label, {_OLD} AS old_label FROM labeled)")
    + """SELECT 'positive rate at least 1%' AS check_name, CASE WHEN avg(distress_label) >= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status FROM both_rules
 UNION ALL SELECT 'new rule finds at least as many', CASE WHEN sum(distress_label) >= sum(old_label) THEN 'PASS' ELSE 'WARN' END FROM both_rules""",
)
def label_readiness(spark, folder):
    both = panel.two_loss_label(X.labeled_panel(spark, folder))
    row = both.agg(F.avg("distress_label").alias("rate"), F.sum("distress_label").alias("new"), F.sum("distress_label_old").alias("old"))
    entries = F.array(
        F.struct(F.lit("positive rate at least 1%").alias("check_name"), F.when(F.col("rate") >= 0.01, "PASS").otherwise("FAIL").alias("status")),
        F.struct(F.lit("new rule finds at least as many").alias("check_name"), F.when(F.col("new") >= F.col("old"), "PASS").otherwise("WARN").alias("status")),
    )
    return row.select(F.inline(entries))


@query("l1_strata", ctes("features", extra=_STRATA) + "SELECT firm_id, fiscal_year, fiscal_period, _strat_key FROM strata")
def strata(spark, folder):
    keyed = SP.with_strata(X.engineered(spark, folder), ["company_size_bucket", "sector_proxy"], 50)
    return keyed.select(*features.FIRM_QUARTER, "_strat_key")


@query(
    "l2_split_by_years",
    ctes("labeled") + f"SELECT firm_id, fiscal_year, fiscal_period, {_SPLIT} AS split FROM labeled WHERE fiscal_year <> 1995 AND {_SPLIT} IS NOT NULL",
)
def split_by_years(spark, folder):
    parts = SP.by_years(X.labeled_panel(spark, folder), X.TRAIN_YEARS, X.VALIDATION_YEARS, X.TEST_YEARS, exclude=(1995,))
    return parts.select(*features.FIRM_QUARTER, "split")


_SCALED = ["current_ratio", "debt_to_assets", "net_margin", "roa", "asset_turnover"]


@query(
    "l3_scale",
    ctes("ratios")
    + ", fit AS (SELECT "
    + ", ".join(f"median({c}) AS med_{c}" for c in _SCALED)
    + " FROM ratios WHERE fiscal_year BETWEEN 1995 AND 1998), fit2 AS (SELECT "
    + ", ".join(f"avg(coalesce({c}, med_{c})) AS m_{c}, stddev_pop(coalesce({c}, med_{c})) AS s_{c}" for c in _SCALED)
    + f" FROM ratios, fit WHERE fiscal_year BETWEEN 1995 AND 1998) SELECT firm_id, fiscal_year, fiscal_period, {_SPLIT} AS split, "
    + ", ".join(r(f"(coalesce({c}, med_{c}) - m_{c}) / s_{c}") + f" AS {c}" for c in _SCALED)
    + f" FROM ratios, fit, fit2 WHERE {_SPLIT} IS NOT NULL",
)
def scale(spark, folder):
    view = X.ratio_rows(spark, folder, *features.FIRM_QUARTER, *_SCALED)
    parts = SP.by_years(view, X.TRAIN_YEARS, X.VALIDATION_YEARS, X.TEST_YEARS)
    fitted = SP.fit_scaler(parts.where("split = 'train'"), _SCALED)
    scaled = SP.apply_scaler(parts, fitted)
    return scaled.select(*features.FIRM_QUARTER, "split", *[F.round(c, 4).alias(c) for c in _SCALED])


@query(
    "l4_feature_list",
    ctes("features")
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS present FROM features" for c in [*features.feature_names(), *features.MACRO_INPUTS]),
)
def feature_list(spark, folder):
    """Numeric features of the engineered table with their non-null counts."""
    rows = X.engineered(spark, folder)
    names = [c for c in SP.feature_columns(rows) if c not in features.STATEMENT_COLUMNS]
    return rows.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "present")

