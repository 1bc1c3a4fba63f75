"""Aggregation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes, r
from quarterline.operators import profile as P
from quarterline.operators import quality as QU
from quarterline.operators import splits as SP
from quarterline.plans import cleaning, features, panel


def _wide(spark, folder):
    return cleaning.widen_statements(X.latest_facts(spark, folder), cleaning.QUARTER_KEY, X.FACT_TAGS)


@query(
    "g1_null_profile",
    ctes("wide")
    + " UNION ALL ".join(
        f"""SELECT '{t}' AS column_name, count(*) - count("{t}") AS nulls, {r(f'(count(*) - count("{t}")) / count(*)', 6)} AS null_rate, count(*) AS rows FROM wide"""
        for t in X.FACT_TAGS
    ),
)
def null_profile(spark, folder):
    return QU.null_profile(_wide(spark, folder), X.FACT_TAGS).withColumn("null_rate", F.round("null_rate", 6))


@query(
    "g2_ranges",
    ctes("wide") + " UNION ALL ".join(f"""SELECT '{t}' AS column_name, min("{t}") AS low, max("{t}") AS high FROM wide""" for t in X.FACT_TAGS),
)
def value_ranges(spark, folder):
    return QU.range_profile(_wide(spark, folder), X.FACT_TAGS)


@query("g3_distinct_counts", ctes("facts", "macro") + "SELECT 'firms' AS name, count(DISTINCT firm_id) AS distinct_values FROM facts UNION ALL SELECT 'series', count(DISTINCT series_id) FROM macro")
def distinct_counts(spark, folder):
    return P.distinct_counts({"firms": (X.facts(spark, folder), "firm_id"), "series": (X.macro(spark, folder), "series_id")})


@query(
    "g4_class_shares",
    ctes("scores") + f"SELECT label, count(*) AS rows, {r('count(*) / sum(count(*)) OVER ()', 6)} AS share FROM scores GROUP BY label",
)
def class_shares(spark, folder):
    return P.class_shares(X.scores(spark, folder), "label").withColumn("share", F.round("share", 6))


@query(
    "g5_class_weights",
    ctes("scores")
    + f"""SELECT segment, p AS n_positive, n AS n_negative, {r('coalesce(n / nullif(p, 0), 1.0)', 4)} AS scale_pos_weight,
 {r('greatest(coalesce(n / nullif(p, 0), 1.0), 1.0)', 6)} AS clamped_weight
 FROM (SELECT segment, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM scores GROUP BY segment)""",
)
def class_weights(spark, folder):
    return P.class_weight(X.scores(spark, folder), "label", ["segment"]).withColumn("clamped_weight", F.round("clamped_weight", 6))


_SPLIT = "CASE WHEN fiscal_year BETWEEN 1995 AND 1998 THEN 'train' WHEN fiscal_year = 1999 THEN 'val' WHEN fiscal_year BETWEEN 2000 AND 2001 THEN 'test' END"


@query(
    "g6_split_report",
    ctes("labeled")
    + f"""SELECT {_SPLIT} AS split, count(*) AS rows, count(*) FILTER (distress_label = 1) AS n_positive, count(*) FILTER (distress_label = 0) AS n_negative,
 {r('avg(distress_label)', 6)} AS positive_rate FROM labeled WHERE fiscal_year <> 1995 GROUP BY 1""",
)
def split_report(spark, folder):
    parts = SP.by_years(X.labeled_panel(spark, folder), X.TRAIN_YEARS, X.VALIDATION_YEARS, X.TEST_YEARS, exclude=(1995,))
    return SP.split_report(parts).withColumn("positive_rate", F.round("positive_rate", 6))


@query(
    "g7_rate_per_slice",
    ctes("features")
    + f"""SELECT company_size_bucket, sector_proxy, count(*) AS total, count(*) FILTER (distress_label = 1) AS positives, {r('avg(distress_label)', 6)} AS positive_rate
 FROM features GROUP BY ALL""",
)
def rate_per_slice(spark, folder):
    rates = P.rate_by(X.engineered(spark, folder), "distress_label", ["company_size_bucket", "sector_proxy"])
    return rates.withColumn("positive_rate", F.round("positive_rate", 6))


@query(
    "g8_rate_per_year",
    ctes("labeled")
    + f"""SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS total, count(*) FILTER (distress_label = 1) AS positives, {r('avg(distress_label)', 6)} AS positive_rate
 FROM labeled GROUP BY 1""",
)
def rate_per_year(spark, folder):
    dated = X.labeled_panel(spark, folder).withColumn("year", F.year("date"))
    return P.rate_by(dated, "distress_label", ["year"]).withColumn("positive_rate", F.round("positive_rate", 6)).orderBy("year")


_OLD = "coalesce(lead(CASE WHEN s1_neg_income THEN 1 ELSE 0 END) OVER (PARTITION BY firm_id ORDER BY date), 0)"


@query(
    "g9_rule_comparison",
    ctes("labeled", extra=f"both_rules AS (SELECT distress_label, {_OLD} AS old_label FROM labeled)")
    + " UNION ALL ".join(
        f"""SELECT '{text}' AS label_definition, count({c}) AS total_rows, count(*) FILTER ({c} = 1) AS positives, count({c}) - count(*) FILTER ({c} = 1) AS negatives,
 {r(f'count(*) FILTER ({c} = 1) / count({c})', 6)} AS positive_rate FROM both_rules"""
        for text, c in (("two consecutive losses", "old_label"), ("two of five signals", "distress_label"))
    ),
)
def rule_comparison(spark, folder):
    both = panel.two_loss_label(X.labeled_panel(spark, folder))
    old = P.label_summary(both, "distress_label_old", "two consecutive losses")
    new = P.label_summary(both, "distress_label", "two of five signals")
    return old.unionByName(new).withColumn("positive_rate", F.round("positive_rate", 6))


@query(
    "g10_signal_rates",
    ctes("signals")
    + " UNION ALL ".join(
        f"SELECT '{s}' AS signal, count(*) FILTER ({s}) AS fires, {r(f'avg(CAST({s} AS INTEGER)) * 100', 6)} AS fire_rate_pct FROM signals" for s in panel.SIGNALS
    ),
)
def signal_rates(spark, folder):
    rates = P.signal_rates(X.labeled_panel(spark, folder, keep_signals=True), panel.SIGNALS)
    return rates.withColumn("fire_rate_pct", F.round("fire_rate_pct", 6))


@query(
    "g11_signal_counts",
    ctes("signals")
    + f"""SELECT signal_count, count(*) AS firm_quarters, {r('count(*) * 100.0 / sum(count(*)) OVER ()', 6)} AS pct, signal_count >= 2 AS labeled_distressed FROM signals GROUP BY signal_count""",
)
def signal_counts(spark, folder):
    bars = P.count_histogram(X.labeled_panel(spark, folder, keep_signals=True), "signal_count")
    return bars.withColumn("pct", F.round("pct", 6))


@query(
    "g12_label_diagnostics",
    ctes("labeled") + f"SELECT {r('avg(distress_label)', 6)} AS positive_rate, avg(distress_label) < 0.01 AS below_minimum FROM labeled",
)
def label_diagnostics(spark, folder):
    row = X.labeled_panel(spark, folder).agg(F.avg("distress_label").alias("rate"))
    return row.select(F.round("rate", 6).alias("positive_rate"), (F.col("rate") < 0.01).alias("below_minimum"))


@query(
    "g13_score_summary",
    ctes("scores")
    + f"SELECT count(score) AS rows, {r('avg(score)', 6)} AS mean, count(*) FILTER (score >= 0.7) AS high_risk, {r('quantile_cont(score, 0.5)', 6)} AS median FROM scores",
)
def score_summary(spark, folder):
    row = P.score_summary(X.scores(spark, folder), "score")
    return row.select("rows", F.round("mean", 6).alias("mean"), "high_risk", F.round("median", 6).alias("median"))


_BIN = "CAST(least(floor(({v} - lo) / (hi - lo) * {n}), {m}) AS INTEGER)"


@query(
    "g13_score_histogram",
    ctes("scores")
    + f"""SELECT 'score' AS feature, {_BIN.format(v='score', n=50, m=49)} AS bin, count(*) AS rows
 FROM scores, (SELECT min(score) AS lo, max(score) AS hi FROM scores) GROUP BY 2""",
)
def score_histogram(spark, folder):
    return P.histograms(X.scores(spark, folder), ["score"], 50)


@query(
    "g15_identity_share",
    ctes("clean")
    + f"""SELECT {r('avg(CASE WHEN abs("Assets" - ("Liabilities" + "StockholdersEquity")) <= 1.0 + 1e-5 * abs("Liabilities" + "StockholdersEquity") THEN 1 ELSE 0 END)', 6)} AS share FROM clean""",
)
def identity_share(spark, folder):
    return X.cleaned(spark, folder).agg(F.round(QU.identity_share(), 6).alias("share"))


_CORR = features.feature_names()


def _pairs(apart: bool):
    return [(a, b) for i, a in enumerate(_CORR) for b in _CORR[i + (1 if apart else 0):]]


def _corr_sql(apart: bool):
    return " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS correlation FROM features" for a, b in _pairs(apart))


@query("g16_correlations", ctes("features") + f"SELECT feature_a, feature_b, {r('correlation', 6)} AS correlation FROM ({_corr_sql(False)})")
def correlations(spark, folder):
    return P.correlations(X.engineered(spark, folder), _CORR).withColumn("correlation", F.round("correlation", 6))


@query(
    "g17_strongest_pairs",
    ctes("features")
    + f"SELECT feature_a, feature_b, {r('correlation', 6)} AS correlation FROM ({_corr_sql(True)}) ORDER BY abs(correlation) DESC, feature_a, feature_b LIMIT 20",
)
def strongest(spark, folder):
    top = P.strongest_pairs(P.correlations(X.engineered(spark, folder), _CORR))
    return top.withColumn("correlation", F.round("correlation", 6))


_HIST = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "g18_histograms",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_BIN.format(v=c, n=30, m=29)} AS bin, count(*) AS rows FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY 2"
        for c in _HIST
    ),
)
def histograms(spark, folder):
    return P.histograms(X.table(spark, folder, "lineitem"), _HIST, 30)


def _five_sql(table, group, columns):
    return " UNION ALL ".join(
        f"SELECT {group}, '{c}' AS feature, "
        + ", ".join(f"{r(f'quantile_cont({c}, {p})', 4)} AS {n}" for n, p in P.FIVE_NUMBERS.items())
        + f" FROM {table} WHERE {c} IS NOT NULL GROUP BY {group}"
        for c in columns
    )


@query("g19_five_numbers_by_sector", ctes("features") + _five_sql("features", "sector_proxy", features.RATIOS))
def five_by_sector(spark, folder):
    view = X.ratio_rows(spark, folder, "sector_proxy", *features.RATIOS)
    five = P.five_numbers(view, features.RATIOS, ["sector_proxy"])
    return five.withColumns({n: F.round(n, 4) for n in P.FIVE_NUMBERS})


@query("g19_five_numbers_lineitem", _five_sql("lineitem", "l_returnflag", _HIST))
def five_lineitem(spark, folder):
    five = P.five_numbers(X.table(spark, folder, "lineitem"), _HIST, ["l_returnflag"])
    return five.withColumns({n: F.round(n, 4) for n in P.FIVE_NUMBERS})


@query(
    "g20_distribution_by_group",
    ctes("features")
    + " UNION ALL ".join(
        f"SELECT company_size_bucket, '{c}' AS feature, {_BIN.format(v=c, n=20, m=19)} AS bin, count(*) AS rows FROM features, (SELECT min({c}) AS lo, max({c}) AS hi FROM features) WHERE {c} IS NOT NULL GROUP BY 1, 3"
        for c in ("roa", "debt_to_assets")
    ),
)
def distribution_by_group(spark, folder):
    return P.histograms(X.engineered(spark, folder), ["roa", "debt_to_assets"], 20, ["company_size_bucket"])


@query(
    "g21_widest_columns",
    ctes("features")
    + f"SELECT feature, {r('variance', 3)} AS variance FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, var_samp({c}) AS variance FROM features" for c in features.RATIOS)
    + ") ORDER BY variance DESC, feature LIMIT 6",
)
def widest(spark, folder):
    view = features.add_ratios(features.statement_view(X.labeled_panel(spark, folder)))
    return P.widest_columns(view, features.RATIOS).withColumn("variance", F.round("variance", 3))


@query(
    "g21_row_sample",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey LIMIT 500",
)
def row_sample(spark, folder):
    return P.row_sample(X.table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query(
    "g22_means_by_label",
    ctes("features")
    + " UNION ALL ".join(f"SELECT distress_label, '{c}' AS feature, {r(f'avg({c})', 4)} AS mean FROM features GROUP BY distress_label" for c in features.KEY_FEATURES),
)
def means_by_label(spark, folder):
    means = P.means_by(X.engineered(spark, folder), features.KEY_FEATURES, "distress_label")
    return means.withColumn("mean", F.round("mean", 4))


@query("g23_freshness", ctes("scores") + "SELECT max(fiscal_year) AS latest_year, count(*) AS rows, count(*) FILTER (score IS NULL) AS null_scores FROM scores")
def freshness(spark, folder):
    return P.freshness(X.scores(spark, folder), "fiscal_year", "score")


@query("g24_firm_list", ctes("scores") + "SELECT DISTINCT firm_id FROM scores")
def firm_list(spark, folder):
    return X.scores(spark, folder).select("firm_id").distinct().orderBy("firm_id")


@query(
    "g25_missing_matrix",
    ctes("wide") + "SELECT firm_id, fiscal_year, fiscal_period, " + ", ".join(f'CASE WHEN "{t}" IS NULL THEN 1 ELSE 0 END AS "{t}"' for t in X.FACT_TAGS) + " FROM wide",
)
def missing_matrix(spark, folder):
    return P.missing_matrix(_wide(spark, folder), cleaning.QUARTER_KEY, X.FACT_TAGS)


@query(
    "g25_missing_columns",
    ctes("wide")
    + "SELECT * FROM ("
    + " UNION ALL ".join(f"""SELECT '{t}' AS column_name, {r(f'(count(*) - count("{t}")) * 100.0 / count(*)', 4)} AS null_pct FROM wide""" for t in X.FACT_TAGS)
    + ") WHERE null_pct > 0",
)
def missing_columns(spark, folder):
    nulls = QU.null_profile(_wide(spark, folder), X.FACT_TAGS)
    return nulls.where("nulls > 0").select("column_name", F.round(F.col("null_rate") * 100.0, 4).alias("null_pct")).orderBy(F.col("null_pct").desc())

