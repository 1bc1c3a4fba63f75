"""Decisions over run histories; the history is one metrics row per customer nation of the score table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.evaluation import auc_sql
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes, r
from quarterline.operators import metrics as M
from quarterline.operators import runs as RU
from quarterline.operators.reshape import lengthen

# The raw areas sit near one half; shifted they spread over the gates.
_SHIFT = 0.33


def run_history(spark, folder):
    table = M.metric_table(X.scores(spark, folder), ["nation"], ["o_orderkey"], 0.6)
    return table.select(
        F.col("nation").alias("run_id"),
        F.round(F.col("roc_auc") + _SHIFT, 6).alias("test_roc_auc"),
        F.round("brier_score", 6).alias("test_brier_score"),
        (F.col("nation") % 3).alias("depth"),
        (F.col("nation") % 5).alias("rate_step"),
        F.col("sample_count"),
    )


_RUNS = f"""runs AS (SELECT nation AS run_id, {r(f'roc_auc + {_SHIFT}', 6)} AS test_roc_auc, {r('brier', 6)} AS test_brier_score, CAST(nation % 3 AS INTEGER) AS depth, CAST(nation % 5 AS INTEGER) AS rate_step, sample_count
 FROM ({auc_sql('scores', 'nation')}) JOIN (SELECT nation, avg(pow(score - label, 2)) AS brier, count(*) AS sample_count FROM scores GROUP BY nation) USING (nation))"""


@query(
    "m8_quality_gate",
    ctes("scores", extra=_RUNS)
    + "SELECT run_id, test_roc_auc, CASE WHEN test_roc_auc < 0.80 THEN 'block' WHEN test_roc_auc < 0.85 THEN 'warn' ELSE 'pass' END AS gate FROM runs",
)
def quality_gate(spark, folder):
    return run_history(spark, folder).select("run_id", "test_roc_auc", RU.gate(F.col("test_roc_auc")).alias("gate"))


@query(
    "m9_promotion",
    ctes("scores", extra=_RUNS)
    + """SELECT run_id, test_roc_auc, production_auc, CASE WHEN test_roc_auc < 0.80 THEN 'rejected' WHEN production_auc IS NOT NULL AND test_roc_auc < production_auc - 0.02 THEN 'staged' ELSE 'promoted' END AS decision
 FROM (SELECT *, lag(test_roc_auc) OVER (ORDER BY run_id) AS production_auc FROM runs)""",
)
def promotion(spark, folder):
    """Each run against the one before it as the production model."""
    runs = run_history(spark, folder)
    before = runs.select((F.col("run_id") + 1).alias("run_id"), F.col("test_roc_auc").alias("production_auc"))
    both = runs.join(before, "run_id", "left")
    decision = RU.promotion(F.col("test_roc_auc"), F.col("production_auc"), F.lit(False))
    return both.select("run_id", "test_roc_auc", "production_auc", decision.alias("decision"))


@query(
    "m10_run_order",
    ctes("scores", extra=_RUNS) + "SELECT run_id, test_roc_auc, row_number() OVER (ORDER BY test_roc_auc DESC, run_id) AS trial_index FROM runs",
)
def run_order(spark, folder):
    ordered = RU.run_order(run_history(spark, folder), [F.col("test_roc_auc").desc(), F.col("run_id")])
    return ordered.select("run_id", "test_roc_auc", "trial_index")


@query(
    "m11_best_runs",
    ctes("scores", extra=_RUNS) + "SELECT run_id, test_roc_auc, test_brier_score FROM runs ORDER BY test_roc_auc DESC, run_id LIMIT 10",
)
def best_runs(spark, folder):
    candidates = ["val_roc_auc", "test_roc_auc", "test_f1_at_tuned_threshold"]
    return RU.best_runs(run_history(spark, folder), candidates, ["run_id"], ["test_brier_score", "test_precision_at_5pct"])


@query(
    "m12_consistency",
    ctes("scores")
    + f"""SELECT segment, a AS left_value, b AS right_value, coalesce(abs(a - b) < 0.005, false) AS consistent FROM
 (SELECT segment, {r('avg(score)', 6)} AS a FROM scores WHERE fiscal_year < 1999 GROUP BY segment) FULL JOIN (SELECT segment, {r('avg(score)', 6)} AS b FROM scores WHERE fiscal_year >= 1999 GROUP BY segment) USING (segment)""",
)
def consistency(spark, folder):
    rows = X.scores(spark, folder)

    def means(df):
        return df.groupBy("segment").agg(F.round(F.avg("score"), 6).alias("mean"))

    return RU.consistency(means(rows.where("fiscal_year < 1999")), means(rows.where("fiscal_year >= 1999")), "segment", "mean", 0.005)


@query(
    "m13_sensitivity",
    ctes("scores", extra=_RUNS)
    + f"""SELECT parameter, {r('max(m) - min(m)', 6)} AS spread, count(*) AS settings FROM (
 SELECT 'depth' AS parameter, depth AS setting, avg(test_roc_auc) AS m FROM runs GROUP BY 2 UNION ALL SELECT 'rate_step', rate_step, avg(test_roc_auc) FROM runs GROUP BY 2) GROUP BY parameter""",
)
def sensitivity(spark, folder):
    return RU.sensitivity(run_history(spark, folder), ["depth", "rate_step"], "test_roc_auc").withColumn("spread", F.round("spread", 6))


@query(
    "m6_importance",
    ctes("attr")
    + f"""SELECT feature, {r('m_abs', 6)} AS mean_abs_shap, {r('m', 6)} AS mean_shap, {r('s', 6)} AS std_shap, row_number() OVER (ORDER BY m_abs DESC, feature) AS rank, CASE WHEN m > 0 THEN 'increases_risk' ELSE 'protective' END AS direction FROM (
 {" UNION ALL ".join(f"SELECT '{c}' AS feature, avg(abs(shap_{c})) AS m_abs, avg(shap_{c}) AS m, stddev_pop(shap_{c}) AS s FROM attr" for c in X.ATTRIBUTED)})""",
)
def importance(spark, folder):
    wide = X.attributions(spark, folder)
    long = lengthen(wide, [], [f"shap_{c}" for c in X.ATTRIBUTED], "feature", "shap_value").withColumn("feature", F.regexp_replace("feature", "^shap_", ""))
    ranked = RU.importance(long)
    return ranked.withColumns({c: F.round(c, 6) for c in ("mean_abs_shap", "mean_shap", "std_shap")})
