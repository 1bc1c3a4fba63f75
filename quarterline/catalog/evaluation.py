"""Evaluation metrics over scored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes, r
from quarterline.operators import metrics as M
from quarterline.operators import slices as SL

THRESHOLD = 0.6


def auc_sql(table: str, groups: str) -> str:
    """Mid-rank form, written differently from the Spark plan on purpose."""
    by = f"PARTITION BY {groups}" if groups else ""
    lead = f"{groups}, " if groups else ""
    tail = f"GROUP BY {groups}" if groups else ""
    return f"""SELECT {lead}(sum(mid) FILTER (label = 1) - p * (p + 1) / 2.0) / nullif(p * n, 0) AS roc_auc FROM (
 SELECT *, rank() OVER ({by} ORDER BY score) + (count(*) OVER ({('PARTITION BY ' + groups + ', score') if groups else 'PARTITION BY score'}) - 1) / 2.0 AS mid,
  sum(label) OVER ({by}) AS p, sum(1 - label) OVER ({by}) AS n FROM {table}) {tail + ', p, n' if groups else 'GROUP BY p, n'}"""


@query("n1_roc_auc", ctes("scores") + f"SELECT {r('roc_auc', 8)} AS roc_auc FROM ({auc_sql('scores', '')})")
def roc_auc(spark, folder):
    return M.roc_auc(X.scores(spark, folder), []).select(F.round("roc_auc", 8).alias("roc_auc"))


@query("n1_roc_auc_by_segment", ctes("scores") + f"SELECT segment, {r('roc_auc', 8)} AS roc_auc FROM ({auc_sql('scores', 'segment')})")
def roc_auc_by_segment(spark, folder):
    return M.roc_auc(X.scores(spark, folder), ["segment"]).select("segment", F.round("roc_auc", 8).alias("roc_auc"))


def metric_sql(table: str, groups: str, key: str) -> str:
    by = f"PARTITION BY {groups}" if groups else ""
    lead = f"{groups}, " if groups else ""
    tail = f"GROUP BY {groups}" if groups else ""
    hit = f"score >= {THRESHOLD}"
    join = f"LEFT JOIN ({auc_sql(table, groups)}) a USING ({groups})" if groups else f", ({auc_sql(table, groups)}) a"
    return f"""SELECT {lead}sample_count, positives, {r('roc_auc', 8)} AS roc_auc, {r('top_hits / k', 8)} AS precision_at_k, {r('coalesce(top_hits / nullif(positives, 0), 0.0)', 8)} AS recall_at_k,
 {r('brier', 8)} AS brier_score, {r('coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0)', 8)} AS f1_at_threshold FROM (
 SELECT {lead}count(*) AS sample_count, CAST(sum(label) AS BIGINT) AS positives, greatest(1, ceil(count(*) * 0.05)) AS k,
  count(*) FILTER (label = 1 AND rn <= greatest(1, ceil(n * 0.05))) AS top_hits, avg(pow(score - label, 2)) AS brier,
  count(*) FILTER ({hit} AND label = 1) AS tp, count(*) FILTER ({hit} AND label = 0) AS fp, count(*) FILTER (NOT {hit} AND label = 1) AS fn
  FROM (SELECT *, row_number() OVER ({by} ORDER BY score DESC, {key}) AS rn, count(*) OVER ({by}) AS n FROM {table}) {tail}) {join}"""


_METRICS = ["roc_auc", "precision_at_k", "recall_at_k", "brier_score", "f1_at_threshold"]


def _rounded(df):
    return df.withColumns({m: F.round(m, 8) for m in _METRICS})


@query(
    "n2_top_k",
    ctes("scores") + f"SELECT segment, precision_at_k, recall_at_k FROM ({metric_sql('scores', 'segment', 'o_orderkey')})",
)
def top_k(spark, folder):
    table = M.metric_table(X.scores(spark, folder), ["segment"], ["o_orderkey"], THRESHOLD)
    return _rounded(table).select("segment", "precision_at_k", "recall_at_k")


@query("n3_brier", ctes("scores") + f"SELECT {r('avg(pow(score - label, 2))', 8)} AS brier_score FROM scores")
def brier(spark, folder):
    return X.scores(spark, folder).agg(F.round(F.avg(F.pow(F.col("score") - F.col("label"), 2)), 8).alias("brier_score"))


@query(
    "n4_at_threshold",
    ctes("scores")
    + f"""SELECT segment, tp, fp, fn, {r('coalesce(tp / nullif(tp + fp, 0), 0.0)', 8)} AS precision, {r('coalesce(tp / nullif(tp + fn, 0), 0.0)', 8)} AS recall,
 {r('coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0)', 8)} AS f1 FROM (SELECT segment, count(*) FILTER (score >= {THRESHOLD} AND label = 1) AS tp,
 count(*) FILTER (score >= {THRESHOLD} AND label = 0) AS fp, count(*) FILTER (score < {THRESHOLD} AND label = 1) AS fn FROM scores GROUP BY segment)""",
)
def at_threshold(spark, folder):
    table = M.at_threshold(X.scores(spark, folder), THRESHOLD, ["segment"])
    return table.withColumns({m: F.round(m, 8) for m in ("precision", "recall", "f1")})


_RUNGS = """rungs AS (SELECT score, sum(sum(label)) OVER (ORDER BY score DESC) AS tp, sum(sum(1 - label)) OVER (ORDER BY score DESC) AS fp,
 sum(sum(label)) OVER () AS p, sum(sum(1 - label)) OVER () AS n FROM scores GROUP BY score)"""


@query(
    "n5_best_threshold",
    ctes("scores", extra=_RUNGS) + f"SELECT score AS threshold, {r('f1', 8)} AS f1 FROM (SELECT score, 2.0 * tp / (tp + fp + p) AS f1 FROM rungs) ORDER BY f1 DESC, score LIMIT 1",
)
def best_threshold(spark, folder):
    return M.best_threshold(X.scores(spark, folder), []).withColumn("f1", F.round("f1", 8))


@query(
    "n6_confusion",
    ctes("scores") + f"SELECT label AS actual, CASE WHEN score >= {THRESHOLD} THEN 1 ELSE 0 END AS predicted, count(*) AS rows FROM scores GROUP BY ALL",
)
def confusion(spark, folder):
    return M.confusion(X.scores(spark, folder), THRESHOLD)


@query(
    "n7_curves",
    ctes("scores", extra=_RUNGS)
    + f"SELECT score AS threshold, {r('fp / n', 8)} AS fpr, {r('tp / p', 8)} AS tpr, {r('tp / (tp + fp)', 8)} AS precision FROM rungs",
)
def curves(spark, folder):
    points = M.curve_points(X.scores(spark, folder), [])
    return points.withColumns({m: F.round(m, 8) for m in ("fpr", "tpr", "precision")})


@query("n8_metric_row", ctes("scores") + metric_sql("scores", "", "o_orderkey"))
def metric_row(spark, folder):
    return _rounded(M.metric_table(X.scores(spark, folder), [], ["o_orderkey"], THRESHOLD))


_SLICED = """sliced AS (SELECT 'segment' AS dimension, segment AS slice, o_orderkey, score, label FROM scores
 UNION ALL SELECT 'priority', priority, o_orderkey, score, label FROM scores
 UNION ALL SELECT 'time_period', CASE WHEN fiscal_year < 1998 THEN 'pre_1998' ELSE 'post_1998' END, o_orderkey, score, label FROM scores)"""


def score_slices(spark, folder):
    rows = X.scores(spark, folder)
    time = SL.sliced(rows.select("o_orderkey", "fiscal_year", "score", "label"), 1998)
    entries = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("slice")) for c in ("segment", "priority")])
    others = rows.select("o_orderkey", "score", "label", F.inline(entries))
    columns = ["dimension", "slice", "o_orderkey", "score", "label"]
    return others.select(*columns).unionByName(time.select(*columns))


@query("n9_slice_performance", ctes("scores", extra=_SLICED) + metric_sql("sliced", "dimension, slice", "o_orderkey"))
def slice_performance(spark, folder):
    return _rounded(M.metric_table(score_slices(spark, folder), ["dimension", "slice"], ["o_orderkey"], THRESHOLD))


_FAIR = f"""perf AS (SELECT dimension, slice, sample_count, roc_auc, recall_at_k AS recall_at_5pct FROM ({metric_sql('sliced', 'dimension, slice', 'o_orderkey')})),
 long AS (SELECT dimension, slice, sample_count, 'roc_auc' AS metric, roc_auc AS v FROM perf UNION ALL SELECT dimension, slice, sample_count, 'recall_at_5pct', recall_at_5pct FROM perf),
 fair AS (SELECT dimension, slice, sample_count, metric, {r('v', 4)} AS slice_value, {r('o', 4)} AS overall_value, {r('o - v', 4)} AS gap, o - v > 0.004 AS bias_alert
  FROM (SELECT *, sum(v * sample_count) OVER (PARTITION BY metric) / sum(sample_count) OVER (PARTITION BY metric) AS o FROM long WHERE v IS NOT NULL))"""


def _fair(spark, folder):
    table = _rounded(M.metric_table(score_slices(spark, folder), ["dimension", "slice"], ["o_orderkey"], THRESHOLD))
    return SL.fairness(table.withColumnRenamed("recall_at_k", "recall_at_5pct"), ["roc_auc", "recall_at_5pct"], 0.004)


@query("s16_model_fairness", ctes("scores", extra=f"{_SLICED}, {_FAIR}") + "SELECT * FROM fair")
def model_fairness(spark, folder):
    return _fair(spark, folder)


@query(
    "s17_threshold_suggestions",
    ctes("scores", extra=f"{_SLICED}, {_FAIR}")
    + """SELECT dimension, slice, 0.5::DOUBLE AS current_threshold, CAST(greatest(0.1, round(0.5 - 0.05 * greatest(1, floor(gap / 0.05)), 3)) AS DOUBLE) AS suggested_threshold,
 printf('recall_at_5pct is %.4f under the mean of all slices (limit 0.004)', gap) AS reason FROM fair WHERE bias_alert AND metric = 'recall_at_5pct'""",
)
def suggestions(spark, folder):
    return SL.threshold_suggestions(_fair(spark, folder), limit=0.004)
