"""Ranking and threshold metrics of a scored table, exact with tied scores, for all slices in one plan.

Rows are first counted per score; running counts over that ladder give every metric, so neither ties nor a hot
slice end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.operators.joins import sized
from quarterline.operators.ranks import with_running_totals


def ladder(df: DataFrame, groups: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """One row per (groups, score): class counts, their running sums from the lowest score, and totals."""
    counted = df.where(F.col(score).isNotNull()).groupBy(*groups, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return with_running_totals(counted, groups, [score], ["pos", "neg"])


def _auc():
    pairs = F.col("pos_total") * F.col("neg_total")
    return F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)) / F.nullif(F.max(pairs), F.lit(0))


def roc_auc(df: DataFrame, groups: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """Rank-sum area with ties at half weight; NULL when a class is missing."""
    return ladder(df, groups, score, label).groupBy(*groups).agg(_auc().alias("roc_auc"))


def _at_least(column: str):
    """How many of that class score at or above this rung."""
    return F.col(f"{column}_total") - F.col(f"{column}_upto") + F.col(column)


def f1(tp, fp, fn):
    return F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))


def curve_points(df: DataFrame, groups: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """ROC and precision/recall points at every distinct score as threshold."""
    rungs = ladder(df, groups, score, label)
    tp, fp = _at_least("pos"), _at_least("neg")
    return rungs.select(
        *groups,
        F.col(score).alias("threshold"),
        F.try_divide(fp, F.col("neg_total")).alias("fpr"),
        F.try_divide(tp, F.col("pos_total")).alias("tpr"),
        F.try_divide(tp, tp + fp).alias("precision"),
    )


def best_threshold(df: DataFrame, groups: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """Threshold of the largest F1; the lowest one wins ties."""
    rungs = ladder(df, groups, score, label)
    tp, fp = _at_least("pos"), _at_least("neg")
    rated = rungs.withColumn("_f1", f1(tp, fp, F.col("pos_total") - tp))
    best = rated.groupBy(*groups).agg(F.max(F.struct(F.col("_f1").alias("f1"), (-F.col(score)).alias("minus"))).alias("_best"))
    return best.select(*groups, (-F.col("_best.minus")).alias("threshold"), F.col("_best.f1").alias("f1"))


def confusion(df: DataFrame, threshold: float, groups: list[str] | None = None, score: str = "score", label: str = "label") -> DataFrame:
    predicted = (F.col(score) >= threshold).cast("int").alias("predicted")
    return df.groupBy(*groups or [], F.col(label).alias("actual"), predicted).agg(F.count(F.lit(1)).alias("rows"))


def at_threshold(df: DataFrame, threshold: float, groups: list[str] | None = None, score: str = "score", label: str = "label") -> DataFrame:
    """F1, precision and recall of `score >= threshold`; 0 when undefined."""
    hit, actual = F.col(score) >= threshold, F.col(label) == 1
    counts = df.groupBy(*groups or []).agg(
        F.count_if(hit & actual).alias("tp"), F.count_if(hit & ~actual).alias("fp"), F.count_if(~hit & actual).alias("fn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)),
            "recall": F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)),
            "f1": f1(tp, fp, fn),
        }
    )


def metric_table(
    df: DataFrame,
    groups: list[str],
    key: list[str],
    threshold: float,
    top_share: float = 0.05,
    score: str = "score",
    label: str = "label",
) -> DataFrame:
    """All seven metrics per group. Rows tied at the top-k boundary are taken in key order, lowest first."""
    rungs = ladder(df, groups, score, label)
    size = F.col("pos_total") + F.col("neg_total")
    above = size - F.col("pos_upto") - F.col("neg_upto")
    k = F.greatest(F.lit(1), F.ceil(size * F.lit(top_share)))
    on_edge = (above < k) & (k <= above + F.col("pos") + F.col("neg"))
    tp, fp = _at_least("pos"), _at_least("neg")
    # The lowest rung at or above the threshold knows the counts at the threshold.
    at_cut = F.when(F.col(score) >= threshold, F.struct(F.col(score), tp.alias("tp"), fp.alias("fp")))
    squared = F.col("pos") * F.pow(F.col(score) - 1, 2) + F.col("neg") * F.pow(F.col(score), 2)
    edge = F.struct(
        F.col(score).alias("edge"),
        (k - above).alias("take"),
        (F.col("pos_total") - F.col("pos_upto")).alias("pos_above"),
        k.alias("k"),
    )
    folded = rungs.groupBy(*groups).agg(
        F.max(size).alias("sample_count"),
        F.max("pos_total").alias("positives"),
        _auc().alias("roc_auc"),
        (F.sum(squared) / F.max(size)).alias("brier_score"),
        F.min(at_cut).alias("_cut"),
        F.max(F.when(on_edge, edge)).alias("_edge"),
    )
    # One row per group; when they are few, the rows need no shuffle to meet their group's boundary.
    folded = sized(folded)
    edges = folded.select(*groups, F.col("_edge.edge").alias("_score"), F.col("_edge.take").alias("_take"))
    tied = df.join(edges, [df[g].eqNullSafe(edges[g]) for g in groups] + [df[score] == edges["_score"]])
    tied = tied.select(*[df[g] for g in groups], *[df[c] for c in key], (df[label] == 1).cast("bigint").alias("_hit"), F.lit(1).cast("bigint").alias("_one"), "_take")
    placed = with_running_totals(tied, groups, key, ["_one"])
    taken = placed.where(F.col("_one_upto") <= F.col("_take")).groupBy(*groups).agg(F.sum("_hit").alias("_tied_hits"))
    if groups:
        both = folded.join(taken, [folded[g].eqNullSafe(taken[g]) for g in groups], "left").select(
            *[folded[c] for c in folded.columns], "_tied_hits"
        )
    else:
        hits = taken.first()["_tied_hits"]
        both = folded.withColumn("_tied_hits", F.lit(hits).cast("bigint"))
    hits = F.col("_edge.pos_above") + F.coalesce("_tied_hits", F.lit(0))
    cut_tp, cut_fp = F.coalesce("_cut.tp", F.lit(0)), F.coalesce("_cut.fp", F.lit(0))
    return both.select(
        *groups,
        "sample_count",
        "positives",
        "roc_auc",
        (hits / F.col("_edge.k")).alias("precision_at_k"),
        F.coalesce(F.try_divide(hits, F.col("positives")), F.lit(0.0)).alias("recall_at_k"),
        "brier_score",
        f1(cut_tp, cut_fp, F.col("positives") - cut_tp).alias("f1_at_threshold"),
    )
