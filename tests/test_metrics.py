"""Metrics with tied scores against brute force."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarterline.operators import metrics as M

SCHEMA = "k int, g string, score double, label int"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    hot = [(i, "a", 0.5 if i % 3 else round(rng.random(), 1), int(rng.random() < 0.3)) for i in range(300)]
    return hot + [(400 + i, "b", round(rng.random(), 1), i % 2) for i in range(20)] + [(500, "one", 0.4, 1), (501, "one", 0.2, 1)]


def brute_auc(part):
    pos, neg = [s for *_, s, y in part if y], [s for *_, s, y in part if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def groups(data):
    return {g: [r for r in data if r[1] == g] for g in {r[1] for r in data}}


def test_auc(spark, data):
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(spark.createDataFrame(data, SCHEMA), ["g"]).collect()}
    for g, part in groups(data).items():
        want = brute_auc(part)
        assert got[g] is None if want is None else got[g] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("share", [0.05, 0.4, 1.0])
def test_metric_table(spark, data, share):
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {r["g"]: r for r in M.metric_table(df, ["g"], ["k"], 0.5, share).collect()}
    for g, part in groups(data).items():
        k = max(1, -(-len(part) * share // 1))
        top = sorted(part, key=lambda r: (-r[2], r[0]))[: int(k)]
        hits, positives = sum(r[3] for r in top), sum(r[3] for r in part)
        tp = sum(r[3] for r in part if r[2] >= 0.5)
        fp = sum(1 - r[3] for r in part if r[2] >= 0.5)
        row = got[g]
        assert row["sample_count"] == len(part) and row["positives"] == positives
        assert row["precision_at_k"] == pytest.approx(hits / k) and row["recall_at_k"] == pytest.approx(hits / positives)
        assert row["brier_score"] == pytest.approx(sum((r[2] - r[3]) ** 2 for r in part) / len(part))
        f1 = 2 * tp / (2 * tp + fp + positives - tp) if tp else 0.0
        assert row["f1_at_threshold"] == pytest.approx(f1)


def test_whole_table_row_equals_one_group(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    whole = M.metric_table(df, [], ["k"], 0.5).first()
    one = M.metric_table(df.withColumn("g", F.lit("x")), ["g"], ["k"], 0.5).drop("g").first()
    assert whole == one


def test_empty_slice_gives_no_row(spark, data):
    assert M.metric_table(spark.createDataFrame(data, SCHEMA).where("k < 0"), ["g"], ["k"], 0.5).count() == 0


def test_best_threshold_prefers_the_lowest(spark):
    tied = [(0, "g", 0.9, 1), (1, "g", 0.8, 0), (2, "g", 0.7, 0), (3, "g", 0.6, 1)]
    got = M.best_threshold(spark.createDataFrame(tied, SCHEMA), []).first()
    # 0.9 gives 2/3 and 0.6 gives 4/6: the lower one wins
    assert got["threshold"] == 0.6 and got["f1"] == pytest.approx(2 / 3)


def test_threshold_metrics_are_zero_when_undefined(spark):
    row = M.at_threshold(spark.createDataFrame([(0, "g", 0.1, 0)], SCHEMA), 0.5).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_confusion_and_curves(spark):
    df = spark.createDataFrame([(0, "g", 0.9, 1), (1, "g", 0.9, 0), (2, "g", 0.1, 0)], SCHEMA)
    assert rows(M.confusion(df, 0.5)) == [(0, 0, 1), (0, 1, 1), (1, 1, 1)]
    points = M.curve_points(df, []).orderBy("threshold").collect()
    assert [tuple(p) for p in points] == [(0.1, 1.0, 1.0, pytest.approx(1 / 3)), (0.9, 0.5, 1.0, 0.5)]
