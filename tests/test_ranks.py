"""Global ranks and quantiles against brute force, with hot values and different partitionings."""

import random
import statistics

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarterline.operators import ranks as R


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(7)
    # A third of the rows share one value and half belong to one group.
    return [(i, "hot" if i % 2 else f"g{i % 5}", 5.0 if i % 3 == 0 else round(rng.uniform(0, 100), 1)) for i in range(1501)]


def spread(spark, data, parts):
    return spark.createDataFrame(data, "id bigint, g string, v double").repartition(parts)


@pytest.mark.parametrize("parts", [1, 13])
def test_row_number_is_total(spark, skewed, parts):
    numbered = R.with_row_number(spread(spark, skewed, parts), ["v", "id"], "n", "total")
    expected = {i: n for n, (i, _, _) in enumerate(sorted(skewed, key=lambda r: (r[2], r[0])), start=1)}
    got = numbered.select("id", "n", "total").collect()
    assert {r["id"]: r["n"] for r in got} == expected
    assert {r["total"] for r in got} == {len(skewed)}


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6, 7, 1501])
def test_tiles_follow_ntile(spark, skewed, size):
    data = skewed[:size]
    df = spread(spark, data, 3)
    cuts = R.tile_cuts(df, ["v", "id"], 4)
    got = {r["id"]: r["t"] for r in df.select("id", R.tile_of(["v", "id"], cuts).alias("t")).collect()}
    df.createOrReplaceTempView("tiled")
    want = {r["id"]: r["t"] for r in spark.sql("SELECT id, ntile(4) OVER (ORDER BY v, id) AS t FROM tiled").collect()}
    assert got == want


def test_running_totals_per_group(spark, skewed):
    counted = spread(spark, skewed, 9).groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = R.with_running_totals(counted, ["g"], ["v"], ["n"])
    for g, v, n, upto, total in got.select("g", "v", "n", "n_upto", "n_total").collect():
        same = [x for _, gg, x in skewed if gg == g]
        assert upto == sum(x <= v for x in same) and total == len(same) and n == sum(x == v for x in same)


@pytest.mark.parametrize("parts", ["2", "64"])
def test_quantiles_are_exact(spark, skewed, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wanted = {"low": 0.0, "q25": 0.25, "median": 0.5, "q75": 0.75, "high": 1.0}
        got = R.group_quantiles(spread(spark, skewed, 5), ["g"], "v", wanted).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == 6
    for row in got:
        same = [v for _, g, v in skewed if g == row["g"]]
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.quantile(same, p), abs=1e-9)


def test_quantiles_without_groups_and_with_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "v double")
    assert R.group_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == statistics.median([1, 2, 3, 4])
    sketch = R.group_quantiles(df, [], "v", {"m": 0.5}, accuracy=1000).first()["m"]
    assert sketch in (2.0, 3.0)


def test_null_groups_stay_together(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    assert rows(R.group_quantiles(df, ["g"], "v", {"m": 0.5})) == [("a", 5.0), (None, 2.0)]


def wide_ladder(spark, rows, parts=6):
    return spark.createDataFrame(rows, "g string, k int, v double, n bigint, w double").repartition(parts)


@pytest.mark.parametrize("held", [1, 40, 1 << 16])
@pytest.mark.parametrize("kind", ["one group", "few", "all apart", "none"])
def test_running_totals_over_many_partitions(spark, monkeypatch, held, kind):
    rng = random.Random(held)
    groups = {"one group": lambda i: "x", "few": lambda i: "hot" if i % 3 else f"g{i % 5}" if i % 2 else None, "all apart": str, "none": str}[kind]
    data = [(groups(i), i % 2, float(i * 7 % 900), rng.randrange(5), rng.random()) for i in range(900 if kind != "none" else 0)]
    monkeypatch.setattr(R, "HELD", held)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = R.with_running_totals(wide_ladder(spark, data), ["g", "k"], ["v"], ["n", "w"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert len(got) == len(data)
    for row in got:
        same = [r for r in data if r[:2] == (row["g"], row["k"])]
        assert row["n_upto"] == sum(r[3] for r in same if r[2] <= row["v"]) and row["n_total"] == sum(r[3] for r in same)
        assert row["w_upto"] == pytest.approx(sum(r[4] for r in same if r[2] <= row["v"])) and row["w_total"] == pytest.approx(sum(r[4] for r in same))


def test_running_totals_need_one_exchange(spark, skewed):
    counted = R.sized(spread(spark, skewed, 3).groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")))
    plan = R.scanned(counted, ["g"], ["v"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("Exchange rangepartitioning") == 1 and "Window" not in plan
    # What follows the scan joins the stored rows with a few rows per partition, without another exchange of them.
    whole = R.with_running_totals(counted, ["g"], ["v"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in whole and "rangepartitioning" not in whole
