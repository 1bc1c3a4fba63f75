"""Folded counters and refined quantiles against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterline.operators import folds
from quarterline.operators import slices as SL

WANTED = {"q0": 0.0, "q01": 0.01, "q25": 0.25, "median": 0.5, "q75": 0.75, "q999": 0.999, "q1": 1.0}


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    rows = []
    for i in range(4000):
        heavy = math.copysign(10 ** rng.uniform(-12, 12), rng.random() - 0.5)
        hot = 5.0 if i % 3 == 0 else rng.gauss(5, 1e-9)
        rows.append((f"g{i % 7}" if i % 11 else None, "odd" if i % 2 else "even", heavy, hot, None if i % 5 else float(i % 4), 0.0 if i % 2 else -0.0, None))
    return rows


COLUMNS = ["heavy", "hot", "few", "zero", "none"]


def table(spark, data, parts=5):
    return spark.createDataFrame(data, "g string, s string, heavy double, hot double, few double, zero double, none double").repartition(parts)


@pytest.mark.parametrize(("cells", "listed"), [(1 << 19, 1 << 17), (4000, 50), (700, 0)])
def test_quantiles_equal_numpy_however_few_counters(spark, data, monkeypatch, cells, listed):
    monkeypatch.setattr(folds, "CELLS", cells)
    monkeypatch.setattr(folds, "LISTED", listed)
    members = [(F.lit("by g"), F.col("g")), (F.lit("by s"), F.col("s")), (F.lit("all"), F.lit("all"))]
    got = folds.summaries(table(spark, data), members, COLUMNS, WANTED, spread=True).collect()
    assert len(got) == (7 + 2 + 1) * len(COLUMNS)
    for row in got:
        mine = [r for r in data if row["slice"] in (r[0], r[1], "all")]
        values = np.array([v for r in mine if (v := r[2 + COLUMNS.index(row["feature"])]) is not None])
        assert (row["rows"], row["present"]) == (len(mine), len(values))
        if not len(values):
            assert all(row[q] is None for q in [*WANTED, "mean", "low", "high", "std"])
            continue
        assert (row["low"], row["high"]) == (values.min(), values.max())
        for name, share in WANTED.items():
            position = share * (len(values) - 1)
            ordered = np.sort(values)
            low, high = ordered[int(np.floor(position))], ordered[int(np.ceil(position))]
            assert row[name] == low + (high - low) * (position - np.floor(position))
        assert row["mean"] == pytest.approx(values.mean(), rel=1e-9, abs=1e-9)
        std = values.std(ddof=1)
        assert row["std"] == pytest.approx(std, rel=1e-9, abs=1e-15)
        far = (values < values.mean() - 3 * std) | (values > values.mean() + 3 * std)
        assert row["outlier_rate"] == pytest.approx(far.sum() / len(mine) if std > 0 else 0.0)


def test_rising_numbers_keep_the_order():
    values = np.array([-math.inf, -1e300, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, math.inf])
    numbers = folds.rising(values)
    assert (numbers[1:] >= numbers[:-1]).all() and numbers[4] == numbers[5] and len(set(numbers.tolist())) == 10
    assert (folds.from_rising(numbers) == values).all()


def test_no_rows_and_no_values(spark, data):
    empty = table(spark, data).where("false")
    assert folds.summaries(empty, [(F.lit("d"), F.col("s"))], ["heavy"], WANTED, spread=True).count() == 0
    assert folds.group_summaries(empty, ["g"], ["heavy"], {"m": 0.5}).count() == 0
    assert folds.group_summaries(table(spark, data), [], ["none"], {"m": 0.5}).count() == 0


def test_group_columns_keep_their_types_and_nulls(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (2, None, 5.0), (None, "x\"y", 7.0)], "k int, t string, v double")
    times = spark.sql("SELECT timestamp_ntz'2020-01-01 00:00:00.000001' + make_interval(0, 0, 0, 0, 0, 0, id / 1000000.0) AS at, double(id) AS v FROM range(3)")
    assert folds.group_summaries(times, ["at"], ["v"], {"m": 0.5}).join(times, ["at"]).count() == 3
    got = folds.group_summaries(df, ["k", "t"], ["v"], {"m": 0.5})
    assert got.dtypes[:2] == [("k", "int"), ("t", "string")]
    assert {(r["k"], r["t"]): r["m"] for r in got.collect()} == {(1, "a"): 1.5, (2, None): 5.0, (None, 'x"y'): 7.0}


def test_beyond_the_bound_the_other_way_gives_the_same(spark, data, monkeypatch):
    rows = table(spark, data).withColumns({"dimension": F.lit("d"), "slice": F.col("g")}).where("g IS NOT NULL")
    columns = ["heavy", "few"]
    folded = SL.slice_stats(rows, columns), SL.drift_matrix(rows, columns)
    monkeypatch.setattr(folds, "PAIRS", 3)
    assert folds.extents(rows, [(F.col("dimension"), F.col("slice"))], columns) is None
    ranked = SL.slice_stats(rows, columns), SL.drift_matrix(rows, columns)
    for a, b, keys in zip(folded, ranked, (["slice", "feature"], ["feature", "slice_a", "slice_b"]), strict=True):
        names = sorted(set(a.columns) - {"dimension", *keys})
        left, right = ({tuple(r[k] for k in keys): [r[n] for n in names] for r in x.collect()} for x in (a, b))
        assert left.keys() == right.keys() and len(left) in (14, 42)
        for key, values in left.items():
            assert values == pytest.approx(right[key], rel=1e-9, abs=1e-12)


def test_drift_reads_each_row_once(spark, data):
    """No plan node makes rows: the wide rows go to the workers as they are, and counters come back."""
    members = [(F.lit("by g"), F.col("g")), (F.lit("by s"), F.col("s"))]
    plan = folds._marked(table(spark, data), members, COLUMNS)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Expand" not in plan and "Join" not in plan


def test_comoments_equal_numpy(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(1e6, 1, (500, 4))
    values[:, 1] = values[:, 0] * 2 + rng.normal(0, 0.1, 500)
    values[:, 3] = 7.0
    rows = [tuple(None if rng.random() < 0.2 else float(v) for v in row) for row in values]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(6)
    from quarterline.operators.profile import correlations

    got = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in correlations(df, list("abcd")).collect()}
    assert len(got) == 10
    for (x, y), value in got.items():
        pairs = np.array([(r["abcd".index(x)], r["abcd".index(y)]) for r in rows if r["abcd".index(x)] is not None and r["abcd".index(y)] is not None])
        if "d" in (x, y):
            assert math.isnan(value)
        else:
            assert value == pytest.approx(np.corrcoef(pairs.T)[0, 1], abs=1e-9)
    plan = folds.comoments(df, list("abcd"))._jdf.queryExecution().toString()
    assert "Generate" not in plan
