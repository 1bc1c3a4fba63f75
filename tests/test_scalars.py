from datetime import date

from pyspark.sql import functions as F

from quarterline.functions import quarters as Q
from quarterline.functions import scalars as S


def values(spark, schema, data, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_zero_pad_keeps_long_keys_whole(spark):
    got = values(spark, "k string", [("1750",), ("12345678901",)], S.zero_pad(F.col("k")))
    assert got == [("0000001750",), ("12345678901",)]


def test_lenient_casts(spark):
    got = values(spark, "t string", [("1.5",), (".",), ("2020-02-30",), ("2020-02-03",)], S.to_number(F.col("t")), S.to_day(F.col("t")))
    assert got == [(1.5, None), (None, None), (None, None), (None, date(2020, 2, 3))]


def test_ratio_is_null_on_zero(spark):
    data = [(10.0, 2.0), (20.0, 4.0), (30.0, 5.0), (1.0, 0.0), (0.0, 0.0), (None, 1.0)]
    got = values(spark, "a double, b double", data, S.ratio(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [5.0, 5.0, 6.0, None, None, None]


def test_quarter_ends(spark):
    got = values(
        spark,
        "d date, y int, p string",
        [(date(2020, 2, 15), 2020, "Q2"), (date(2020, 12, 31), 2021, "FY")],
        Q.quarter_end_of(F.col("d")),
        Q.quarter_end(F.col("y"), F.col("p")),
        Q.sort_number(F.col("y"), F.col("p")),
    )
    assert got == [(date(2020, 3, 31), date(2020, 6, 30), 20202), (date(2020, 12, 31), None, 20210)]


def test_money_text(spark):
    data = [(24.2e9,), (-3.14e6,), (500e3,), (999.0,), (2500.0,), (None,)]
    got = values(spark, "v double", data, S.money_text(F.col("v")))
    assert [g[0] for g in got] == ["$24.2B", "-$3.1M", "$500K", "$999", "$2K", "N/A"]


def test_one_decimal_equals_exact_rounding(spark):
    numbers = [i / 20 for i in range(400)] + [k + 0.15 for k in range(300)] + [856.85, 216.05, 999.949999, 0.25, 0.75, 0.35, 999.96]
    got = values(spark, "v double", [(n,) for n in numbers], S.one_decimal(F.col("v")))
    assert [g[0] for g in got] == [f"{n:.1f}" for n in numbers]


def test_joined_text_and_names(spark):
    flags = [(F.col("a"), "Neg. income"), (F.col("b"), "High leverage")]
    got = values(spark, "a boolean, b boolean", [(True, True), (False, None)], S.joined_text(flags))
    assert [g[0] for g in got] == ["Neg. income · High leverage", "—"]
    named = values(
        spark, "f string, n string, t string", [("1", "Acme", "ACM"), ("2", "Acme", " "), ("3", None, "X")], S.display_name(F.col("f"), F.col("n"), F.col("t"))
    )
    assert [g[0] for g in named] == ["Acme (ACM)", "Acme", "CIK 3"]


def test_nan_to_null(spark):
    data = [(float("nan"),), (float("inf"),), (-float("inf"),), (1.0,), (None,)]
    got = values(spark, "v double", data, S.nan_to_null(F.col("v")), S.nan_to_null(F.col("v"), 0.0))
    assert got == [(None, 0.0), (None, 0.0), (None, 0.0), (1.0, 1.0), (None, 0.0)]


def test_levels_bands_and_trend(spark):
    low, high = S.confidence_band(F.col("p"))
    got = values(spark, "p double", [(0.72,), (0.3,), (0.01,)], S.risk_level(F.col("p")), low, high, S.trend_text(F.col("p") - 0.3))
    assert [g[0] for g in got] == ["High", "Medium", "Low"]
    assert got[2][1] == 0.0 and abs(got[0][2] - 0.77) < 1e-12
    assert [g[3] for g in got] == ["up", "flat", "down"]


def test_lower_names(spark):
    assert S.lower_names(spark.createDataFrame([(1, 2)], "` CIK ` int, Tag int")).columns == ["cik", "tag"]
