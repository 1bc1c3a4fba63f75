from conftest import rows
from pyspark.sql import functions as F

from quarterline.operators import dedup as D
from quarterline.operators import filters as FL
from quarterline.operators import joins as J
from quarterline.operators import refresh as RF
from quarterline.plans import cleaning

RAW = "firm_id string, tag string, value double, fiscal_year string, fiscal_period string, filed_date string"


def raw_facts(spark):
    data = [
        ("1750", "Assets", 1000.0, "2020", "Q1", "2020-05-01"),
        ("1750", "Assets", 1100.0, "2020", " q1", "2020-05-15"),
        ("1750", "Assets", 900.0, "2020", "Q1", None),
        ("1750", "Liabilities", 5.0, "x", "Q1", "2020-05-15"),
        ("1750", "Liabilities", 6.0, "2020", "Q5", "2020-05-15"),
        ("1750", "Liabilities", 7.0, "43831", "Q1", "2020-05-15"),
        ("99", "Assets", 8.0, "2020", "FY", "bad date"),
    ]
    return spark.createDataFrame(data, RAW)


def test_typed_facts_keep_the_latest_filing(spark):
    got = rows(cleaning.typed_facts(raw_facts(spark), ["value"]).select("firm_id", "tag", "value", "quarter_key"))
    assert got == [("0000000099", "Assets", 8.0, "2020_FY"), ("0000001750", "Assets", 1100.0, "2020_Q1")]


def test_typed_series_snap_to_quarter_ends(spark):
    data = [("2020-02-15", 1.0, "A", 1), ("2020-03-31", 2.0, "A", 2), (None, 3.0, "A", 3), ("2020-05-01", 4.0, "A", 4)]
    df = spark.createDataFrame(data, "date string, value double, series_id string, n int")
    got = rows(cleaning.typed_series(df, ["n"]).select(F.col("date").cast("string"), "value"))
    assert got == [("2020-03-31", 2.0), ("2020-06-30", 4.0)]


def test_row_order_does_not_matter(spark):
    df = spark.createDataFrame([(k, v, t) for k in range(3) for v in range(4) for t in range(2)], "k int, v int, t int")
    orders = [F.col("v").desc(), F.col("t")]
    assert rows(D.top_rows(df, ["k"], orders, 2)) == rows(D.top_rows(df.orderBy("t", "v").repartition(7), ["k"], orders, 2))
    assert rows(D.nth_row(df, ["k"], orders, 2)) == [(k, 3, 1) for k in range(3)]


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = D.top_rows(df, ["k"], [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_new_rows_replace_old_ones(spark):
    old = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, v double")
    new = spark.createDataFrame([(2, 21.0), (3, 30.0)], "k int, v double")
    assert rows(D.keep_newer_source(old, new, ["k"], ["v"])) == [(1, 10.0), (2, 21.0), (3, 30.0)]


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    assert D.duplicate_count(df, ["k"]).first()[0] == 2
    assert D.duplicate_count(df.limit(0), ["k"]).first()[0] == 0


def quarters(n, value, firm="f"):
    return [(firm, 2018 + i // 4, f"Q{i % 4 + 1}", "Assets", value) for i in range(n)]


REFRESH = "firm_id string, fiscal_year int, fiscal_period string, tag string, value double"


def test_refresh_replaces_only_recent_quarters(spark):
    stored = spark.createDataFrame(quarters(12, 1.0) + quarters(3, 9.0, "other"), REFRESH)
    fetched = spark.createDataFrame(quarters(13, 2.0), REFRESH)
    keys = ["firm_id", "fiscal_year", "fiscal_period", "tag"]
    got = RF.refresh(stored, fetched, ["firm_id"], ["fiscal_year", "fiscal_period"], keys, ["value"])
    values = [r["value"] for r in got.where("firm_id = 'f'").orderBy("fiscal_year", "fiscal_period").collect()]
    assert values == [1.0] * 4 + [2.0] * 9
    assert got.where("firm_id = 'other' AND value = 9").count() == 3


def test_refresh_drops_recent_rows_that_vanished(spark):
    stored = spark.createDataFrame(quarters(9, 1.0), REFRESH)
    fetched = spark.createDataFrame(quarters(2, 2.0), REFRESH)
    keys = ["firm_id", "fiscal_year", "fiscal_period", "tag"]
    got = RF.refresh(stored, fetched, ["firm_id"], ["fiscal_year", "fiscal_period"], keys, ["value"])
    assert rows(got.select("fiscal_year", "fiscal_period", "value")) == [(2018, "Q1", 1.0), (2018, "Q2", 2.0)]


def test_quarterly_last_skips_nulls(spark):
    df = spark.createDataFrame([("a", "2020-01-05", 1.0), ("a", "2020-02-05", 2.0), ("a", "2020-03-05", None)], "s string, d string, v double")
    got = RF.quarterly_last(df.withColumn("d", F.to_date("d")), ["s"], "d", "v", [])
    assert rows(got.select("quarter_end", "v"))[0][1] == 2.0


def test_active_firms(spark):
    firms = spark.createDataFrame([("a", "ok"), ("b", "ok"), ("c", "ok"), ("d", "failed")], "firm_id string, status string")
    filed = spark.createDataFrame([("a", "2020-01-01"), ("b", "2017-01-01")], "firm_id string, d string")
    got = FL.active_firms(firms, filed, "d", F.lit("2020-06-01").cast("date"), status="status")
    assert sorted(r["firm_id"] for r in got.collect()) == ["a", "d"]


def test_column_filters(spark):
    df = spark.createDataFrame([(1, None, "Valid", 1.0)] * 9 + [(2, 5.0, "Valid", None)], "a int, b double, c string, d double")
    assert FL.uninformative_columns(df) == ["b", "c", "d"]
    assert "b" in FL.drop_sparse_columns(df, ["b", "d"], 0.9).columns
    assert "b" not in FL.drop_sparse_columns(df, ["b", "d"], 0.8).columns


def test_missing_strata(spark):
    df = spark.createDataFrame([("train", "x"), ("train", "y"), ("val", "x"), ("test", "y"), ("test", "z")], "split string, s string")
    assert rows(J.missing_strata(df, "split", "s", ("train", "val", "test"))) == [("x", "test"), ("y", "val")]


def test_anti_join_keeps_null_keys(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    keys = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(J.not_in_set(df, keys, ["k"])) == [("b",), (None,)]
    assert rows(J.in_set(df, keys, ["k"])) == [("a",)]
