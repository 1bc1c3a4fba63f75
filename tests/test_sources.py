import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarterline.operators import lookups as L
from quarterline.operators import nested as N
from quarterline.sources import reports as RP
from quarterline.sources import tables as T


def test_folder_key_overrides_the_file(spark, tmp_path):
    for key in ("0000000007", "0000000012"):
        folder = tmp_path / f"cik={key}"
        folder.mkdir()
        pq.write_table(pa.table({"cik": ["wrong"], "value": [1.0]}), folder / "data.parquet")
    assert rows(T.read_keyed_folders(spark, str(tmp_path), "cik").select("cik")) == [("0000000007",), ("0000000012",)]


def test_file_key_comes_from_the_name(spark, tmp_path):
    for name in ("series_id=DFF.parquet", "series_id=GDP.parquet", "notes.parquet"):
        pq.write_table(pa.table({"value": [1.0]}), tmp_path / name)
    assert rows(T.read_keyed_files(spark, str(tmp_path), "series_id").select("series_id")) == [("DFF",), ("GDP",)]


def test_absent_source_is_empty_but_bad_files_are_not(spark, tmp_path):
    empty = T.read_or_empty(spark, str(tmp_path / "nothing"), "a int, b string")
    assert empty.columns == ["a", "b"] and empty.count() == 0
    (tmp_path / "text.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        T.read_or_empty(spark, str(tmp_path / "text.parquet"), "a int").count()


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    T.write_partitioned(df, path, ["p"], ["v"])
    T.replace_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path).select("v", "p")) == [(1, "a"), (9, "b")]


def test_replace_writes_snappy_files(spark, tmp_path):
    df = spark.range(5)
    T.replace_table(df, str(tmp_path / "out"))
    T.replace_table(df.limit(2), str(tmp_path / "out"))
    assert T.read_table(spark, str(tmp_path / "out"), "id bigint").count() == 2
    assert any(".snappy.parquet" in f.name for f in (tmp_path / "out").iterdir())


def test_daily_layout_and_firm_scan_push_filters(spark, tmp_path):
    df = spark.createDataFrame([("f1", "10-Q", "2020-01-01", 1.0), ("f2", "10-K", "2020-01-02", 2.0)], "firm_id string, form string, day string, v double")
    T.write_daily(df, str(tmp_path / "d"), "day", ["firm_id", "form"])
    assert sorted(f.name for f in (tmp_path / "d").iterdir() if f.is_dir()) == ["day=2020-01-01", "day=2020-01-02"]
    T.replace_table(df, str(tmp_path / "firms"))
    scan = T.read_firm(spark, str(tmp_path / "firms"), "f1", ["firm_id", "v"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(firm_id,f1)" in plan and "form" not in plan
    assert rows(scan) == [("f1", 1.0)]


def test_csv_json_and_companies(spark, tmp_path):
    df = spark.createDataFrame([("12", "ACM", "Acme")], "cik string, ticker string, name string")
    T.write_csv(df, str(tmp_path / "c.csv"))
    got = T.read_companies(spark, [str(tmp_path / "none.csv"), str(tmp_path / "c.csv")])
    assert rows(got) == [("0000000012", "ACM", "Acme")]
    assert T.read_companies(spark, [str(tmp_path / "none.csv")]).count() == 0
    T.write_records(df, str(tmp_path / "j"))
    assert rows(spark.read.json(str(tmp_path / "j")).select("name")) == [("Acme",)]


def test_retrain_flag_is_consumed(spark, tmp_path):
    path = str(tmp_path / "flag")
    assert RP.take_flag(spark, path) is None
    calm = spark.createDataFrame([(False, "")], "dataset_drift boolean, drifted_features string")
    assert not RP.raise_flag(calm, path) and RP.take_flag(spark, path) is None
    loud = spark.createDataFrame([(True, "roa,roe")], "dataset_drift boolean, drifted_features string")
    assert RP.raise_flag(loud, path)
    assert RP.take_flag(spark, path)["drifted_features"] == "roa,roe"
    assert RP.take_flag(spark, path) is None


DOC = """{"entityName": "x", "facts": {"us-gaap": {"Assets": {"label": "a", "units": {"USD": [
 {"form": "10-Q", "fp": "Q1", "fy": 2020, "val": 1000.5, "end": "2020-03-31", "filed": "2020-05-01", "frame": "CY2020Q1I"},
 {"form": "8-K", "fp": "Q1", "fy": 2020, "val": 7, "end": "2020-03-31", "filed": "2020-05-01"},
 {"form": "10-K", "fp": "FY", "fy": 2020, "val": 8, "end": "2020-12-31", "filed": "2021-02-01"}]}}}}}"""


def test_flatten_facts(spark):
    got = N.flatten_facts(spark.createDataFrame([("12", DOC), ("13", "{broken")], "firm_id string, doc string")).collect()
    assert len(got) == 1 and got[0]["firm_id"] == "0000000012" and got[0]["value"] == 1000.5 and got[0]["start_date"] is None


def test_zip_filings(spark):
    df = spark.sql("SELECT 'f' AS firm_id, named_struct('accessionNumber', array('a', 'b', 'c'), 'form', array('10-Q', '8-K', '10-K'), 'filingDate', array('2020-01-01', '2020-01-02', '2019-01-01')) AS recent")
    arrays = {"accessionNumber": "accession_number", "form": "form", "filingDate": "filing_date"}
    got = N.zip_filings(df, ("10-Q", "10-K"), "2019-06-01", arrays).collect()
    assert [(r["firm_id"], r["accession_number"]) for r in got] == [("f", "a")]


def test_observations(spark):
    doc = '{"observations": [{"date": "2020-01-01", "value": "1.5"}, {"date": "2020-02-01", "value": "."}]}'
    got = N.flatten_observations(spark.createDataFrame([("DFF", doc)], "series_id string, doc string"), ["series_id"])
    assert [r["value"] for r in got.orderBy("date").collect()] == [1.5, None]


def test_top_contributions_json(spark):
    df = spark.createDataFrame([(0.1, -0.5, 0.3, None)], "shap_a double, shap_b double, shap_c double, shap_d double")
    text = df.select(N.contributions_json(df, df.columns, 2).alias("j")).first()["j"]
    assert text == '[{"feature":"b","shap_value":-0.5,"rank":1},{"feature":"c","shap_value":0.3,"rank":2}]'
    parsed = spark.createDataFrame([(text,), ("",), ("{bad",), (None,)], "j string").select(F.size(L.parsed_features(F.col("j"))).alias("n"))
    assert [r["n"] for r in parsed.collect()] == [2, 0, 0, 0]


SCORES = "firm_id string, fiscal_year int, fiscal_period string, p double"


def test_alerts_use_the_best_score(spark):
    data = [("a", 2020, "Q1", 0.85), ("a", 2020, "Q2", 0.2), ("b", 2020, "Q1", 0.40), ("c", 2020, "Q1", 0.72)]
    companies = spark.createDataFrame([("a", "ACM", "Acme")], "firm_id string, ticker string, name string")
    got = L.alerts(spark.createDataFrame(data, SCORES), companies, "p", ["fiscal_year", "fiscal_period"])
    assert rows(got.select("firm_id", "p", "company_name")) == [("a", 0.85, "Acme (ACM)"), ("c", 0.72, "CIK c")]


def test_watchlist_change_and_signals(spark):
    scores = spark.createDataFrame([("AAA", 2020, "Q1", 0.3), ("AAA", 2020, "Q2", 0.8), ("BBB", 2020, "Q2", 0.1), ("CCC", 2020, "Q2", 0.01)], SCORES)
    panel = spark.createDataFrame(
        [("AAA", 2020, "Q1", 1.0, 1.0, 1.0, 100.0, 10.0, 0), ("AAA", 2020, "Q2", -5.0, 1.0, None, 100.0, 90.0, 1), ("BBB", 2020, "Q2", 5.0, 1.0, 1.0, 0.0, 90.0, 0)],
        "firm_id string, fiscal_year int, fiscal_period string, net_income double, operating_cash_flow double, retained_earnings double, total_assets double, total_liabilities double, distress_label int",
    )
    got = {r["firm_id"]: r for r in L.watchlist(scores, panel, "p").collect()}
    assert got["AAA"]["change"] == pytest.approx(0.5) and got["AAA"]["signals"] == "Neg. income · High leverage" and got["AAA"]["quarter"] == "Q2 2020"
    assert got["BBB"]["change"] == 0.0 and got["BBB"]["signals"] == "—"
    shown = L.watchlist_filter(L.watchlist(scores, panel, "p"))
    assert sorted(r["firm_id"] for r in shown.collect()) == ["AAA", "BBB"]


def test_malformed_quarters_find_nothing(spark):
    table = spark.createDataFrame([("f", 2025, "Q1", '[{"feature":"roa","shap_value":0.1,"rank":1}]')], "firm_id string, fiscal_year int, fiscal_period string, top_features_json string")
    asked = spark.createDataFrame([("f", "2025-Q1"), ("f", "2025Q1"), ("f", "x-Q1"), ("g", "2025-Q1")], "firm_id string, quarter string")
    got = L.top_features(table, asked).collect()
    assert [(r["quarter"], r["features"][0]["feature"]) for r in got] == [("2025-Q1", "roa")]


def test_keyed_folders_decode_and_prune(spark, tmp_path):
    rows = spark.createDataFrame([("a:b c", 1), ("007", 2)], "firm_id string, v int")
    T.write_partitioned(rows, str(tmp_path / "t"), ["firm_id"], ["v"])
    back = T.read_keyed_folders(spark, str(tmp_path / "t"), "firm_id")
    assert sorted((r.firm_id, r.v) for r in back.collect()) == [("007", 2), ("a:b c", 1)]
    plan = back.where("firm_id = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(firm_id" in plan and "firm_id" in plan.split("PartitionFilters")[1][:120]


def test_equal_keys_are_written_by_several_tasks(spark, tmp_path):
    spark.range(200_000).selectExpr("'d' AS day", "'t' AS ticker", "id").write.parquet(str(tmp_path / "in"))
    # Adaptive execution would join partitions as small as these again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        T.write_partitioned(spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "out"), ["day"], ["ticker"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "out" / "day=d").glob("part-*.parquet"))) > 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_need_no_exchange(spark, tmp_path):
    from pyspark.sql import Window

    df = spark.createDataFrame([(i % 5, i, float(i)) for i in range(50)], "firm int, quarter int, v double")
    one = T.store_bucketed(df, "bucketed_one", str(tmp_path / "one"), ["firm"], ["quarter"], buckets=4)
    two = T.store_bucketed(df.withColumn("w", F.col("v") * 2).drop("v"), "bucketed_two", str(tmp_path / "two"), ["firm"], ["quarter"], buckets=4)
    lagged = one.withColumn("before", F.lag("v").over(Window.partitionBy("firm").orderBy("quarter")))
    assert "Exchange" not in plan(lagged)
    assert rows(lagged.where("firm = 3").select("quarter", "before"))[:2] == [(13, 8.0), (18, 13.0)]
    joined = one.hint("merge").join(two, "firm").groupBy("firm").agg(F.count("*"))
    assert "Exchange" not in plan(joined) and len(rows(joined)) == 5
    for name in ("bucketed_one", "bucketed_two"):
        spark.sql(f"DROP TABLE {name}")


def test_hash_buckets_bound_the_folders_and_prune(spark, tmp_path):
    path = str(tmp_path / "b")
    df = spark.createDataFrame([(f"{i:010d}", float(i)) for i in range(500)] + [(None, -1.0)], "firm string, v double")
    for kind in ("parquet", "json"):
        T.write_hash_buckets(df, f"{path}-{kind}", "firm", 8, kind)
        assert len([f for f in (tmp_path / f"b-{kind}").iterdir() if f.is_dir()]) <= 8
        whole = T.read_hash_buckets(spark, f"{path}-{kind}", "firm string, v double", "firm", 8, kind=kind)
        assert rows(whole) == rows(df)
        one = T.read_hash_buckets(spark, f"{path}-{kind}", "firm string, v double", "firm", 8, "0000000123", kind)
        assert rows(one) == [("0000000123", 123.0)]
        filters = plan(one).split("PartitionFilters: [")[1].split("]")[0]
        assert "bucket" in filters
        read = {f.rsplit("bucket=", 1)[1].split("/")[0] for f in one.inputFiles()}
        assert len(read) >= 1


def test_a_folder_with_a_file_name_is_read_as_the_file(spark, tmp_path):
    spark.range(3).repartition(2).write.parquet(str(tmp_path / "in" / "series_id=GDP.parquet"))
    spark.range(2).write.parquet(str(tmp_path / "in" / "other.parquet"))
    assert rows(T.read_keyed_files(spark, str(tmp_path / "in"), "series_id").groupBy("series_id").count()) == [("GDP", 3)]


def test_buckets_are_dealt_without_a_pass_for_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda *a: pytest.fail("finding ranges makes the rows twice"))
    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    T.write_hash_buckets(df, str(tmp_path / "b"), "k", 4)
    assert rows(T.read_hash_buckets(spark, str(tmp_path / "b"), "k string, id long", "k", 4)) == rows(df)
    # Rows of one key lie in several pieces of its bucket.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dealt = T.dealt_over(df.where("k = 'hot'").withColumn("bucket", F.lit(1)), "bucket").select(F.spark_partition_id()).distinct().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert dealt > 1


def test_keyed_folders_with_a_known_schema_are_listed_once(spark, tmp_path):
    df = spark.createDataFrame([("01", 1), ("02", 2)], "k string, v int")
    df.write.partitionBy("k").parquet(str(tmp_path / "f"))
    assert rows(T.read_keyed_folders(spark, str(tmp_path / "f"), "k", df.schema).select("k", "v")) == [("01", 1), ("02", 2)]


def test_documents_are_dealt_once_and_land_compressed(spark, small, tmp_path):
    from quarterline.catalog.nested import documents

    df = documents(spark, small, 8)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and sorted(rows(df.drop("bucket")))[0] is not None
    path = str(tmp_path / "d")
    T.write_hash_buckets(df, path, "firm_id", 8, kind="json", dealt=True)
    files = [f.name for f in (tmp_path / "d").glob("bucket=*/part-*")]
    assert files and all(name.endswith(".json.gz") for name in files)
    landed = T.read_hash_buckets(spark, path, "firm_id string, doc string", "firm_id", 8, kind="json")
    assert landed.count() == documents(spark, small).count() == documents(spark, small).select("firm_id", "doc").distinct().count()
    one = landed.first()["firm_id"]
    found = T.read_hash_buckets(spark, path, "firm_id string, doc string", "firm_id", 8, one, "json")
    assert found.count() == landed.where(F.col("firm_id") == one).count() > 0
    entries = lambda d: N.flatten_facts(d).count()
    assert entries(landed) == entries(documents(spark, small))
