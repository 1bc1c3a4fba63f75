import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarterline.operators import balance as BA
from quarterline.operators import profile as P
from quarterline.operators import quality as QU
from quarterline.operators import reshape as R
from quarterline.operators import splits as SP


def test_extreme_row_is_flagged(spark):
    data = [(i, 100.0 + i, 50.0 + i, 7.0) for i in range(9)] + [(9, 1000.0, 800.0, 7.0)]
    df = spark.createDataFrame(data, "k int, assets double, liabilities double, flat double")
    got = QU.flag_anomalies(df, ["assets", "liabilities", "flat"]).collect()
    assert [(r["k"], r["anomaly_count"], r["anomaly_columns"]) for r in got] == [(9, 2, "assets,liabilities")]


def test_report_counts_duplicates_and_missing_columns(spark):
    df = spark.createDataFrame([("1", "x", 1.0), ("1", "x", 2.0), ("2", "y", None)], "cik string, accession_number string, assets double")
    report = {(r["section"], r["name"]): r["value"] for r in QU.validation_report(df, ["cik", "ticker"], ["cik", "accession_number"], ["assets"]).collect()}
    assert report[("duplicates", "cik+accession_number")] == 1 and report[("status", "fail")] == 1
    assert report[("null_count", "assets")] == 1 and report[("max", "assets")] == 2
    clean = QU.validation_report(df.limit(1), ["cik"], ["cik", "accession_number"], ["assets"]).where("section = 'status'").first()
    assert clean["value"] == 0


def test_require_finite(spark):
    with pytest.raises(ValueError, match="infinite"):
        QU.require_finite(spark.createDataFrame([(float("inf"),)], "x double"))
    with pytest.raises(ValueError, match="dropped"):
        QU.require_finite(spark.createDataFrame([(1.0,)], "x double"), absent=["x"])


def test_input_findings(spark):
    good = spark.createDataFrame([("f", 2020, "Q1", 1.0)], "firm_id string, fiscal_year int, fiscal_period string, x double")
    identity = ["firm_id", "fiscal_year", "fiscal_period"]
    assert QU.input_findings(good, identity).count() == 0
    bad = good.drop("firm_id").withColumns({"t": F.lit("abc"), "n": F.lit(None).cast("double")})
    errors = " ".join(r["error"] for r in QU.input_findings(bad, identity).collect())
    assert "identity column firm_id is absent" in errors
    assert "feature t holds text, rows: 1" in errors and "feature n has no value, rows: 1" in errors and "feature x" not in errors


SCORES = "firm_id string, distress_probability double, model_version string, mlflow_run_id string, scored_at string"


def test_output_findings(spark):
    good = spark.createDataFrame([("f", 0.5, "v1", "r", "now")], SCORES)
    assert QU.output_findings(good).count() == 0
    bad = spark.createDataFrame([("f", 1.5, None, "r", "now")], SCORES).drop("scored_at")
    assert len(QU.output_findings(bad).collect()) == 3


def valid_manifest(spark):
    values = {
        "schema_version": "1.0", "model_name": "m", "model_version": "v1", "mlflow_run_id": "r", "trained_at": "2020-01-01T00:00:00",
        "scored_at": "2020-01-02T00:00:00", "roc_auc": 0.9, "prediction_horizon": 1, "row_count": 5, "gcs_scores_path": "gs://b/s.parquet",
        "inference_duration_seconds": 0.1,
    }
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.array(F.lit("roa")).alias("features_used"))


@pytest.mark.parametrize(
    "column,value",
    [("row_count", 0), ("roc_auc", 1.1), ("prediction_horizon", 0), ("gcs_scores_path", "s3://b/s.parquet"), ("gcs_scores_path", "gs://b/s.csv"), ("model_version", "1"), ("model_name", ""), ("trained_at", "x"), ("schema_version", "one")],
)
def test_manifest_rules(spark, column, value):
    good = valid_manifest(spark)
    assert QU.findings(good, QU.manifest_rules()).count() == 0
    assert QU.findings(good.withColumn(column, F.lit(value)), QU.manifest_rules()).count() == 1


def split_sample(spark):
    data = []
    for year, n, positives in ((2009, 8, 0), (2010, 24, 6), (2011, 24, 6), (2012, 16, 3), (2013, 16, 3)):
        for i in range(n):
            data.append((f"f{year}{i}", year, "Q1", "small" if i % 2 else "mega", "tech" if i else "rare", float(i), None if i % 5 == 0 else float(i * 2), int(i < positives)))
    return spark.createDataFrame(data, "firm_id string, fiscal_year int, fiscal_period string, company_size_bucket string, sector_proxy string, feature_a double, feature_b double, distress_label int")


def parts(spark):
    return SP.by_years(split_sample(spark), (2010, 2011), (2012, 2012), (2013, 2013), exclude=(2009,))


def test_splits_do_not_leak(spark):
    df = SP.require_no_leakage(parts(spark))
    assert rows(df.groupBy("split").agg(F.count("*"))) == [("test", 16), ("train", 48), ("val", 16)]
    assert not df.where("fiscal_year = 2009").count()
    bad = SP.by_years(split_sample(spark), (2010, 2012), (2012, 2012), (2013, 2013))
    SP.require_no_leakage(bad)  # rows of a shared year go to the first split only
    with pytest.raises(ValueError, match="leakage"):
        SP.require_no_leakage(df.withColumn("fiscal_year", F.when(F.col("split") == "val", 2009).otherwise(F.col("fiscal_year"))))


def test_rare_strata_become_other(spark):
    df = SP.with_strata(split_sample(spark), ["company_size_bucket", "sector_proxy"], 10)
    assert {r["_strat_key"] for r in df.collect()} == {"small__tech", "mega__tech", "other"}


def test_scaler_is_fitted_on_train_only(spark):
    df = parts(spark)
    fitted = SP.fit_scaler(df.where("split = 'train'"), ["feature_a", "feature_b"])
    scaled = SP.apply_scaler(df, fitted)
    train = scaled.where("split = 'train'").agg(F.avg("feature_a"), F.stddev_pop("feature_a"), F.avg("feature_b"), F.count_if(F.col("feature_b").isNull())).first()
    assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1) and train[2] == pytest.approx(0, abs=1e-9) and train[3] == 0
    median = {r["feature"]: r["median"] for r in fitted.collect()}
    assert median["feature_a"] == 11.5


def test_class_weight(spark):
    row = P.class_weight(parts(spark).where("split = 'train'"), "distress_label").first()
    assert (row["n_positive"], row["n_negative"], row["scale_pos_weight"]) == (12, 36, 3.0)
    none = P.class_weight(spark.createDataFrame([(0,)], "y int"), "y").first()
    assert none["scale_pos_weight"] == 1.0


def test_feature_columns_leave_identity_out(spark):
    assert SP.feature_columns(parts(spark)) == ["feature_a", "feature_b"]
    with pytest.raises(ValueError):
        SP.without_label(parts(spark).drop("distress_label"))


@pytest.mark.parametrize("block_rows", [1000, 5])
def test_oversampling_balances_between_neighbours(spark, block_rows):
    train = parts(spark).where("split = 'train'")
    made = BA.oversample(train, ["feature_a", "feature_b"], "distress_label", ["firm_id"], block_rows=block_rows)
    assert rows(made.groupBy("distress_label").agg(F.count("*"))) == [(0, 36), (1, 36)]
    synthetic = made.where("synthetic").collect()
    real = [(r["feature_a"], r["feature_b"] or 0.0) for r in train.where("distress_label = 1").collect()]
    assert all(r["firm_id"] is None and min(a for a, _ in real) <= r["feature_a"] <= max(a for a, _ in real) for r in synthetic)


def nearest(xy, k):
    return {(i, j) for i in xy for _, j in sorted((sum((a - b) ** 2 for a, b in zip(xy[i], xy[j])), j) for j in xy if j != i)[:k]}


def test_neighbours_in_one_block_are_the_nearest(spark):
    xy = {i: (float((i * 37) % 101), float((i * 17) % 23)) for i in range(60)}
    points = spark.createDataFrame([(i, list(p)) for i, p in xy.items()], "_row bigint, _x array<double>")
    assert set(map(tuple, BA.nearest_rows(points, 60, 5).select("_row", "_neighbour").collect())) == nearest(xy, 5)


def test_neighbours_over_many_blocks_are_mostly_the_nearest(spark):
    """Clusters in twelve dimensions, blocks of a tenth of the rows: every row has its k, nine of ten are the nearest."""
    import random

    rng = random.Random(3)
    centres = [[rng.gauss(0, 6) for _ in range(12)] for _ in range(30)]
    xy = {i: tuple(c + rng.gauss(0, 1) for c in centres[i % 30]) for i in range(900)}
    points = spark.createDataFrame([(i, list(p)) for i, p in xy.items()], "_row bigint, _x array<double>")
    got = set(map(tuple, BA.nearest_rows(points, 900, 5, block_rows=90).select("_row", "_neighbour").collect()))
    assert len(got) == 900 * 5 and len(got & nearest(xy, 5)) / len(got) > 0.9


def test_rows_are_sent_about_once_a_direction(spark):
    """Both cuts share a stretch of blocks: 8,000 rows along four directions are sent 4.2 times each at most, where it was eight times."""
    points = spark.range(8000).select(F.col("id").alias("_row"), F.array(F.rand(1), F.rand(2)).alias("_x"))
    dealt = BA._dealt(points, (0, 16), 32, 4, 42).groupBy("_turn").agg(F.count("*"), F.count_distinct("_row")).collect()
    assert len(dealt) == 4 and all(8000 == distinct <= n <= 1.05 * 8000 for _, n, distinct in dealt)


def test_alignment_and_indicators(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, "x")], "k int, a double, c string")
    assert rows(R.aligned(df, ["k"], ["a", "b"])) == [(1, 2.0, 0.0), (2, 0.0, 0.0)]
    assert rows(R.indicators(df, "c", ["x"]).select("k", "c_x", "c_nan")) == [(1, 0, 1), (2, 1, 0)]


def test_unpivot_keeps_null_values(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "k int, a double, b double")
    assert rows(R.lengthen(df, ["k"], ["a", "b"])) == [(1, "a", None), (1, "b", 2.0)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "x double")
    assert rows(P.histograms(df, ["x"], 10)) == [("x", 0, 1), ("x", 5, 1), ("x", 9, 1)]


@pytest.mark.parametrize("name", ["q2_panel_anomalies", "l3_scale", "g19_five_numbers_by_sector"])
def test_quantiles_read_stored_rows(spark, small, monkeypatch, name):
    from quarterline.catalog.registry import QUERIES
    from quarterline.operators import folds

    read, summaries = [], folds.summaries
    monkeypatch.setattr(folds, "summaries", lambda df, *a, **k: read.append(df.inputFiles()) or summaries(df, *a, **k))
    QUERIES[name](spark, small)
    assert read == [[]]
