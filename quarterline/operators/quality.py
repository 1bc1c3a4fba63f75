"""Data quality: anomalies, validation reports, contracts and expectations as tables of findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.operators import folds
from quarterline.operators.dedup import duplicate_count
from quarterline.operators.ranks import group_quantiles
from quarterline.operators.reshape import lengthen
from quarterline.session import materialise

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def numeric_columns(df: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    return [n for n, t in df.dtypes if n not in without and (t in NUMERIC or t.startswith("decimal"))]


def require_finite(df: DataFrame, absent: list[str] | None = None) -> DataFrame:
    """Raise when a double column holds inf or a dropped column is back (one aggregate job)."""
    back = [c for c in absent or [] if c in df.columns]
    if back:
        raise ValueError(f"columns should have been dropped: {back}")
    doubles = [n for n, t in df.dtypes if t in ("double", "float")]
    counts = df.agg(*[F.count_if(F.abs(F.col(c)) == F.lit(float("inf"))).alias(c) for c in doubles]).first()
    infinite = [c for c in doubles if counts[c]]
    if infinite:
        raise ValueError(f"infinite values in columns: {infinite}")
    return df


def iqr_bounds(df: DataFrame, columns: list[str], factor: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """(feature, low, high) per column; columns whose range between quartiles is 0 or unknown are left out."""
    wanted = {"q1": 0.25, "q3": 0.75}
    if accuracy is not None or (quartiles := folds.group_summaries(df, [], columns, wanted)) is None:
        quartiles = group_quantiles(lengthen(df, [], columns), ["feature"], "value", wanted, accuracy)
    spread = F.col("q3") - F.col("q1")
    return quartiles.where(spread != 0).select(
        "feature", (F.col("q1") - factor * spread).alias("low"), (F.col("q3") + factor * spread).alias("high")
    )


def flag_anomalies(df: DataFrame, columns: list[str], factor: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """Rows with at least one value strictly outside its bounds (fitting runs a job: one row per column)."""
    bounds = {b["feature"]: (b["low"], b["high"]) for b in iqr_bounds(df, columns, factor, accuracy).collect()}
    names = [
        F.when((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1]), F.lit(c)) for c in columns if c in bounds
    ]
    found = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    flagged = df.withColumn("_found", found).where(F.size("_found") > 0)
    return flagged.withColumns(
        {"anomaly_count": F.size("_found"), "anomaly_columns": F.array_join("_found", ",")}
    ).drop("_found")


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, nulls, null_rate, rows) from one aggregate."""
    names = columns or df.columns
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    long = row.unpivot(["_rows"], names, "column_name", "nulls")
    return long.select("column_name", "nulls", F.try_divide(F.col("nulls"), F.col("_rows")).alias("null_rate"), F.col("_rows").alias("rows"))


def range_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, low, high) from one aggregate."""
    row = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.min(F.col(c).cast("double")).alias("low"), F.max(F.col(c).cast("double")).alias("high"))
                for c in columns
            ]
        ).alias("_all")
    )
    return row.select(F.inline("_all"))


def validation_report(df: DataFrame, required: list[str], key: list[str], columns: list[str]) -> DataFrame:
    """Long report (section, name, value): status, rows, missing columns, duplicates, nulls, ranges, anomalies."""
    missing = [c for c in required if c not in df.columns]
    present = [c for c in key if c in df.columns]
    counts = df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("rows").alias("section"), F.lit("row_count").alias("name"), "value")
    # The parts below are one row, or one row per column; kept, so that each is one pass over the data.
    if len(present) == len(key):
        repeats = materialise(duplicate_count(df, key)).select(F.col("duplicate_rows").cast("double").alias("value"))
    else:
        repeats = df.sparkSession.range(1).select(F.lit(0.0).alias("value"))
    repeats = repeats.select(F.lit("duplicates").alias("section"), F.lit("+".join(key)).alias("name"), "value")
    status = repeats.select(
        F.lit("status").alias("section"),
        F.lit("fail").alias("name"),
        ((F.col("value") > 0) | F.lit(bool(missing))).cast("double").alias("value"),
    )
    nulls = materialise(null_profile(df))
    parts = [
        status,
        counts,
        repeats,
        nulls.select(F.lit("null_count").alias("section"), F.col("column_name").alias("name"), F.col("nulls").cast("double").alias("value")),
        nulls.select(F.lit("null_rate").alias("section"), F.col("column_name").alias("name"), F.col("null_rate").alias("value")),
    ]
    ranges = materialise(range_profile(df, columns))
    parts += [
        ranges.select(F.lit("min").alias("section"), F.col("column_name").alias("name"), F.col("low").alias("value")),
        ranges.select(F.lit("max").alias("section"), F.col("column_name").alias("name"), F.col("high").alias("value")),
    ]
    bounds = {b["feature"]: (b["low"], b["high"]) for b in iqr_bounds(df, columns).collect()}
    flags = {c: (F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1]) if c in bounds else F.lit(False) for c in columns}
    outside = df.agg(
        F.count_if(reduce(lambda a, b: a | b, flags.values())).cast("double").alias("anomalous_rows"),
        *[F.count_if(flag).cast("double").alias(c) for c, flag in flags.items()],
    )
    parts.append(outside.unpivot([], ["anomalous_rows", *columns], "name", "value").select(F.lit("anomalies").alias("section"), "name", "value"))
    return reduce(DataFrame.unionByName, parts)


def findings(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, rows) for every rule that some row breaks; `rules` maps a text to its breaking condition."""
    counted = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    entries = F.array(*[F.struct(F.lit(text).alias("rule"), F.col(f"r{i}").alias("rows")) for i, text in enumerate(rules)])
    return counted.select(F.inline(entries)).where(F.col("rows") > 0)


def _findings_text(df: DataFrame, known: list[str], counts: dict[str, Column]) -> DataFrame:
    """(error): the texts known beforehand, and each text whose aggregate gives a number of rows, with that number."""
    head = df.sparkSession.createDataFrame([(text,) for text in known], "error string")
    if not counts:
        return head
    row = df.agg(*[n.alias(f"n{i}") for i, n in enumerate(counts.values())])
    # A text whose count is null drops out of the array.
    texts = [F.concat(F.lit(f"{text}, rows: "), F.col(f"n{i}").cast("string")) for i, text in enumerate(counts)]
    return head.unionByName(row.select(F.explode(F.array_compact(F.array(*texts))).alias("error")))


def _some(bad: Column) -> Column:
    """Rows that meet the condition; null without any."""
    return F.nullif(F.count_if(bad), F.lit(0).cast("long"))


def input_findings(df: DataFrame, identity: list[str], label: str = "distress_label") -> DataFrame:
    """Structural faults before scoring: an absent identity column, a feature with text that is no number, a feature without values."""
    known = [f"identity column {c} is absent" for c in identity if c not in df.columns]
    counts = {}
    for c in df.columns:
        if c not in identity and c != label:
            counts[f"feature {c} holds text"] = _some(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull())
            counts[f"feature {c} has no value"] = F.when(F.count(F.col(c)) == 0, F.count(F.lit(1)))
    return _findings_text(df, known, counts)


# The patterns of versions, schema versions and score paths that the contracts ask for.
VERSION, SCHEMA_VERSION, SCORE_PATH = r"^v\d+", r"^\d+\.\d+$", r"^gs://.*\.parquet$"


def score_rules(columns: list[str]) -> dict[str, Column]:
    """The row contract of a score table as breaking conditions."""
    c = F.col
    rules = {
        "firm_id is present": c("firm_id").isNull(),
        "distress_probability in [0, 1]": c("distress_probability").isNull() | ~c("distress_probability").between(0, 1),
        "confidence_interval_lower in [0, 1]": ~c("confidence_interval_lower").between(0, 1),
        "confidence_interval_upper in [0, 1]": ~c("confidence_interval_upper").between(0, 1),
        "model_version looks like v1": c("model_version").isNull() | ~c("model_version").rlike(VERSION),
        "mlflow_run_id is not empty": c("mlflow_run_id").isNull() | (F.length("mlflow_run_id") < 1),
        "model_roc_auc in [0, 1]": c("model_roc_auc").isNull() | ~c("model_roc_auc").between(0, 1),
    }
    return {text: bad for text, bad in rules.items() if any(name in text for name in columns)}


# The columns a score table must have, and those of them that say which run made a row.
SCORE_COLUMNS = ["firm_id", "distress_probability", "model_version", "mlflow_run_id", "scored_at"]
RUN_COLUMNS = ["model_version", "mlflow_run_id", "scored_at"]


def output_findings(df: DataFrame) -> DataFrame:
    """Faults of a score table: absent columns, probabilities that are none, rows that don't say which run made them."""
    known = [f"score column {c} is absent" for c in SCORE_COLUMNS if c not in df.columns]
    counts = {f"{c} is null": _some(F.col(c).isNull()) for c in RUN_COLUMNS if c in df.columns}
    if "distress_probability" in df.columns:
        counts["distress_probability is not in [0, 1]"] = _some(~F.col("distress_probability").between(0, 1))
    return _findings_text(df, known, counts)


def manifest_rules() -> dict[str, Column]:
    """Contract of a one-row batch manifest."""
    c = F.col
    return {
        "schema_version is N.N": c("schema_version").isNull() | ~c("schema_version").rlike(SCHEMA_VERSION),
        "model_name is not empty": c("model_name").isNull() | (F.length("model_name") < 1),
        "model_version looks like v1": c("model_version").isNull() | ~c("model_version").rlike(VERSION),
        "mlflow_run_id is not empty": c("mlflow_run_id").isNull() | (F.length("mlflow_run_id") < 1),
        "trained_at is a time": c("trained_at").try_cast("timestamp").isNull(),
        "scored_at is a time": c("scored_at").try_cast("timestamp").isNull(),
        "roc_auc in [0, 1]": c("roc_auc").isNull() | ~c("roc_auc").between(0, 1),
        "prediction_horizon at least 1": c("prediction_horizon").isNull() | (c("prediction_horizon") < 1),
        "features_used is not empty": c("features_used").isNull() | (F.size("features_used") < 1),
        "row_count is positive": c("row_count").isNull() | (c("row_count") <= 0),
        "scores path is a gs parquet path": c("gcs_scores_path").isNull() | ~c("gcs_scores_path").rlike(SCORE_PATH),
        "duration is not negative": c("inference_duration_seconds").isNull() | (c("inference_duration_seconds") < 0),
    }


def identity_share(tolerance: float = 1.0, relative: float = 1e-5) -> Column:
    """Share of rows where assets equal liabilities plus equity within the tolerance."""
    right = F.col("Liabilities") + F.col("StockholdersEquity")
    return F.avg((F.abs(F.col("Assets") - right) <= tolerance + relative * F.abs(right)).cast("int"))
