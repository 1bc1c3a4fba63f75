"""One-row JSON reports: manifests, summaries and the retrain flag."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(row: DataFrame, path: str) -> None:
    """A one-row table as a JSON object; the row is already an aggregate."""
    row.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.text(path).select(F.from_json("value", schema).alias("_r")).select("_r.*")


def raise_flag(decision: DataFrame, path: str, reason: str = "dataset_drift") -> bool:
    """Write the retrain flag when the one-row decision asks for it."""
    wanted = decision.where("dataset_drift").select(F.lit(reason).alias("reason"), "drifted_features")
    if wanted.isEmpty():
        return False
    write_report(wanted.withColumn("triggered_at", F.current_timestamp().cast("string")), path)
    return True


def take_flag(spark: SparkSession, path: str) -> dict | None:
    """Read the flag and consume it: it becomes an empty report. None when there is no flag."""
    schema = "reason string, drifted_features string, triggered_at string"
    try:
        rows = read_report(spark, path, schema).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if not rows:
        return None
    spark.createDataFrame([], "value string").write.mode("overwrite").text(path)
    return rows[0].asDict()


def manifest(scores: DataFrame, **values: object) -> DataFrame:
    """The batch manifest: fixed fields plus the row count of the score table."""
    counted = scores.agg(F.count(F.lit(1)).alias("row_count"))
    fields = {n: F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v) for n, v in values.items()}
    return counted.withColumns(fields)
