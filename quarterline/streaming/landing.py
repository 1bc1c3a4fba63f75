"""Incremental landing and refresh as Structured Streaming jobs.

State is a keyed table in generations (`sources.generations`): a micro-batch rewrites the hash buckets of its keys into its own folder with
overwrite, so a replayed batch leaves the same files, and its work doesn't grow with the batches before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarterline.operators.dedup import keep_latest
from quarterline.operators.refresh import refresh
from quarterline.sources import generations as GN


def file_stream(spark: SparkSession, folder: str, pattern: str, schema: StructType | str) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process what has arrived, one call of `each` per micro-batch, then stop."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True)
    writer.start().awaitTermination()


def land_latest(stream: DataFrame, path: str, checkpoint: str, keys: list[str], moment: str, ties: list[str], buckets: int = 64) -> None:
    """Keep the latest row per key over all batches. A batch reads and rewrites the buckets of its keys only."""

    def merge(stored: DataFrame, rows: DataFrame) -> DataFrame:
        return keep_latest(stored.unionByName(rows), keys, moment, ties)

    run_available(stream, checkpoint, lambda rows, batch: GN.rewrite(rows, batch, path, keys, merge, buckets))


def without_repeats(stream: DataFrame, moment: str, delay: str, keys: list[str]) -> DataFrame:
    """Drop events that repeat a key within the watermark delay."""
    return stream.withWatermark(moment, delay).dropDuplicatesWithinWatermark(keys)


def landed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The latest row per key over all batches, as stored."""
    return GN.read_current(spark, path, schema)


def refresh_batch(
    rows: DataFrame, batch: int, path: str, owner: list[str], period: list[str], keys: list[str], ties: list[str], n: int = 8, buckets: int = 64
) -> None:
    """Take a batch in under the refresh rule: an owner's periods older than its n newest stored ones stay.

    A period is stored while it has rows, so one that a fetch dropped is not. Only the buckets of the batch's owners are read and written.
    """

    def merge(stored: DataFrame, fetched: DataFrame) -> DataFrame:
        return refresh(stored, fetched, owner, period, keys, ties, n)

    GN.rewrite(rows, batch, path, owner, merge, buckets)


def refresh_stream(
    stream: DataFrame, path: str, checkpoint: str, owner: list[str], period: list[str], keys: list[str], ties: list[str], n: int = 8, buckets: int = 64
) -> None:
    run_available(stream, checkpoint, lambda rows, batch: refresh_batch(rows, batch, path, owner, period, keys, ties, n, buckets))


def refreshed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows after the last batch, one per key."""
    return GN.read_current(spark, path, schema)


def downsample(stream: DataFrame, moment: str, value: str, series: list[str], length: str, delay: str) -> DataFrame:
    """Last value per series and tumbling window; windows close when the watermark passes them."""
    return (
        stream.withWatermark(moment, delay)
        .groupBy(F.window(moment, length), *series)
        .agg(F.max(F.struct(F.col(moment).alias("at"), F.col(value).alias("v"))).alias("_last"), F.count(F.lit(1)).alias("rows"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *series, F.col("_last.v").alias(value), "rows"
        )
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append-mode stream over what has arrived and read its sink."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
