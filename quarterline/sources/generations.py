"""A keyed table that batches rewrite in part: rows lie in hash buckets of their key, and a batch writes a new generation of the buckets it
touches. What a batch reads and writes depends on the size of those buckets, not on how many batches came before.

    <path>/rows/generation=<batch>/bucket=<k>/...    rows of a bucket as a batch left them
    <path>/map/batch=<batch>                         bucket -> generation after that batch, one row per bucket that has rows

A batch reads the map of the batch before it and overwrites its own folders, so a replay leaves the same files. Generations that neither
its own nor the map before it names are removed; a reader of the map before the last one still finds its files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quarterline.session import exists, remove, subfolders
from quarterline.sources.tables import bucket_of, dealt_over

MAP = "bucket int, generation long"


def _map_path(path: str, batch: int) -> str:
    return f"{path}/map/batch={batch}"


def _map_of(spark: SparkSession, path: str, batch: int) -> dict[int, int]:
    """Bucket -> generation after a batch (at most one entry per bucket)."""
    if batch < 0 or not exists(spark, _map_path(path, batch)):
        return {}
    return {r["bucket"]: r["generation"] for r in spark.read.schema(MAP).parquet(_map_path(path, batch)).collect()}


def last_batch(spark: SparkSession, path: str) -> int:
    """The newest batch with a map, -1 without one."""
    names = subfolders(spark, f"{path}/map")
    return max((int(n.split("=")[1]) for n in names if n.startswith("batch=") and exists(spark, f"{path}/map/{n}/_SUCCESS")), default=-1)


def _folder(path: str, bucket: int, generation: int) -> str:
    return f"{path}/rows/generation={generation}/bucket={bucket}"


def read_buckets(spark: SparkSession, path: str, schema: StructType, held: dict[int, int]) -> DataFrame:
    folders = [_folder(path, b, g) for b, g in sorted(held.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_current(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table after the last batch; empty before the first one."""
    typed = spark.createDataFrame([], schema).schema
    return read_buckets(spark, path, typed, _map_of(spark, path, last_batch(spark, path)))


def rewrite(rows: DataFrame, batch: int, path: str, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64) -> None:
    """Take a batch in: in the buckets of its keys the stored rows become merge(stored, rows); others stay as they are.

    `merge` must look at rows of one key only. Batches come in order, each perhaps more than once; a batch without rows changes nothing.
    """
    spark = rows.sparkSession
    maps = [int(n.split("=")[1]) for n in subfolders(spark, f"{path}/map")]
    # Only a few maps are left at any time; a batch without rows may have left none.
    before = max((b for b in maps if b < batch), default=-1)
    held = _map_of(spark, path, before)
    marked = rows.withColumn("bucket", bucket_of(keys, buckets)).persist()
    try:
        touched = {r["bucket"] for r in marked.select("bucket").distinct().collect()}
        stored = read_buckets(spark, path, rows.schema, {b: g for b, g in held.items() if b in touched})
        merged = merge(stored, marked.drop("bucket")).select(*rows.columns).withColumn("bucket", bucket_of(keys, buckets))
        target = f"{path}/rows/generation={batch}"
        dealt_over(merged, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
    finally:
        marked.unpersist()
    written = {int(n.split("=")[1]) for n in subfolders(spark, target) if n.startswith("bucket=")}
    now = {b: g for b, g in held.items() if b not in touched} | {b: batch for b in written}
    spark.createDataFrame(sorted(now.items()), MAP).coalesce(1).write.mode("overwrite").parquet(_map_path(path, batch))
    # What the map before the last one alone still names can go.
    for number in (b for b in maps if b < before):
        for bucket, generation in _map_of(spark, path, number).items():
            if held.get(bucket) != generation:
                remove(spark, _folder(path, bucket, generation))
        remove(spark, _map_path(path, number))
