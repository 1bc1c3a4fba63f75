"""Table sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarterline.functions.scalars import zero_pad


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet folder or file; an explicit schema skips inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_by_suffix(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header when the path says so, else Parquet."""
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    return read_table(spark, path, schema)


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """An empty table of the schema when nothing is stored yet; other failures surface."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_keyed_folders(spark: SparkSession, path: str, key: str, inside: StructType | None = None) -> DataFrame:
    """Files under `<key>=<id>/`: the folder names the key as text (leading zeros stay) and overrides the file.

    The key is a partition column, so its value comes back decoded and a filter on it skips folders. Where the schema of the files is known,
    `inside` spares a listing of all folders.
    """
    inside = spark.read.option("recursiveFileLookup", True).parquet(path).schema if inside is None else inside
    schema = StructType([*(f for f in inside if f.name != key), StructField(key, StringType())])
    return read_table(spark, path, schema).where(F.col(key).isNotNull())


def read_keyed_files(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Files called `<key>=<id>.parquet`; other names are skipped."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    # A folder that a job wrote under such a name counts as the file.
    found = F.regexp_extract(F.col("_metadata.file_path"), f"/{key}=([^/]+)\\.parquet(?:/[^/]*)?$", 1)
    others = [c for c in rows.columns if c != key]
    return rows.select(*others, found.alias(key)).where(F.col(key) != "")


def read_firm(spark: SparkSession, path: str, firm: str, columns: list[str]) -> DataFrame:
    """Pruned and filtered scan of one firm; with rows sorted by firm, row groups are skipped."""
    return spark.read.parquet(path).where(F.col("firm_id") == firm).select(*columns)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_table(df: DataFrame, name: str, path: str, location: str | None = None) -> None:
    """Replace a catalog table (at `location` when given) and export it as Snappy Parquet."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(name)
    df.sparkSession.table(name).write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_partitioned(df: DataFrame, path: str, partition: list[str], sort: list[str], kind: str = "parquet") -> None:
    """Folders per partition value, rows sorted inside the files.

    Ranging on partition and sort columns and a row hash splits a hot partition, and a hot sort key, over many tasks.
    """
    others = [c for c in df.columns if c not in (*partition, *sort)]
    spread = df.repartitionByRange(*partition, *sort, *([F.xxhash64(*others)] if others else []))
    ranged = spread.sortWithinPartitions(*partition, *sort)
    ranged.write.mode("overwrite").partitionBy(*partition).format(kind).save(path)


def spread_over(df: DataFrame, partition: list[str]) -> DataFrame:
    """Range on the partition columns and a row hash: few files per partition, no task with a hot one."""
    others = [c for c in df.columns if c not in partition]
    return df.repartitionByRange(*partition, F.xxhash64(*others))


def dealt_over(df: DataFrame, bucket: str, pieces: int = 16) -> DataFrame:
    """Hash on a bucket and a piece of it: at most `pieces` files per bucket, no task with a hot one. For a bounded number of buckets.

    Ranges would be found by a pass over the rows, which makes all that leads to them twice.
    """
    others = [c for c in df.columns if c != bucket]
    return df.repartition(bucket, F.pmod(F.xxhash64(*others), F.lit(pieces)))


def write_daily(df: DataFrame, path: str, day: str, cluster: list[str]) -> None:
    """Day partitions clustered by the given columns."""
    write_partitioned(df.withColumn(day, F.to_date(day)), path, [day], cluster)


def replace_partitions(df: DataFrame, path: str, partition: list[str]) -> None:
    """Overwrite only the partitions that occur in `df`; a hot one is spread over several tasks."""
    spread_over(df, partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def dealt_by_key(df: DataFrame, key: str, within: Column, buckets: int, pieces: int = 16) -> DataFrame:
    """Rows dealt by the key's bucket and a piece of it by `within`, then given both, `bucket` and `piece`: groups by these, key and within need no more exchange."""
    bucket, piece = bucket_of([key], buckets), F.pmod(F.xxhash64(within), F.lit(pieces))
    return df.repartition(bucket, piece).withColumns({"bucket": bucket, "piece": piece})


def write_hash_buckets(df: DataFrame, path: str, key: str, buckets: int = 256, kind: str = "parquet", dealt: bool = False) -> None:
    """A folder per hash bucket of the key, which stays in the files: as many folders for millions of keys as for a thousand.

    `dealt`: the rows come with their bucket and as `dealt_by_key` left them, so they aren't sent again. JSON is compressed.
    """
    rows = df if dealt else dealt_over(df.withColumn("bucket", bucket_of([key], buckets)), "bucket")
    writer = rows.sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket")
    (writer.option("compression", "gzip") if kind == "json" else writer).format(kind).save(path)


def read_hash_buckets(spark: SparkSession, path: str, schema: str, key: str, buckets: int = 256, value: str | None = None, kind: str = "parquet") -> DataFrame:
    """What `write_hash_buckets` wrote with as many buckets; with `value` the rows of that key, from its bucket's folder only."""
    rows = spark.read.schema(f"{schema}, bucket int").format(kind).load(path)
    if value is not None:
        kept = F.lit(value).cast(rows.schema[key].dataType)
        rows = rows.where((F.col("bucket") == F.pmod(F.xxhash64(kept), F.lit(buckets)).cast("int")) & (F.col(key) == kept))
    return rows.drop("bucket")


def store_bucketed(df: DataFrame, name: str, location: str, keys: list[str], sort: list[str], buckets: int = 64) -> DataFrame:
    """A catalog table whose files are bucketed by the keys and sorted in each, so windows and joins on the keys need no exchange."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").option("path", location).bucketBy(buckets, *keys).sortBy(*keys, *sort).saveAsTable(name)
    return df.sparkSession.table(name)


def write_json_lines(df: DataFrame, path: str, partition: list[str]) -> None:
    spread_over(df, partition).write.mode("overwrite").partitionBy(*partition).json(path)


def write_documents(df: DataFrame, path: str, partition: list[str], text: str = "doc") -> None:
    """Raw documents as text lines under partition folders."""
    spread_over(df.select(*partition, text), partition).write.mode("overwrite").partitionBy(*partition).text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_companies(spark: SparkSession, paths: list[str]) -> DataFrame:
    """firm_id, ticker, name from the first path that exists; the id column may be called cik."""
    for path in paths:
        try:
            rows = spark.read.option("header", True).csv(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        key = "firm_id" if "firm_id" in rows.columns else "cik"
        name = F.col("name") if "name" in rows.columns else F.lit(None).cast("string")
        ticker = F.col("ticker") if "ticker" in rows.columns else F.lit(None).cast("string")
        return rows.select(zero_pad(F.col(key)).alias("firm_id"), ticker.alias("ticker"), name.alias("name"))
    return spark.createDataFrame([], "firm_id string, ticker string, name string")
