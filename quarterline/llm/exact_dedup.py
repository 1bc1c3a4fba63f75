"""Exact deduplication: a tree merge of sorted digest runs.

Every input partition becomes a run: one row per digest, sorted, with the best copy and the number of copies. Runs are then merged in
rounds, `fan_in` of them at a time (a binomial tree with wide nodes), until one run per shard is left. A shard is a slice of the digests,
so no round gathers more than a slice, and a digest that a third of the rows share arrives at each round as at most `fan_in` rows.

Rows are equal when digest, normalised length and a second hash agree, which verifies a digest match without carrying the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterline.llm.common import partitions, stored

BLANK = "[\\x20\\x09-\\x0D]+"
#: What equal texts share.
SAME = ["digest", "size", "second"]
#: Stands for a null id where rows are joined by id.
NAMELESS = -(1 << 63)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, chars (code points of the original), and what equal texts share."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .select("doc_id", F.length("text").cast("long").alias("chars"), F.regexp_replace("text", BLANK, "").alias("bare"))
        .select("doc_id", "chars", F.sha2(F.col("bare").cast("binary"), 256).alias("digest"),
                F.octet_length("bare").alias("size"), F.xxhash64("bare").alias("second"))
    )


def merge_runs(prints: DataFrame, shards: int, runs: int = 256, fan_in: int = 16) -> DataFrame:
    """One row per text: digest, size, second, best (the row that stays), copies.

    Of equal texts the one with the most code points stays, then the smallest doc_id; a null doc_id comes after all others.
    """
    level = prints.select(
        F.pmod(F.col("second"), F.lit(shards)).cast("int").alias("shard"),
        F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"),
        *SAME,
        F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("nameless"), "doc_id").alias("best"),
        F.lit(1).cast("long").alias("copies"),
    )
    while True:
        # The aggregate of a struct reads its input in key order: on sorted runs it is a merge.
        level = (
            level.repartition(partitions(prints.sparkSession), "shard", "run")
            .sortWithinPartitions("shard", "run", *SAME)
            .groupBy("shard", "run", *SAME)
            .agg(F.min("best").alias("best"), F.sum("copies").alias("copies"))
        )
        if runs == 1:
            return level.select(*SAME, F.col("best.doc_id").alias("keep_id"), F.col("copies").alias("group_size"))
        runs = -(-runs // fan_in)
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting [\\x20\\x09-\\x0D]; null counts as empty. Of rows that repeat doc_id and text exactly
    one is kept; the others of them count in group_size. Extra columns are ignored; an empty table gives an empty table.
    """
    prints = stored(fingerprints(docs), "digests")
    kept = merge_runs(prints, shards=4 * partitions(docs.sparkSession))
    number = F.row_number().over(W.partitionBy("doc_id", *SAME).orderBy(F.desc("chars")))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("number") == 1)
    return (
        prints.withColumn("number", number)
        .join(kept, SAME)
        .select("doc_id", "keep_id", "group_size", stays.alias("kept"), F.col("digest").alias("text_sha256"))
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, all columns as they were; of rows that repeat id and text one stays."""
    kept = merge_runs(fingerprints(docs), shards=4 * partitions(docs.sparkSession))
    keys = kept.select(F.coalesce("keep_id", F.lit(NAMELESS)).alias("__id"), F.col("digest").alias("__digest"))
    bare = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), BLANK, "")
    named = docs.columns
    rows = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NAMELESS))).withColumn("__digest", F.sha2(bare.cast("binary"), 256))
    first = F.row_number().over(W.partitionBy("__id", "__digest").orderBy(F.length("text").desc_nulls_last()))
    return rows.join(keys, ["__id", "__digest"]).withColumn("__n", first).where("__n = 1").select(*[F.col(f"`{c}`") for c in named])
