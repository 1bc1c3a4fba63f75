"""A corpus pipeline: quality, exact copies, near copies, mix of sources, packing.

Each stage takes (spark, docs, sf_dir) and all that the stage before kept; its result is written as Parquet and read again as the next
one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterline.llm import exact_dedup, mixing, near_dedup, packing, quality
from quarterline.llm.common import stored, table
from quarterline.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney model of the labelled good ones doesn't reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return near_dedup.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson draws to source weights in proportion to size ** 0.7."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Stages run a trained model, MinHash and a tokenizer, which SQL can't express; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
