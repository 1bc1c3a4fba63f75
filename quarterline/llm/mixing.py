"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate that brings its characters to the target share. A document's number of copies is the inverse of
the Poisson distribution at a uniform number hashed from its id and the seed, so it is the same in every run and on every cluster; the
copies are exploded and dealt out over all partitions by a hash, which shuffles them globally in one exchange. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import partitions, stored

#: Steps of all sources together up to which they are broadcast (8 bytes each); more are joined by shuffle.
BROADCAST_STEPS = 1_000_000


def hashed_uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1): the first 52 bits of an md5 over the parts and the seed."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts], F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, power: float) -> DataFrame:
    """source, chars, rate: target weights in proportion to chars ** power, total size unchanged.

    power 1 leaves the mix as it is, 0 gives every source the same share. A null source is a source; one without characters has rate 1.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).cast("double").alias("chars"))
    whole = sizes.agg(F.sum("chars").alias("chars"), F.sum(F.pow("chars", F.lit(power))).alias("weights")).first()
    rate = F.lit(whole.chars) * F.pow("chars", F.lit(power)) / F.lit(whole.weights) / F.col("chars")
    return sizes.select("source", "chars", F.when(F.col("chars") > 0, rate).otherwise(1.0).alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """The distribution function at 0, 1, 2, ... as far as double precision tells its values from 1.

    Terms are carried as logarithms: exp(-rate) itself is 0 for rates above 745, which a source billions of times smaller than another gets.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct((-rate).alias("log"), F.array(F.exp(-rate)).alias("steps"))

    def step(state, k):
        log = state["log"] + F.log(rate) - F.log(k.cast("double"))
        return F.struct(log.alias("log"), F.concat(state["steps"], F.array(F.element_at(state["steps"], -1) + F.exp(log))).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step)["steps"]


def replicate(docs: DataFrame, rates: DataFrame, seed: int = 17) -> DataFrame:
    """Copies of the documents: all columns, `__copies`, `__copy` from 0 and `__place`, a hashed number that orders them globally.

    Copies number the steps of the source's distribution at or below the document's uniform number. Equal doc_ids get equal counts, a
    null doc_id counts as empty text; a source without a rate is kept as it is. Nulls in other columns pass through.
    """
    steps = stored(rates.select(F.col("source").alias("__source"), poisson_steps(F.col("rate")).alias("__steps")), "rates")
    small = (steps.agg(F.sum(F.size("__steps") + 1)).first()[0] or 0) <= BROADCAST_STEPS
    joined = docs.join(F.broadcast(steps) if small else steps, F.col("source").eqNullSafe(F.col("__source")), "left")
    u = hashed_uniform(seed, F.col("doc_id"))
    count = F.when(F.col("__steps").isNull(), 1).otherwise(F.size(F.filter("__steps", lambda x: x <= u)))
    copies = joined.withColumn("__copies", count).where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    placed = copies.withColumn("__place", hashed_uniform(seed + 1, F.col("doc_id"), F.col("__copy"))).drop("__source", "__steps")
    return placed.repartition(partitions(docs.sparkSession), "__place").sortWithinPartitions("__place")


def mix(docs: DataFrame, power: float = 0.7, seed: int = 17) -> DataFrame:
    """The documents mixed to weights in proportion to each source's characters ** power; the columns of `docs`."""
    named = docs.columns
    return replicate(docs, source_rates(docs, power), seed).select(*[F.col(f"`{c}`") for c in named])
