"""Rolling drift counters: bin counts per window against a fixed reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.operators.profile import bin_of
from quarterline.operators.slices import SMOOTHING


def window_bins(stream: DataFrame, moment: str, value: str, low: float, high: float, length: str, delay: str, bins: int = 10) -> DataFrame:
    """Rows per tumbling window and bin of the reference range; values outside fall in the edge bins."""
    inside = F.greatest(F.least(F.col(value), F.lit(high)), F.lit(low))
    return (
        stream.withWatermark(moment, delay)
        .withColumn("bin", bin_of(inside, F.lit(low), F.lit(high), bins))
        .groupBy(F.window(moment, length), "bin")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.col("window.start").alias("window_start"), "bin", "rows")
    )


def reference_bins(df: DataFrame, value: str, low: float, high: float, bins: int = 10) -> list[int]:
    """Counts per bin of the reference (runs one aggregate job, returns `bins` numbers)."""
    inside = F.greatest(F.least(F.col(value), F.lit(high)), F.lit(low))
    counted = df.select(bin_of(inside, F.lit(low), F.lit(high), bins).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    found = {row["bin"]: row["n"] for row in counted.collect()}
    return [found.get(i, 0) for i in range(bins)]


def window_psi(counts: DataFrame, reference: list[int]) -> DataFrame:
    """PSI per window against the reference counts; bins without rows count as empty."""
    bins = len(reference)
    total = sum(reference) + bins * SMOOTHING
    per_bin = counts.groupBy("window_start").agg(
        *[F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("rows"))), F.lit(0)).alias(f"_b{i}") for i in range(bins)],
        F.sum("rows").alias("rows"),
    )
    psi = F.lit(0.0)
    for i, expected in enumerate(reference):
        p = F.lit((expected + SMOOTHING) / total)
        q = (F.col(f"_b{i}") + SMOOTHING) / (F.col("rows") + bins * SMOOTHING)
        psi = psi + (q - p) * F.log(q / p)
    return per_bin.select("window_start", "rows", psi.alias("psi"))


