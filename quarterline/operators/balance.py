"""Synthetic minority rows between near neighbours."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.functions.scalars import nan_to_null
from quarterline.operators.joins import sized
from quarterline.operators.ranks import with_row_number


def _nearest(keys: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, neighbour, squared distance) of each point's k nearest others in a group, ties by key."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    keys, points = keys[order], points[order]
    distance = np.zeros((n, n))
    for column in points.T:
        distance += (column[:, None] - column) ** 2
    np.fill_diagonal(distance, np.inf)
    picked = np.argsort(distance, axis=1, kind="stable")[:, : min(k, n - 1)]
    return np.repeat(keys, picked.shape[1]), keys[picked].ravel(), np.take_along_axis(distance, picked, 1).ravel()


#: Blocks that are dealt out together, so that only the rows at their border are sent twice.
STRETCH = 16


def _dealt(points: DataFrame, cuts: tuple[int, ...], block_rows: int, projections: int, seed: int) -> DataFrame:
    """(_turn, _stretch, _place, _row, _x): the rows by their place along each direction, once for every stretch that has a block of theirs."""
    if len(cuts) == 1:
        return points.select(F.lit(0).alias("_turn"), F.lit(0).cast("long").alias("_stretch"), F.lit(0).cast("long").alias("_place"), "_row", "_x")
    # The directions' lengths don't matter; their number of parts comes from one row.
    width = len(points.first()["_x"])
    turns = np.random.default_rng(seed).normal(size=(projections, width))
    parts = []
    for t, direction in enumerate(turns):
        place = F.aggregate(F.zip_with("_x", F.array(*[F.lit(float(w)) for w in direction]), lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)
        ranked = with_row_number(points.withColumn("_along", place), ["_along", "_row"], "_at").withColumn("_place", F.col("_at") - 1)
        # A moved block may begin in the stretch before its own.
        held = F.array_distinct(F.array(*[F.floor((F.col("_place") + moved) / (block_rows * STRETCH)) for moved in cuts]))
        parts.append(ranked.select(F.lit(t).alias("_turn"), F.explode(held).alias("_stretch"), "_place", "_row", "_x"))
    return reduce(DataFrame.unionAll, parts)


def nearest_rows(points: DataFrame, n: int, k: int, block_rows: int = 512, projections: int = 4, seed: int = 42) -> DataFrame:
    """(_row, _neighbour, _distance): k near other rows of each of the n rows of (_row, _x), by squared distance.

    Rows are ranked along random directions and cut into blocks of `block_rows` neighbours, twice with the cuts moved by half a block; all
    pairs inside a block are compared and each row keeps its k nearest of all blocks. Work grows with n x block_rows. With no more rows than
    a block holds the neighbours are the nearest ones; beyond it, nearly: rows that are close lie close along most directions.
    """
    cuts = (0,) if n <= block_rows else (0, block_rows // 2)
    placed = _dealt(points, cuts, block_rows, projections, seed)

    def compare(stretch: pd.DataFrame) -> pd.DataFrame:
        at, rows, x = stretch["_place"].to_numpy(), stretch["_row"].to_numpy(), np.vstack(stretch["_x"].to_numpy())
        found = []
        for moved in cuts:
            block = (at + moved) // block_rows
            # Rows of the stretches beside this one are there for the other cut only.
            mine = np.flatnonzero(block // STRETCH == stretch["_stretch"].iloc[0]) if len(cuts) > 1 else np.arange(len(at))
            mine = mine[np.argsort(block[mine], kind="stable")]
            for one in np.split(mine, np.flatnonzero(np.diff(block[mine])) + 1):
                if len(one):
                    found.append(pd.DataFrame(dict(zip(("_row", "_neighbour", "_distance"), _nearest(rows[one], x[one], k)))))
        # A row's nearest of both cuts.
        pairs = pd.concat(found).drop_duplicates(["_row", "_neighbour"]).sort_values(["_row", "_distance", "_neighbour"])
        return pairs[pairs.groupby("_row").cumcount() < k]

    near = placed.groupBy("_turn", "_stretch").applyInPandas(compare, "_row bigint, _neighbour bigint, _distance double")
    # At most k pairs of each direction.
    listed = near.groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("_distance", "_neighbour"))).alias("_near"))
    return listed.select("_row", F.inline(F.slice("_near", 1, k))).select("_row", "_neighbour", "_distance")


def oversample(train: DataFrame, features: list[str], label: str, key: list[str], neighbours: int = 5, seed: int = 42, block_rows: int = 512) -> DataFrame:
    """Train rows plus synthetic minority rows until both classes are equal (two small jobs fit the counts).

    Missing and non-finite features count as 0; other columns of a synthetic row are NULL. Which neighbour and
    how far along are hashes of the row's place, so reruns agree. A minority of one row has no neighbour and is an error.
    """
    kinds = dict(train.dtypes)
    numeric = {c: nan_to_null(F.col(c).cast("double"), 0.0).alias(c) for c in features}
    others = [c for c in train.columns if c not in features]
    rows = train.select(*others, *numeric.values())
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return rows.select(*train.columns).withColumn("synthetic", F.lit(False))
    minority = min(counts, key=lambda c: (counts[c], c))
    n, needed = counts[minority], max(counts.values()) - counts[minority]
    if n == 1 and needed:
        raise ValueError("a minority of one row has no neighbour to make rows from")
    ticket = F.xxhash64(*[F.col(c).cast("string") for c in key], F.lit(seed))
    small = rows.where(F.col(label) == minority).withColumn("_ticket", ticket)
    ranked = with_row_number(small, ["_ticket", *key], "_row").select("_row", F.array(*features).alias("_x"))
    # Each row makes floor(needed / n) synthetic rows, the first ones by ticket one more.
    copies = F.lit(needed // n) + (F.col("_row") <= needed % n).cast("int")
    ranked = sized(ranked)
    near = nearest_rows(ranked, n, neighbours, block_rows, seed=seed)
    listed = near.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_distance", "_neighbour"))).alias("_near"))  # at most k entries
    made = listed.withColumn("_copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1).cast("bigint"), copies.cast("bigint")))))
    pick = F.pmod(F.xxhash64("_row", "_copy", F.lit(seed)), F.size("_near")).cast("int")
    step = F.pmod(F.xxhash64("_row", "_copy", F.lit(seed + 1)), F.lit(1 << 20)) / float(1 << 20)
    # Only numbers move until it is known which neighbours are taken; wide rows meet once for each pair of rows.
    taken = made.select("_row", F.get("_near", pick)["_neighbour"].alias("_neighbour"), step.alias("_step"))
    pairs = taken.groupBy("_row", "_neighbour").agg(F.collect_list("_step").alias("_steps"))
    joined = pairs.join(ranked, "_row").join(ranked.select(F.col("_row").alias("_neighbour"), F.col("_x").alias("_y")), "_neighbour")
    placed = joined.select("_x", "_y", F.explode("_steps").alias("_step"))
    synthetic = placed.select(
        *[
            (F.col("_x")[i] + F.col("_step") * (F.col("_y")[i] - F.col("_x")[i])).alias(c) if c in features else (
                F.lit(minority).cast(kinds[c]).alias(c) if c == label else F.lit(None).cast(kinds[c]).alias(c)
            )
            for c, i in ((c, features.index(c) if c in features else -1) for c in train.columns)
        ],
        F.lit(True).alias("synthetic"),
    )
    return rows.select(*train.columns).withColumn("synthetic", F.lit(False)).unionByName(synthetic)
