"""Approximate nearest neighbours over shifted space-filling curves.

Distinct vectors are projected on random directions, a few for each curve, shifted, laid on a grid and ordered along a Hilbert curve.
Spark range-partitions the orderings; a query is compared with the `window` vectors before and after it on each curve, and the best of
all curves are merged, ranked by exact distance. A round takes a few new curves and twice the window of the round before, so it looks at as
many vectors as all rounds before it; a query takes part until a round leaves its nearest as they are, or the windows of all rounds held
twice as many vectors as there are. Every vector is met through its place on a curve, at every size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterline.llm.common import by_groups, partitions, stored
from quarterline.session import fresh_folder, remove

#: Vectors from which centre and spread of the projections are taken; every vector is indexed.
FIT_SAMPLE = 4096
#: Most vectors that a task compares with a query at a time.
STRETCH = 8192


@dataclass(frozen=True)
class Curves:
    """curves: new orderings of a round; axes, bits: dimensions and bits of each grid; window: vectors on either side of a query in the first
    round, twice as many in each later one."""

    curves: int = 4
    axes: int = 8
    bits: int = 24
    window: int = 512
    seed: int = 5


def _along_curve(grid: np.ndarray, bits: int) -> np.ndarray:
    """Grid points (n, axes) as the transposed Gray-code form (axes, n) of their place along the Hilbert curve."""
    x = grid.astype(np.uint32).T.copy()
    axes = len(x)
    for b in range(bits - 1, 0, -1):
        bit, low = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for axis in range(axes):
            high = (x[axis] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[axis]) & low).astype(np.uint32)
            x[0] ^= np.where(high, low, swap).astype(np.uint32)
            if axis:
                x[axis] ^= swap
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(b)) & 1, np.uint32((1 << b) - 1), np.uint32(0)).astype(np.uint32)
    return x ^ turn


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid point (n, axes) along the Hilbert curve, where it fits a long."""
    x = _along_curve(grid, bits)
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            key = (key << 1) | ((x[axis] >> np.uint32(b)) & 1).astype(np.int64)
    return key


def hilbert_bytes(grid: np.ndarray, bits: int) -> list[bytes]:
    """The same places as byte strings of any length, which sort as the numbers do."""
    x = _along_curve(grid, bits)
    flags = [((x[axis] >> np.uint32(b)) & 1).astype(np.uint8) for b in range(bits - 1, -1, -1) for axis in range(len(x))]
    return [row.tobytes() for row in np.packbits(np.stack(flags, 1), axis=1)]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the vectors that take part: id and components given and finite, not all zero, of the most frequent length.

    Of rows that share a vec_id the smallest vector, in array order, takes part.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (lengths.n if lengths else 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def distinct_vectors(rows: DataFrame, k: int, is_query) -> tuple[DataFrame, DataFrame]:
    """Classes of equal vectors (class: smallest id, embedding, its k + 1 smallest ids, asked) and the queries' classes (query_id, class)."""
    number = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    firsts = rows.withColumn("number", number).where(F.col("number") <= k + 1)
    classes = firsts.groupBy("embedding").agg(F.min("vec_id").alias("class"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    queries = rows.where(is_query).join(classes.select("embedding", "class"), "embedding").select(F.col("vec_id").alias("query_id"), "class")
    asked = queries.select("class").distinct().withColumn("asked", F.lit(True))
    return classes.join(asked, "class", "left").withColumn("asked", F.coalesce("asked", F.lit(False))), queries


def _projections(classes: DataFrame, p: Curves, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Directions (curves, dimensions, axes), origin and cell width per curve and axis."""
    sample = classes.select("class", "embedding").orderBy(F.xxhash64("class"), "class").limit(FIT_SAMPLE).toPandas()
    if sample.empty:
        return None
    data = np.array(sample["embedding"].tolist(), np.float64)
    rng = np.random.default_rng([p.seed, turn])
    directions = rng.normal(size=(p.curves, data.shape[1], p.axes))
    if data.shape[1] >= p.axes:
        directions = np.linalg.qr(directions)[0]
    y = np.einsum("nd,cda->cna", data, directions)
    # 16 deviations, shifted by up to two: keys are fine enough for so wide a grid, and few outliers meet at its edge.
    spread = np.maximum(y.std(1), 1e-9)
    return directions, y.mean(1) + spread * rng.uniform(-10, -6, spread.shape), 16 * spread / (1 << p.bits)


def order_along_curves(classes: DataFrame, p: Curves, turn: int, home: str) -> DataFrame:
    """curve, rank along it, class, vec (its numbers as bytes), asked: the curves of a round, stored under `home`, ranged by curve and key."""
    spark, fitted = classes.sparkSession, _projections(classes, p, turn)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, origin, width = fitted
        for batch in batches:
            for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                n = part.num_rows
                data = part.column("embedding").flatten().to_numpy().reshape(n, -1)
                vec = pa.array([x.tobytes() for x in data], pa.binary())
                for curve in range(p.curves):
                    grid = np.clip((data @ directions[curve] - origin[curve]) / width[curve], 0, (1 << p.bits) - 1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, curve, np.int32)), pa.array(hilbert_bytes(grid, p.bits), pa.binary()), part.column("class"), vec, part.column("asked")],
                        ["curve", "key", "class", "vec", "asked"],
                    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            curve = batch.column("curve").to_numpy()
            at = np.zeros(len(curve), np.int64)
            for c in np.unique(curve):
                mine = np.flatnonzero(curve == c)
                at[mine] = seen.get(c, 0) + np.arange(len(mine))
                seen[c] = seen.get(c, 0) + len(mine)
            yield pa.RecordBatch.from_arrays(
                [batch.column("curve"), pa.array(np.full(len(curve), place, np.int32)), pa.array(at), *(batch.column(c) for c in ("class", "vec", "asked"))],
                ["curve", "place", "at", "class", "vec", "asked"],
            )

    keyed = classes.select("class", "embedding", "asked").mapInArrow(keys, "curve int, key binary, class long, vec binary, asked boolean")
    n = max(partitions(spark), p.curves)
    sorted_rows = keyed.repartitionByRange(n, "curve", "key", "class").sortWithinPartitions("curve", "key", "class")
    schema = "curve int, place int, at long, class long, vec binary, asked boolean"
    sorted_rows.mapInArrow(number, schema).write.parquet(f"{home}/curves")
    rows = spark.read.schema(schema).parquet(f"{home}/curves")
    # One row per partition and curve: how many rows of the curve lie in the partitions before.
    counts = rows.groupBy("curve", "place").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("curve").orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts.select("curve", "place", before.alias("before")).write.parquet(f"{home}/offsets")
    offsets = spark.read.schema("curve int, place int, before long").parquet(f"{home}/offsets")
    return rows.join(offsets, ["curve", "place"]).select("curve", (F.col("before") + F.col("at")).alias("rank"), "class", "vec", "asked")


def closest(points: np.ndarray, ids: np.ndarray, asks: np.ndarray, allowed, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of `asks` the ids and exact distances of its k closest points among those `allowed(first, last)` marks, ties to small ids."""
    out, lengths = [], (points * points).sum(1)
    for first in range(0, len(asks), 64):
        some = asks[first : first + 64]
        own = (some * some).sum(1)
        rough = np.where(allowed(first, first + len(some)), lengths + own[:, None] - 2 * some @ points.T, np.inf)
        for ask, row, size in zip(some, rough, own, strict=True):
            # Products lose digits: all that may be among the k closest are measured by their differences.
            edge = (np.partition(row, k - 1)[k - 1] if len(row) > k else np.inf) + 1e-11 * (lengths.max() + size)
            near = np.flatnonzero((row <= edge) & (row < np.inf))
            gap = points[near] - ask
            score = np.sqrt((gap * gap).sum(1))
            top = np.lexsort((ids[near], score))[:k]
            out.append((ids[near][top], score[top]))
    return out


def _matches(rows: pa.Table, k: int, window: int, kind: type) -> pa.Table | None:
    """query, class, score of one stretch and its queries: what is at most `window` ranks away."""
    asks = rows.column("query").to_numpy(zero_copy_only=False)
    if not asks.any() or asks.all():
        return None
    rank, ids = rows.column("rank").to_numpy(), rows.column("class").to_numpy()
    data = np.frombuffer(b"".join(rows.column("vec").to_pylist()), kind).reshape(len(ids), -1).astype(np.float64)

    def allowed(first: int, last: int) -> np.ndarray:
        gap = np.abs(rank[~asks] - rank[asks][first:last, None])
        return (gap <= window) & (ids[~asks] != ids[asks][first:last, None])

    found = closest(data[~asks], ids[~asks], data[asks], allowed, k)
    queries = np.repeat(ids[asks], [len(x) for x, _ in found])
    return pa.table({"query": queries, "class": np.concatenate([x for x, _ in found]), "score": np.concatenate([x for _, x in found])})


def window_matches(ranked: DataFrame, asked: DataFrame, window: int, k: int, kind: type) -> DataFrame:
    """query (class), class, score: the best k of each stretch of each curve at most `window` ranks from the query.

    Curves are cut into stretches of ranks. Every vector lies in one; a query is also sent to the stretches its window reaches.
    """
    size = min(window, STRETCH)
    curve, stretch = F.col("curve").cast("long").alias("curve"), F.floor(F.col("rank") / size)
    vectors = ranked.select(curve, stretch.alias("stretch"), "rank", "class", "vec", F.lit(False).alias("query"))
    reach = F.explode(F.sequence(F.floor(F.greatest(F.col("rank") - window, F.lit(0)) / size), F.floor((F.col("rank") + window) / size)))
    queries = asked.select(curve, reach.alias("stretch"), "rank", "class", "vec", F.lit(True).alias("query"))
    return by_groups(vectors.unionByName(queries), ["curve", "stretch"], lambda rows: _matches(rows, k, window, kind), "query long, class long, score double")


def settled_matches(classes: DataFrame, p: Curves, k: int) -> DataFrame | None:
    """query (class), class, score: each asked class's k closest classes, from rounds of new curves and doubled windows.

    A round looks at as many vectors as all before it. A query that has k and whose k a round leaves as they are is settled; the others go on
    until the windows of all rounds held twice as many vectors as there are. Vectors with structure settle after a few rounds; without any, a
    query's share of the table is the same at every size.
    """
    spark, n = classes.sparkSession, classes.count()
    kind = np.float32 if dict(classes.dtypes)["embedding"] == "array<float>" else np.float64
    is_open = classes.where("asked").select("class")
    best, turn, seen = None, 0, 0
    while seen < 2 * n and not is_open.isEmpty():
        window, home = p.window << turn, fresh_folder(spark, "curves")
        ranked = order_along_curves(classes, p, turn, home)
        asked = ranked.where("asked")
        found = window_matches(ranked, asked.join(is_open, "class", "left_semi") if turn else asked, window, k, kind).withColumn("new", F.lit(1))
        both = found if best is None else found.unionByName(best.withColumn("new", F.lit(0)))
        place = F.row_number().over(W.partitionBy("query").orderBy("score", "class"))
        merged = both.groupBy("query", "class").agg(F.min("score").alias("score"), F.min("new").alias("new")).withColumn("n", place)
        best = stored(merged.where(F.col("n") <= k).drop("n"), "best")
        remove(spark, home)
        changed = best.groupBy(F.col("query").alias("class")).agg(F.max("new").alias("new"), F.count("*").alias("n"))
        # A query whose windows held too little is open too.
        done = changed.where((F.col("new") == 0) & (F.col("n") == k)).select("class")
        is_open, best = stored(is_open.join(done, "class", "left_anti"), "open"), best.drop("new")
        turn, seen = turn + 1, seen + 2 * window * p.curves
    return best


def nearest(vectors: DataFrame, is_query, k: int = 10, p: Curves = Curves()) -> DataFrame:
    """query_id, rank from 1, vec_id, score: each query's k nearest found, by Euclidean distance, ties to the smaller vec_id.

    Found through the windows of `settled_matches` only, whose recall is measured against brute force in the README.

    Queries are the rows for which `is_query` holds, candidates all rows but the query's own. Equal vectors are searched once and
    answered with their smallest ids, so copies neither fill windows nor tie at random. Null ids, null, zero or non-finite vectors and
    vectors of another length than the most frequent one take no part; extra columns are ignored; fewer candidates give fewer rows.
    """
    classes, queries = distinct_vectors(stored(usable(vectors), "vectors"), k, is_query)
    classes, queries = stored(classes, "classes"), stored(queries, "queries")
    matches = settled_matches(classes, p, k + 1)
    if matches is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    itself = queries.select(F.col("class").alias("query"), "class", F.lit(0.0).alias("score")).distinct()
    # k + 1 classes in order of distance and smallest id hold the k best ids, whichever of them is the query's own.
    near = F.row_number().over(W.partitionBy("query").orderBy("score", "class"))
    top = matches.unionByName(itself).withColumn("n", near).where(F.col("n") <= k + 1)
    ids = top.join(classes.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("vec_id"))
    # Cut to k + 1 ids before they are handed to every query of the class.
    nearest_ids = F.row_number().over(W.partitionBy("query").orderBy("score", "vec_id"))
    ids = ids.withColumn("n", nearest_ids).where(F.col("n") <= k + 1).drop("n")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return (
        queries.join(ids, queries["class"] == ids["query"])
        .where("vec_id <> query_id")
        .select("query_id", rank.alias("rank"), "vec_id", "score")
        .where(F.col("rank") <= k)
    )
