"""Exact global ranks, running totals and quantiles without a single-task window.

A window with no partition runs in one task. These helpers sort once by range instead, keep the sorted
table as a checkpoint (so partition numbers are stable), and add up one small row per partition.
Ties are broken by the caller's order columns, so even a value that a third of the rows share is spread
over many range partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterline.operators.joins import sized
from quarterline.session import materialise

_POSITION_BITS = (1 << 33) - 1


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    matched = F.lit(True)
    for name in names:
        matched = matched & left[name].eqNullSafe(right[name])
    return matched


def with_row_number(df: DataFrame, order: list[Column | str], number: str = "row_number", total: str | None = None) -> DataFrame:
    """Number all rows 1..N along `order`, which should be a total order."""
    placed = materialise(df.orderBy(*order))
    placed = placed.withColumns(
        {
            "_part": F.spark_partition_id(),
            "_position": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)),
        }
    )
    # One row per partition: the unpartitioned windows below see a few thousand rows at most.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("_offset_part"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(W.partitionBy()).alias("_total"),
    )
    numbered = placed.join(F.broadcast(offsets), placed["_part"] == offsets["_offset_part"])
    numbered = numbered.withColumn(number, F.col("_offset") + F.col("_position") + 1)
    if total:
        numbered = numbered.withColumn(total, F.col("_total"))
    return numbered.drop("_part", "_position", "_offset_part", "_offset", "_total")


def tile_cuts(df: DataFrame, order: list[str], buckets: int) -> list[tuple]:
    """Fit NTILE over the whole table: the last row of each tile but the last, as order values.

    Only the order columns are sorted. Runs a job and returns at most buckets - 1 rows. The first
    N % buckets tiles hold one row more than the others.
    """
    ranked = with_row_number(df.select(*order), order, "_row", "_rows")
    small, extra = F.floor(F.col("_rows") / buckets), F.col("_rows") % buckets
    ends = F.array(*[F.lit(i) * small + F.least(F.lit(i), extra) for i in range(1, buckets)])
    rows = ranked.where(F.array_contains(ends, F.col("_row"))).withColumn("_ends", ends).collect()
    by_row = {r["_row"]: tuple(r[c] for c in order) for r in rows}
    return [by_row.get(end) for end in rows[0]["_ends"]] if rows else []


def tile_of(order: list[str], cuts: list[tuple]) -> Column:
    """Tile number of a row, comparing its order values with the fitted cuts."""
    here = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    tile = F.lit(1)
    for cut in cuts:
        if cut is not None:
            edge = F.struct(*[F.lit(v).alias(f"o{i}") for i, v in enumerate(cut)])
            tile = tile + (here > edge).cast("int")
        # A tile without rows ends before the first one: every row lies beyond it.
        else:
            tile = tile + 1
    return tile


#: Rows of one group that a task holds back until it knows the group's sum.
HELD = 1 << 16


def scanned(df: DataFrame, groups: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """The rows ranged along (groups, order), each with its running sums inside the stretch of its group in its partition.

    Adds `_part`, `_run` (the number of a stretch whose group may go on in another partition or is too long to hold back; else null),
    `_last` (its last row), `_in_<name>` and `_sum_<name>` (the group's sum, null where `_run` is set). One exchange; the scan is done where the
    rows lie.
    """
    kinds = dict(df.dtypes)
    whole = {c: kinds[c] in ("tinyint", "smallint", "int", "bigint") for c in sums}
    added = [f"_in_{c}" for c in sums] + [f"_sum_{c}" for c in sums]
    types = ["bigint" if whole[c] else "double" for c in sums] * 2
    schema = ", ".join([f"`{n}` {t}" for n, t in df.dtypes] + ["_part int", "_run bigint", "_last boolean"] + [f"`{n}` {t}" for n, t in zip(added, types)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        # The stretch at hand: its rows held back, its key, number and sums so far, and whether its group may have rows elsewhere.
        held: list[tuple[pa.RecordBatch, list[np.ndarray]]] = []
        key, stretch, elsewhere = None, 0, True
        before = [0] * len(sums)

        def marked(piece: pa.RecordBatch, running: list[np.ndarray], totals: list | None, last: bool = False) -> pa.RecordBatch:
            n = piece.num_rows
            ends = np.zeros(n, bool)
            ends[-1] = last
            columns = [pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.int64()) if totals else pa.array(np.full(n, stretch)), pa.array(ends), *map(pa.array, running)]
            columns += [pa.array(t) if totals else pa.nulls(n, pa.array(r[:0]).type) for t, r in zip(totals or running, running)]
            return pa.RecordBatch.from_arrays([*piece.columns, *columns], [*piece.schema.names, "_part", "_run", "_last", *added])

        def ended() -> Iterator[pa.RecordBatch]:
            nonlocal stretch, elsewhere
            for i, (piece, running) in enumerate(held):
                totals = None if elsewhere else [np.full(piece.num_rows, t) for t in before]
                yield marked(piece, running, totals, i == len(held) - 1)
            held.clear()
            stretch, elsewhere = stretch + elsewhere, False

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(batch.schema.get_field_index(g)) for g in groups]
            changes = np.zeros(batch.num_rows, bool)
            changes[0] = True
            for column in keys:
                code = column.dictionary_encode().indices.fill_null(-1).to_numpy(False)
                changes[1:] |= code[1:] != code[:-1]
            starts = np.flatnonzero(changes)
            ends = np.append(starts[1:], batch.num_rows)
            running = []
            for c in sums:
                values = batch.column(batch.schema.get_field_index(c)).fill_null(0).to_numpy(False).astype(np.int64 if whole[c] else float)
                so_far = np.cumsum(values)
                running.append(so_far - np.repeat(so_far[starts] - values[starts], ends - starts))
            here = tuple(column[0].as_py() for column in keys)
            if held and here != key:
                yield from ended()
                before = [0] * len(sums)
            first = [r[: ends[0]] + t for r, t in zip(running, before)]
            held.append((batch.slice(0, ends[0]), first))
            key, before = here, [r[-1] for r in first]
            if len(starts) > 1:
                yield from ended()
                if len(starts) > 2:
                    a, b = starts[1], starts[-1]
                    totals = [np.repeat(r[ends[1:-1] - 1], (ends - starts)[1:-1]) for r in running]
                    yield marked(batch.slice(a, b - a), [r[a:b] for r in running], totals)
                last = batch.slice(starts[-1]), [r[starts[-1] :] for r in running]
                held.append(last)
                key, before = tuple(column[int(starts[-1])].as_py() for column in keys), [r[-1] for r in last[1]]
            if sum(piece.num_rows for piece, _ in held) > HELD:
                # A stretch this long gets its sum from the table of stretches; its last row stays, to be marked if no more follow.
                elsewhere = True
                piece, running = held.pop()
                for early in [*held, (piece.slice(0, piece.num_rows - 1), [r[:-1] for r in running])]:
                    if early[0].num_rows:
                        yield marked(*early, None)
                held[:] = [(piece.slice(piece.num_rows - 1), [r[-1:] for r in running])]
        if held:
            elsewhere = True
            yield from ended()

    return df.orderBy(*groups, *order).mapInArrow(run, schema)


def with_running_totals(df: DataFrame, groups: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """Add `<name>_upto` (running sum inside each group) and `<name>_total` (the group's sum).

    Rows are unique on (groups, order). They are dealt out once, by ranges, and scanned in place; a group that spans many partitions is
    joined up by the sums of its stretches, of which a partition has two plus one for each `HELD` rows. Sums are longs or doubles.
    """
    rows = sized(scanned(df, groups, order, sums))
    # The last row of a stretch carries its sums; a stretch that was let go early is found by its last row as well.
    ends = rows.where("_last AND _run IS NOT NULL").select("_part", "_run", *groups, *[F.col(f"_in_{c}").alias(f"_sub_{c}") for c in sums])
    earlier = W.partitionBy(*groups).orderBy("_part", "_run").rowsBetween(W.unboundedPreceding, -1)
    picks = []
    for c in sums:
        picks.append(F.coalesce(F.sum(f"_sub_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}"))
        picks.append(F.sum(f"_sub_{c}").over(W.partitionBy(*groups)).alias(f"_all_{c}"))
    offsets = ends.select(F.col("_part").alias("_of_part"), F.col("_run").alias("_of_run"), *picks)
    joined = rows.join(F.broadcast(offsets), (F.col("_part") == F.col("_of_part")) & (F.col("_run") == F.col("_of_run")), "left")
    totals = []
    for c in sums:
        totals.append((F.col(f"_in_{c}") + F.coalesce(f"_before_{c}", F.lit(0))).alias(f"{c}_upto"))
        totals.append(F.coalesce(f"_sum_{c}", f"_all_{c}").alias(f"{c}_total"))
    return joined.select(*df.columns, *totals)


def group_quantiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    quantiles: dict[str, float],
    accuracy: int | None = None,
) -> DataFrame:
    """Quantiles per group with linear interpolation, one column per entry of `quantiles`.

    Exact by default: equal values are counted first, then ranked by running counts, so no task ever holds
    a whole group. With `accuracy` a one-pass sketch is used instead.
    """
    present = df.where(F.col(value).isNotNull())
    if accuracy is not None:
        sketches = [F.percentile_approx(value, p, accuracy).alias(n) for n, p in quantiles.items()]
        return present.groupBy(*groups).agg(*sketches)
    counted = present.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = with_running_totals(counted, groups, [value], ["_n"])
    picks, results = [], []
    for name, p in quantiles.items():
        position = F.lit(float(p)) * (F.col("_n_total") - 1)
        picks += [
            F.min(F.when(F.col("_n_upto") >= F.floor(position) + 1, F.col(value))).alias(f"_low_{name}"),
            F.min(F.when(F.col("_n_upto") >= F.ceil(position) + 1, F.col(value))).alias(f"_high_{name}"),
        ]
        position = F.lit(float(p)) * (F.col("_size") - 1)
        between = (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * (position - F.floor(position))
        results.append((F.col(f"_low_{name}") + between).alias(name))
    picked = ranked.groupBy(*groups).agg(F.max("_n_total").alias("_size"), *picks)
    return picked.select(*groups, *results)
