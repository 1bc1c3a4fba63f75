"""Statistics of many columns over many slices, folded into counters inside the tasks.

A row of the wide table reaches a worker once, with its columns as one matrix and its slices as codes. Tasks keep arrays of counters per
(slice, column) and hand on only what isn't zero, so what is shuffled doesn't grow with rows x columns x slices. Quantiles are found by
refinement: counts of equal bins over the range of a column, then of equal bins inside the few bins that hold a wanted rank, until the values
left are few enough to be listed. No row is sorted or stored.

Counters are bounded (`CELLS`), and so are the results that the driver looks at between passes. A table with more (slice, column) pairs
than `PAIRS` gets None, and callers take the way of `operators.ranks`, which sorts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Counters that a task holds and a pass returns at most.
CELLS = 1 << 19
#: (slice, column) pairs at most; their extents come to the driver.
PAIRS = 50_000
#: Values that a last pass may list instead of counting.
LISTED = 1 << 17
_TOP = np.uint64(1 << 63)

Members = list[tuple[Column, Column]]


#: Times keep their microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def as_text(groups: list[str]) -> Column:
    """The columns of a grouping as JSON, which `opened` turns back."""
    return F.to_json(F.struct(*groups), _JSON) if groups else F.lit("{}")


def opened(df: DataFrame, text: str, like: DataFrame, groups: list[str]) -> DataFrame:
    """`df` with the columns of a grouping, with their types, in front and without the JSON that holds them."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.select(*groups).schema.fields)
    rest = [c for c in df.columns if c != text]
    parsed = df.withColumn("_g", F.from_json(text, kinds, _JSON)) if groups else df
    return parsed.select(*[F.col(f"_g.`{g}`").alias(g) for g in groups], *rest)


def _marked(df: DataFrame, members: Members, columns: list[str]) -> DataFrame:
    marks = []
    for i, (dimension, name) in enumerate(members):
        marks += [dimension.cast("string").alias(f"_d{i}"), name.cast("string").alias(f"_s{i}")]
    return df.select(*marks, *[F.col(c).cast("double").alias(f"_v{k}") for k, c in enumerate(columns)])


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    """Rows x columns, with NaN for null."""
    if not n:
        return np.zeros((batch.num_rows, 0))
    return np.column_stack([batch.column(f"_v{k}").to_numpy(zero_copy_only=False) for k in range(n)])


def _memberships(batch: pa.RecordBatch, n: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """For each membership: its distinct (dimension, slice), the rows in one of them, sorted by it, and the place of each row's."""
    for i in range(n):
        dimension, name = (batch.column(f"{c}{i}").dictionary_encode() for c in ("_d", "_s"))
        rows = np.flatnonzero(~(dimension.indices.is_null().to_numpy(False) | name.indices.is_null().to_numpy(False)))
        if not len(rows):
            continue
        a, b = (x.indices.fill_null(0).to_numpy(False)[rows].astype(np.int64) for x in (dimension, name))
        present, place = np.unique(a * len(name.dictionary) + b, return_inverse=True)
        keys = [(dimension.dictionary[int(p) // len(name.dictionary)].as_py(), name.dictionary[int(p) % len(name.dictionary)].as_py()) for p in present]
        order = np.argsort(place, kind="stable")
        yield keys, rows[order], place[order]


def _starts(codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))


class Extents:
    """Per (dimension, slice), held by column: rows, values, their sum, smallest and largest."""

    def __init__(self, keys: list[tuple[str, str]], columns: list[str], table: np.ndarray):
        self.keys, self.columns = keys, columns
        self.rows, self.present = table[0].astype(np.int64), table[1].astype(np.int64)
        self.total, self.low, self.high = table[2:]
        with np.errstate(invalid="ignore"):
            self.mean = np.where(self.present > 0, self.total / np.maximum(self.present, 1), np.nan)


_EXTENTS = "dimension string, slice string, feature int, n long, present long, total double, low double, high double"


def extents(df: DataFrame, members: Members, columns: list[str]) -> Extents | None:
    """One pass over the table; None if it has more than `PAIRS` (slice, column) pairs. NaN counts as null."""
    n, m = len(columns), len(members)

    def made(state: dict) -> pa.RecordBatch:
        keys, table = list(state), np.array(list(state.values())).reshape(-1, 5, n)
        kept = np.repeat(np.arange(len(keys)), n)
        columns = [table[:, k].ravel() for k in range(5)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([keys[i][0] for i in kept], pa.string()), pa.array([keys[i][1] for i in kept], pa.string()), pa.array(np.tile(np.arange(n, dtype=np.int32), len(keys))),
                pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), *[pa.array(c, from_pandas=True) for c in columns[2:]],
            ],
            ["dimension", "slice", "feature", "n", "present", "total", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[tuple, np.ndarray] = {}
        for batch in batches:
            values = _matrix(batch, n)
            for keys, rows, codes in _memberships(batch, m):
                mine, starts = values[rows], _starts(codes)
                sizes = np.diff(np.append(starts, len(rows)))
                present = np.add.reduceat((~np.isnan(mine)).astype(np.int64), starts, axis=0)
                total = np.add.reduceat(np.nan_to_num(mine), starts, axis=0)
                low, high = np.fmin.reduceat(mine, starts, axis=0), np.fmax.reduceat(mine, starts, axis=0)
                for i, key in enumerate(keys):
                    new = np.stack([np.full(n, sizes[i], float), present[i], total[i], low[i], high[i]])
                    if (old := state.get(key)) is not None:
                        new[:3] += old[:3]
                        new[3], new[4] = np.fmin(new[3], old[3]), np.fmax(new[4], old[4])
                    state[key] = new
            if len(state) * n > CELLS:
                yield made(state)
                state.clear()
        if state:
            yield made(state)

    folded = _marked(df, members, columns).mapInArrow(run, _EXTENTS).groupBy("dimension", "slice", "feature")
    summed = folded.agg(*[F.sum(c).alias(c) for c in ("n", "present", "total")], F.min("low").alias("low"), F.max("high").alias("high"))
    rows = summed.limit(PAIRS + 1).toArrow()
    if rows.num_rows > PAIRS:
        return None
    pairs = list(zip(rows["dimension"].to_pylist(), rows["slice"].to_pylist(), strict=True))
    keys = sorted(set(pairs))
    place = {k: i for i, k in enumerate(keys)}
    table = np.full((5, len(keys), n), np.nan)
    at = np.array([place[p] for p in pairs], int), rows["feature"].to_numpy()
    for k, name in enumerate(("n", "present", "total", "low", "high")):
        table[k][at] = rows[name].to_numpy()
    return Extents(keys, columns, table)


class Squares:
    """Sum of squared distances from the mean of the slice."""

    def __init__(self, mean: np.ndarray):
        self.mean, self.size = mean, mean.size

    def start(self):
        self.sums = np.zeros(self.mean.shape)

    def add(self, codes: np.ndarray, values: np.ndarray):
        starts = _starts(codes)
        self.sums[codes[starts]] += np.add.reduceat(np.nan_to_num((values - self.mean[codes]) ** 2), starts, axis=0)

    def finish(self):
        flat = self.sums.ravel()
        cells = np.flatnonzero(flat)
        return cells, flat[cells], None, None


class Outside(Squares):
    """How many values lie strictly outside their slice's limits."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        super().__init__(low)
        self.high = high

    def add(self, codes: np.ndarray, values: np.ndarray):
        starts = _starts(codes)
        with np.errstate(invalid="ignore"):
            far = (values < self.mean[codes]) | (values > self.high[codes])
        self.sums[codes[starts]] += np.add.reduceat(far.astype(float), starts, axis=0)


class EqualBins:
    """Counts of equal-width bins over several ranges per (slice, column): low and high are slices x columns x ranges, NaN for none."""

    def __init__(self, low: np.ndarray, high: np.ndarray, bins: int):
        self.low, self.high, self.bins = low, high, bins
        self.size = low.size * bins

    def start(self):
        self.counts = np.zeros(self.size, np.int64)

    def add(self, codes: np.ndarray, values: np.ndarray):
        _, columns, ranges = self.low.shape
        for j in range(ranges):
            low, high = self.low[codes, :, j], self.high[codes, :, j]
            with np.errstate(invalid="ignore", divide="ignore"):
                place = np.floor((values - low) / (high - low) * self.bins)
            inside = ~(np.isnan(values) | np.isnan(low))
            place = np.where(high > low, np.minimum(place, self.bins - 1), 0)
            cell = ((codes[:, None] * columns + np.arange(columns)) * ranges + j) * self.bins
            np.add.at(self.counts, cell[inside] + place[inside].astype(np.int64), 1)

    def finish(self):
        cells = np.flatnonzero(self.counts)
        return cells, self.counts[cells].astype(float), None, None


def rising(values: np.ndarray) -> np.ndarray:
    """Doubles as unsigned integers of the same order; -0.0 is 0.0."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >= _TOP, ~bits, bits | _TOP)


def _signed(numbers: np.ndarray) -> np.ndarray:
    """Unsigned numbers as signed ones of the same order, and back."""
    return (numbers.view(np.uint64) ^ _TOP).view(np.int64)


def from_rising(numbers: np.ndarray) -> np.ndarray:
    return np.where(numbers >= _TOP, numbers ^ _TOP, ~numbers).view(np.float64)


class Brackets:
    """Ranges of `rising` numbers per (slice, column), cut into bins of 2^shift numbers: each bin's count, smallest and largest number.

    Without `shift` the numbers themselves with their counts. A range that isn't there has its low above its high.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, shift: np.ndarray | None = None, bins: int = 0):
        self.low, self.high, self.shift, self.bins = low, high, shift, bins
        self.size = low.size * bins

    def start(self):
        if self.shift is not None:
            self.counts = np.zeros(self.size, np.int64)
            self.least, self.most = np.full(self.size, ~np.uint64(0)), np.zeros(self.size, np.uint64)
        else:
            self.listed: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, codes: np.ndarray, values: np.ndarray):
        _, columns, ranges = self.low.shape
        there, numbers = ~np.isnan(values), rising(values)
        for j in range(ranges):
            low = self.low[codes, :, j]
            inside = there & (numbers >= low) & (numbers <= self.high[codes, :, j])
            row, column = np.nonzero(inside)
            pair = (codes[row] * columns + column) * ranges + j
            if self.shift is None:
                self.listed.append((pair, numbers[inside]))
            else:
                place = (numbers[inside] - low[inside]) >> self.shift[codes[row], column, j]
                cell = pair * self.bins + place.astype(np.int64)
                np.add.at(self.counts, cell, 1)
                np.minimum.at(self.least, cell, numbers[inside])
                np.maximum.at(self.most, cell, numbers[inside])

    def finish(self):
        if self.shift is not None:
            cells = np.flatnonzero(self.counts)
            return cells, self.counts[cells].astype(float), _signed(self.least[cells]), _signed(self.most[cells])
        pairs, numbers = (np.concatenate([x[i] for x in self.listed] or [np.zeros(0, t)]) for i, t in ((0, np.int64), (1, np.uint64)))
        both, counts = np.unique(np.stack([pairs, _signed(numbers)], 1), axis=0, return_counts=True)
        return both[:, 0], counts.astype(float), both[:, 1], both[:, 1]


def fold(df: DataFrame, members: Members, found: Extents, jobs: list) -> list[tuple[np.ndarray, ...]]:
    """One pass of all jobs over the table: for each job its cells with their amounts and their least and most numbers over all rows.

    Bounded by the jobs' sizes. A job that lists numbers has a row per cell and number.
    """
    columns, m = found.columns, len(members)
    place = {k: i for i, k in enumerate(found.keys)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for job in jobs:
            job.start()
        for batch in batches:
            values = _matrix(batch, len(columns))
            for keys, rows, codes in _memberships(batch, m):
                known = np.array([place[k] for k in keys])[codes]
                for job in jobs:
                    job.add(known, values[rows])
        for i, job in enumerate(jobs):
            cells, amounts, least, most = job.finish()
            blank = np.zeros(len(cells), np.int64)
            least, most = (blank, blank) if least is None else (least, most)
            # Only numbers that are listed tell rows of a cell apart.
            listed = least if isinstance(job, Brackets) and job.shift is None else blank
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cells), i, np.int32)), pa.array(cells.astype(np.int64)), pa.array(listed), pa.array(amounts), pa.array(least), pa.array(most)],
                ["job", "cell", "number", "amount", "least", "most"],
            )

    folded = _marked(df, members, columns).mapInArrow(run, "job int, cell long, number long, amount double, least long, most long")
    summed = folded.groupBy("job", "cell", "number").agg(F.sum("amount").alias("amount"), F.min("least").alias("least"), F.max("most").alias("most"))
    rows = summed.toArrow()
    job, *others = (rows[c].to_numpy() for c in ("job", "cell", "amount", "least", "most"))
    return [tuple(column[job == i] for column in others) for i in range(len(jobs))]


def _dense(shape: tuple, cells: np.ndarray, amounts: np.ndarray) -> np.ndarray:
    whole = np.zeros(int(np.prod(shape)))
    whole[cells] = amounts
    return whole.reshape(shape)


class Quantiles:
    """The search of the values at certain ranks, over all (slice, column) pairs at once."""

    def __init__(self, found: Extents, shares: list[float]):
        self.found = found
        self.pairs = [int(p) for p in np.flatnonzero(found.present.ravel() > 0)]
        counts = found.present.ravel()
        self.wanted = {p: sorted({int(f(s * (counts[p] - 1))) for s in shares for f in (np.floor, np.ceil)}) for p in self.pairs}
        self.values: dict[tuple[int, int], float] = {}
        low, high = rising(found.low.ravel()), rising(found.high.ravel())
        #: (pair, low, high, first rank, count) of the ranges that still hold a wanted rank.
        self.open = []
        for p in self.pairs:
            self.values[p, 0], self.values[p, int(counts[p]) - 1] = float(found.low.ravel()[p]), float(found.high.ravel()[p])
            self._keep(p, int(low[p]), int(high[p]), 0, int(counts[p]))

    def _keep(self, pair: int, low: int, high: int, first: int, count: int):
        ranks = [r for r in self.wanted[pair] if first <= r < first + count and (pair, r) not in self.values]
        if ranks and low == high:
            self.values.update({(pair, r): float(from_rising(np.array([low], np.uint64))[0]) for r in ranks})
        elif ranks:
            self.open.append((pair, low, high, first, count))

    def job(self) -> Brackets | None:
        """The next pass: counts of bins inside the open ranges, or a list of their values once these are few."""
        if not self.open:
            return None
        held: dict[int, list] = {}
        for entry in self.open:
            held.setdefault(entry[0], []).append(entry)
        ranges = max(map(len, held.values()))
        shape = (*self.found.present.shape, ranges)
        low, high, shift = np.ones(shape, np.uint64), np.zeros(shape, np.uint64), np.zeros(shape, np.uint64)
        self.listing = sum(e[4] for e in self.open) <= LISTED
        self.bins = max(2, CELLS // low.size)
        self.asked = {}
        for pair, entries in held.items():
            at = np.unravel_index(pair, shape[:2])
            for j, entry in enumerate(entries):
                low[at][j], high[at][j] = entry[1], entry[2]
                bits = 0
                while (entry[2] - entry[1]) >> bits >= self.bins:
                    bits += 1
                shift[at][j] = bits
                self.asked[pair * ranges + j] = (*entry, bits)
        return Brackets(low, high) if self.listing else Brackets(low, high, shift, self.bins)

    def take(self, cells: np.ndarray, amounts: np.ndarray, least: np.ndarray, most: np.ndarray):
        """The result of the pass. A bin's smallest and largest number are its new range, so one that holds one number only is settled."""
        self.open = []
        if self.listing:
            numbers = _signed(least).view(np.uint64)
            order = np.lexsort([numbers, cells])
            cells, numbers, counts = cells[order], numbers[order], amounts[order].astype(np.int64)
            for key, (pair, _, _, first, count, _) in self.asked.items():
                a, b = np.searchsorted(cells, [key, key + 1])
                after = first + np.cumsum(counts[a:b])
                for rank in self.wanted[pair]:
                    if first <= rank < first + count:
                        self.values[pair, rank] = float(from_rising(numbers[a + np.searchsorted(after, rank, side="right")][None])[0])
            return
        order = np.argsort(cells)
        cells, counts = cells[order], amounts[order].astype(np.int64)
        lows, highs = (_signed(x[order]).view(np.uint64) for x in (least, most))
        for key, (pair, _, _, first, _, _) in self.asked.items():
            a, b = np.searchsorted(cells, [key * self.bins, (key + 1) * self.bins])
            after = first + np.cumsum(counts[a:b])
            holding = {int(np.searchsorted(after, r, side="right")) for r in self.wanted[pair] if first <= r < after[-1]}
            for i in sorted(holding):
                self._keep(pair, int(lows[a + i]), int(highs[a + i]), int(after[i] - counts[a + i]), int(counts[a + i]))

    def result(self, share: float) -> np.ndarray:
        """Quantile with linear interpolation, slices x columns."""
        counts, whole = self.found.present.ravel(), np.full(self.found.present.size, np.nan)
        for p in self.pairs:
            position = share * (counts[p] - 1)
            low, high = self.values[p, int(np.floor(position))], self.values[p, int(np.ceil(position))]
            whole[p] = low + (high - low) * (position - np.floor(position))
        return whole.reshape(self.found.present.shape)


def summaries(df: DataFrame, members: Members, columns: list[str], quantiles: dict[str, float], spread: bool = False, sigmas: float = 3.0) -> DataFrame | None:
    """One row per (dimension, slice, feature): rows, present, mean, low, high and the quantiles; with `spread` also std and outlier_rate.

    `members` names the (dimension, slice) that a row is in, as pairs of columns; a null slice is none. Columns without values have null
    quantiles. outlier_rate: share of the rows, nulls included, beyond `sigmas` sample deviations. None beyond `PAIRS` pairs.
    """
    if (found := extents(df, members, columns)) is None:
        return None
    shape = found.present.shape
    search = Quantiles(found, list(quantiles.values()))
    more, parts = {}, [Squares(found.mean)] if spread else []
    job = search.job()
    while parts or job is not None:
        results = fold(df, members, found, [*parts, *([job] if job is not None else [])])
        if job is not None:
            search.take(*results[-1])
        if parts and "std" not in more:
            squares = _dense(shape, *results[0][:2])
            std = more["std"] = np.where(found.present > 1, np.sqrt(squares / np.maximum(found.present - 1, 1)), np.nan)
            parts = [Outside(found.mean - sigmas * std, found.mean + sigmas * std)]
        elif parts:
            far = _dense(shape, *results[0][:2])
            more["outlier_rate"] = np.where(more["std"] > 0, far / found.rows, 0.0)
            parts = []
        job = search.job()
    values = {"mean": found.mean, "low": found.low, "high": found.high, **more, **{n: search.result(s) for n, s in quantiles.items()}}
    pair = np.repeat(np.arange(len(found.keys)), len(columns))
    table = pa.table(
        {
            "dimension": pa.array([found.keys[i][0] for i in pair], pa.string()),
            "slice": pa.array([found.keys[i][1] for i in pair], pa.string()),
            "feature": pa.array(list(columns) * len(found.keys), pa.string()),
            "rows": pa.array(found.rows.ravel()),
            "present": pa.array(found.present.ravel()),
            **{n: pa.array(v.ravel().astype(float), from_pandas=True) for n, v in values.items()},
        }
    )
    return df.sparkSession.createDataFrame(table)


def group_summaries(df: DataFrame, groups: list[str], columns: list[str], quantiles: dict[str, float]) -> DataFrame | None:
    """`summaries` of a plain grouping: the group columns with their types, feature, rows, present, mean, low, high, quantiles.

    (group, column) pairs without any value have no row.
    """
    made = summaries(df, [(F.lit(""), as_text(groups))], columns, quantiles)
    return None if made is None else opened(made.where("present > 0").drop("dimension"), "slice", df, groups)


def comoments(df: DataFrame, columns: list[str]) -> DataFrame:
    """i, k (i <= k), n, x, y, xx, yy, xy for every pair of columns: sums over the rows that have both, of distances from a column's origin.

    Five products of matrices per batch; a task hands on one row per pair. Origins are the columns' smallest values, so a constant column
    has sums of exactly 0.
    """
    n = len(columns)
    typed = _marked(df, [], columns)
    lows = typed.agg(*[F.min(F.nanvl(f"_v{k}", F.lit(None).cast("double"))).alias(f"_v{k}") for k in range(n)]).first()
    origin = np.array([0.0 if v is None else v for v in lows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, n, n))
        for batch in batches:
            values = _matrix(batch, n) - origin
            there = (~np.isnan(values)).astype(float)
            values = np.nan_to_num(values)
            sums += [there.T @ there, values.T @ there, (values**2).T @ there, values.T @ values]
        i, k = np.triu_indices(n)
        both, x, xx, xy = (sums[a][i, k] for a in range(4))
        y, yy = sums[1][k, i], sums[2][k, i]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(both.astype(np.int64)), *map(pa.array, (x, y, xx, yy, xy))], ["i", "k", "n", "x", "y", "xx", "yy", "xy"]
        )

    folded = typed.mapInArrow(run, "i int, k int, n long, x double, y double, xx double, yy double, xy double")
    return folded.groupBy("i", "k").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
