"""Row attributions of a tree ensemble as a distributed job.

A leaf contributes its value when a row meets every condition on its path. Seen as a cooperative game over
the path's features, a known feature counts 1 or 0 and an unknown one counts the share of training weight that
takes the path. The Shapley value of that product has a closed sum over subset sizes, and summing leaves gives the
path-dependent values of the published tree method. All of it depends on a row only through the outcomes of a few
comparisons, so neighbouring leaves share a table of their summed values for every pattern of outcomes, made once on the
driver; a row costs a look-up per table and feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

#: Comparisons whose outcomes a table of leaves covers: 2 ** COMPARED columns; half a tree of depth 4 has so many.
COMPARED = 8
#: Rows whose sums are held at a time.
BLOCK = 8192


def _leaves(tree, weight: float) -> list[tuple[float, dict[int, tuple[float, float, float]]]]:
    """(value, {feature: (lower, upper, share)}) of each leaf; a row matches when lower < x <= upper."""
    found = []

    def walk(node, path):
        if node.numDescendants() == 0:
            found.append((weight * node.prediction(), path))
            return
        split = node.split()
        feature, threshold = split.featureIndex(), split.threshold()
        total = node.impurityStats().count()
        for child, below in ((node.leftChild(), True), (node.rightChild(), False)):
            lower, upper, share = path.get(feature, (-np.inf, np.inf, 1.0))
            bounds = (lower, min(upper, threshold)) if below else (max(lower, threshold), upper)
            walk(child, {**path, feature: (*bounds, share * child.impurityStats().count() / total)})

    walk(tree._call_java("rootNode"), {})
    return found


def ensemble_leaves(model: PipelineModel) -> list[tuple[float, dict[int, tuple[float, float, float]]]]:
    """All leaves of the fitted ensemble: trees x 2^depth entries, independent of the data."""
    boosted = model.stages[-1]
    return [leaf for tree, weight in zip(boosted.trees, boosted.treeWeights) for leaf in _leaves(tree, weight)]


def base_value(leaves) -> float:
    """Attribution of knowing nothing: the training-weighted mean of the margin."""
    return float(sum(value * np.prod([share for *_, share in path.values()]) for value, path in leaves))


def _shapley(value: float, path: dict[int, tuple[float, float, float]], known: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(feature, attributions) of one leaf; `known` has 1 where a feature meets its condition and 0 elsewhere."""
    m = len(path)
    for f, (_, _, share) in path.items():
        # sizes[s]: sum over coalitions of s other features of the product of their factors
        sizes = [np.ones(len(known[f]))]
        for other, (_, _, other_share) in path.items():
            if other == f:
                continue
            grown = [c * other_share for c in sizes] + [np.zeros(len(known[f]))]
            for s, c in enumerate(sizes):
                grown[s + 1] = grown[s + 1] + c * known[other]
            sizes = grown
        weighted = sum(factorial(s) * factorial(m - s - 1) / factorial(m) * c for s, c in enumerate(sizes))
        yield f, value * (known[f] - share) * weighted


@dataclass(frozen=True)
class Patterns:
    """Leaves that share few comparisons `x[feature] <= threshold`: bit i of a pattern is the outcome of the i-th.

    values: features x patterns, the leaves' summed attributions. Without values (too many comparisons) the one leaf is kept.
    """

    compared: list[tuple[int, float]]
    features: list[int]
    values: np.ndarray | None
    leaf: tuple | None = None


def _comparisons(path: dict[int, tuple[float, float, float]]) -> dict[tuple[int, float], None]:
    return {(f, float(t)): None for f, (low, high, _) in path.items() for t in (low, high) if np.isfinite(t)}


def _tabled(leaves: list, compared: list[tuple[int, float]]) -> Patterns:
    if len(compared) > COMPARED:
        return Patterns(compared, [], None, leaves[0])
    every = np.arange(1 << len(compared))
    below = {c: (every >> i & 1).astype(bool) for i, c in enumerate(compared)}
    none, all_ = np.zeros(len(every), bool), np.ones(len(every), bool)
    features = sorted({f for _, path in leaves for f in path})
    values = np.zeros((len(features), len(every)))
    for value, path in leaves:
        known = {f: (below.get((f, float(high)), all_) & ~below.get((f, float(low)), none)).astype(float) for f, (low, high, _) in path.items()}
        for f, part in _shapley(value, path, known):
            values[features.index(f)] += part
    return Patterns(compared, features, values)


def pattern_tables(leaves) -> list[Patterns]:
    """All leaves in tables: neighbours are put together while they have at most COMPARED comparisons."""
    out, held, compared = [], [], {}
    for leaf in leaves:
        more = {**compared, **_comparisons(leaf[1])}
        if held and len(more) > COMPARED:
            out.append(_tabled(held, list(compared)))
            held, more = [], _comparisons(leaf[1])
        held.append(leaf)
        compared = more
    return [*out, _tabled(held, list(compared))] if held else out


def look_up(columns: np.ndarray, tables: list[Patterns]) -> np.ndarray:
    """Attributions (features x rows) of rows given as features x rows."""
    cuts: dict[int, set[float]] = {}
    for f, t in (c for table in tables for c in table.compared):
        cuts.setdefault(f, set()).add(t)
    ordered = {f: np.array(sorted(ts)) for f, ts in cuts.items()}
    place = {(f, t): i for f, ts in ordered.items() for i, t in enumerate(ts.tolist())}
    out = np.zeros(columns.shape)
    for a in range(0, columns.shape[1], BLOCK):
        part, sums = columns[:, a : a + BLOCK], out[:, a : a + BLOCK]
        # x <= the i-th cut exactly where at most i cuts are smaller than x.
        codes = {f: np.searchsorted(ts, part[f]).astype(np.uint8 if len(ts) < 256 else np.uint32) for f, ts in ordered.items()}
        for table in tables:
            if table.values is None:
                value, path = table.leaf
                known = {f: ((part[f] > low) & (part[f] <= high)).astype(float) for f, (low, high, _) in path.items()}
                for f, values in _shapley(value, path, known):
                    sums[f] += values
                continue
            pattern = np.zeros(part.shape[1], np.uint16)
            for i, (f, t) in enumerate(table.compared):
                pattern |= (codes[f] <= place[f, t]).astype(np.uint16) << np.uint16(i)
            pattern = pattern.astype(np.intp)
            for f, values in zip(table.features, table.values):
                sums[f] += values[pattern]
    return out


def attribute(matrix: np.ndarray, leaves) -> np.ndarray:
    """Attributions of each row (rows x features)."""
    return look_up(np.ascontiguousarray(matrix.T), pattern_tables(leaves)).T


def attributions(model: PipelineModel, df: DataFrame, keys: list[str]) -> DataFrame:
    """Wide table: keys, `shap_<feature>` per model input and `base_value`; they add up to the row's margin."""
    names = model.stages[0].getInputCols()
    leaves = ensemble_leaves(model)
    shared = df.sparkSession.sparkContext.broadcast((pattern_tables(leaves), base_value(leaves)))
    told = [*keys, *[f"shap_{n}" for n in names], "base_value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, base = shared.value
        for batch in batches:
            columns = np.stack([batch.column(len(keys) + i).to_numpy(False).astype(float) for i in range(len(names))])
            columns[np.isnan(columns)] = 0.0
            values = [pa.array(x) for x in look_up(columns, tables)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *values, pa.array(np.full(batch.num_rows, base))], told)

    kinds = dict(df.dtypes)
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], *[f"shap_{n} double" for n in names], "base_value double"])
    return df.select(*keys, *[df[n].cast("double").alias(f"_x{i}") for i, n in enumerate(names)]).mapInArrow(run, schema)
