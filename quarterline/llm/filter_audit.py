"""How filters interact: what each removes, finds already removed, or alone would have removed, in every order of application.

A document is the set of filters that it fails. Filters that fail cost 0 and others infinity in the mask matrix (sets x filters); the
position matrix (filters x orders) holds the inverse of each order, the step at which a filter stands. Their min-plus product is the step
that removes a set under an order. All other numbers are counts of documents scattered to those steps, so documents are only counted, once.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import raw, stored

#: 2^n sets and n! orders are tables in each task.
MOST_FILTERS = 7
_CAPITALS = bytes(range(65, 91))
_LATER_BYTES = bytes(range(0x80, 0xC0))
_MARKS = re.compile(rb"[#$%&*|]")
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
BLOCK = 1 << 20


def removal_steps(orders: Sequence[Sequence[int]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sets x orders) step that removes each set of failed filters, n + 1 for never; and (filters x orders) step of each filter."""
    position = np.empty((n, len(orders)), np.int64)
    position[np.array(orders).T, np.arange(len(orders))] = np.arange(1, n + 1)[:, None]
    passes = (np.arange(1 << n)[:, None] >> np.arange(n) & 1) == 0
    mask = np.where(passes, n + 1, 0)
    step = np.full((1 << n, len(orders)), n + 1)
    for f in range(n):
        np.minimum(step, mask[:, f, None] + position[f], out=step)
    return step, position


def audit(flags: DataFrame, filters: Sequence[str], part: str, weights: Sequence[str] = (), orders: Sequence[str] | None = None) -> DataFrame:
    """One row per part, order and step with the documents kept, removed, redundant, unique_fails, <weight>_lost and shapley.

    `flags` has one row per document: a boolean column per filter (true: it fails; null: it passes), whose names are single letters, the
    part, and 0/1 columns of weights. `orders` are words of the filters' letters, by default all. removed: at this step; redundant: fails
    its filter but left earlier; unique_fails: fails its filter only; <weight>_lost: sum of the weight over the removed; shapley: its
    filter's removed over all the orders, at any step. A null part is the empty string. A table without rows has no parts.
    """
    n = len(filters)
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {n}")
    place = {f: i for i, f in enumerate(filters)}
    named = list(orders) if orders is not None else ["".join(p) for p in itertools.permutations(filters)]
    bad = [o for o in named if sorted(o) != sorted(filters)]
    if bad:
        raise ValueError(f"not orders of {list(filters)}: {bad}")
    weights = list(weights)
    fails = [F.when(F.col(f"`{f}`"), F.lit(1 << i)).otherwise(0) for f, i in place.items()]
    failed = sum(fails[1:], fails[0])
    marked = flags.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), failed.alias("failed"), *[F.coalesce(F.col(w).cast("long"), F.lit(0)).alias(w) for w in weights])
    counted = marked.groupBy("part", "failed").agg(F.count("*").alias("n"), *[F.sum(w).alias(w) for w in weights])
    # At most 2^n rows of a part meet.
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("failed", "n", *weights)).alias("sets"))
    names = ["kept", "removed", "redundant", "unique_fails", *[f"{w}_lost" for w in weights], "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, position = removal_steps([[place[f] for f in o] for o in named], n)
        order = np.argsort(position, axis=0)
        columns = np.arange(len(named))
        texts = pa.array(np.repeat(named, n).tolist(), pa.string())
        steps = pa.array(np.tile(np.arange(1, n + 1), len(named)), pa.int32())
        for batch in batches:
            for name, sets in zip(batch.column("part").to_pylist(), batch.column("sets"), strict=True):
                rows = sets.values
                failed = rows.field("failed").to_numpy()
                lost = []
                for w in ["n", *weights]:
                    weight = np.zeros(1 << n, np.int64)
                    weight[failed] = rows.field(w).to_numpy()
                    scattered = np.zeros((n + 2, len(named)), np.int64)
                    np.add.at(scattered, (step, np.broadcast_to(columns, step.shape)), weight[:, None])
                    lost.append(scattered[1 : n + 1])
                    if w == "n":
                        total = weight.sum()
                        failing = np.array([weight[(np.arange(1 << n) >> f & 1) == 1].sum() for f in range(n)])
                        only = weight[1 << np.arange(n)]
                removed = lost[0]
                # The step of a filter removes what fails it and is still there, so its other failures left earlier.
                shapley = np.array([removed[position[f] - 1, columns].sum() for f in range(n)])
                values = [total - np.cumsum(removed, 0), removed, failing[order] - removed, only[order], *lost[1:], shapley[order]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(texts), pa.string()), texts, steps, *[pa.array(v.T.ravel(), pa.int64()) for v in values]],
                    ["part", "filter_order", "step", *names],
                )

    return parts.mapInArrow(run, schema)


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, some MB at a time."""
    start = 0
    while len(text) - start > BLOCK and (cut := _SPACE.search(text, start + BLOCK)):
        yield text[start : cut.start()].split()
        start = cut.end()
    yield text[start:].split()


def text_failures(text: bytes) -> tuple[bool, bool, bool, bool]:
    """Short, repetitive, shouting, marked."""
    words, distinct = 0, set()
    for block in word_blocks(text):
        words += len(block)
        distinct.update(block)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, _LATER_BYTES)))
    return words < 200, 100 * len(distinct) < 50 * words, 100 * capitals > 2 * points, _MARKS.search(text) is not None


def document_failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, A to E, good, toxic: one row per row of `docs`.

    A: under 200 words; B: 100 x distinct words < 50 x words; C: 100 x capitals A-Z > 2 x code points; D: holds one of #$%&*|; E: a row of
    a smaller doc_id has the same text. Words are runs outside [\\x20\\x09-\\x0D], in the case they have; a null text is empty. A null
    doc_id is smaller than none and has none smaller; rows that repeat an id don't fail for each other. A document with several labels is
    good (toxic) if one of them says so. Texts are compared by 128-bit hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, high, low = [], [], []
            for text in raw(batch, "text"):
                found.append(text_failures(text))
                value = xxhash.xxh3_128_intdigest(text)
                high.append((value >> 64) - (1 << 63))
                low.append((value & (1 << 64) - 1) - (1 << 63))
            flags = [pa.array([f[i] for f in found], pa.bool_()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), *flags, pa.array(high, pa.int64()), pa.array(low, pa.int64())], ["doc_id", "part", *"ABCD", "high", "low"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    tested = stored(narrow.mapInArrow(run, "doc_id long, part string, A boolean, B boolean, C boolean, D boolean, high long, low long"), "tested")
    # The row of each text that stays is met by its text and id together, so a text of very many documents is dealt out by their ids.
    first = stored(tested.groupBy("high", "low").agg(F.min("doc_id").alias("doc_id")), "first").withColumn("first", F.lit(True))
    rows = tested.join(first, ["high", "low", "doc_id"], "left").withColumn("E", F.col("doc_id").isNotNull() & F.col("first").isNull())
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    told = told.where("doc_id IS NOT NULL AND (good OR toxic)").groupBy("doc_id").agg(*[F.max(F.coalesce(c, F.lit(False)).cast("long")).alias(c) for c in ("good", "toxic")])
    return rows.join(stored(told, "labels"), "doc_id", "left").select("part", *"ABCDE", "good", "toxic")
