"""Helpers shared by the operators: tables, stored stages, ASCII words, sorted groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.session import fresh_folder

#: Entries that a worker's table of words holds before it starts anew.
MEMO = 300_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe when an executor is lost."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo; a null id counts as empty text, whose crc32 is 0."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def raw(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts' bytes in UTF-8; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Runs of bytes outside [\\x20\\x09-\\x0D], A-Z lower-cased (bytes methods know ASCII only)."""
    return text.lower().split()


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def spread(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(30))
        values = values * np.uint64(0xBF58476D1CE4E5B9)
        values = values ^ (values >> np.uint64(27))
        values = values * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def by_groups(df: DataFrame, keys: list[str], task: Callable[[pa.Table], pa.Table | None], schema: str, order: tuple = ()) -> DataFrame:
    """Apply `task` to the rows of each key (long columns), one group in memory at a time.

    Rows are dealt out and sorted by key and read as a stream, so thousands of tiny groups cost no call into Spark each.
    The caller bounds the size of a group.
    """
    dealt = df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for results in _each_group(batches, keys, task):
            yield from pa.concat_tables(results).combine_chunks().to_batches()

    return dealt.mapInArrow(run, schema)


def _each_group(batches, keys, task):
    rest, out, held = None, [], 0
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        starts = _starts(rows, keys)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if (made := task(rows.slice(a, b - a))) is not None and made.num_rows:
                out.append(made)
                held += made.num_rows
                if held >= 20_000:
                    yield out
                    out, held = [], 0
        rest = rows.slice(starts[-1]) if len(starts) else None
    if rest is not None and rest.num_rows and (made := task(rest)) is not None and made.num_rows:
        out.append(made)
    if out:
        yield out


def _starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    if not rows.num_rows:
        return np.zeros(0, np.int64)
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)
